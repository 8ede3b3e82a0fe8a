"""Language identification as a mixture: how much of a document each language explains.

Training counts byte n-grams (3 and 4 bytes of the lower-cased text) per language over all labelled rows; n-grams are
hashed into a fixed number of slots, so the model has ``slots`` numbers per language whatever the corpus. A document is
taken as a mixture of the learned languages. Expectation-maximisation estimates the proportions from the n-grams'
likelihoods; languages join the set in the order of their proportions as long as the penalised likelihood (half the
logarithm of the number of n-grams per language, times ``penalty``) rises.

Results per row: ``languages`` (language and proportion, largest first), ``lang_pred`` (the largest; ties: the first by name),
``score`` (its proportion) and ``has_letters``. A text that is null or has no letter is ``und`` with an empty set and score 0, as is
any text if nothing was learned. Texts are read whole; repeated rows get equal results; columns named like an
output are replaced.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

from .common import add_columns, list_array, slices, texts_of

SLOTS = 1 << 16
UNKNOWN = "und"
ROUNDS = 12
PENALTY = 4.0

MIXTURE = T.ArrayType(T.StructType([T.StructField("lang", T.StringType()), T.StructField("proportion", T.DoubleType())]))


def has_letter(text: str) -> bool:
    return any(map(str.isalpha, text))


def ngram_slots(text: str, slots: int = SLOTS) -> np.ndarray:
    """The slot of every 3- and 4-gram of the lower-cased text between spaces."""
    raw = np.frombuffer(f" {text.lower()} ".encode("utf-8", "replace"), np.uint8).astype(np.uint32)
    if len(raw) < 3:
        return np.empty(0, np.int64)
    three = raw[:-2] | raw[1:-1] << 8 | raw[2:] << 16
    four = three[:-1] | raw[3:] << 24
    mixed = np.concatenate([three * np.uint32(0x9E3779B1), (four ^ four >> 15) * np.uint32(0x85EBCA77)])
    return (mixed >> np.uint32(32 - int(slots).bit_length() + 1)).astype(np.int64)


def train(df: DataFrame, text_col: str = "text", lang_col: str = "lang", slots: int = SLOTS) -> tuple[list[str], np.ndarray]:
    """Languages by name and their log-likelihoods per slot, learned from all rows with a language.

    Each task adds up its rows; the sums are added by Spark, so what reaches the driver has a row per language and slot.
    """
    rows = df.where(F.col(lang_col).isNotNull() & F.col(text_col).isNotNull()).select(text_col, lang_col)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[str, np.ndarray] = {}
        for batch in batches:
            for part in slices(batch, text_col):
                by_lang: dict[str, list[np.ndarray]] = {}
                for text, lang in zip(part.column(0).to_pylist(), part.column(1).to_pylist(), strict=True):
                    by_lang.setdefault(lang, []).append(ngram_slots(text, slots))
                for lang, found in by_lang.items():
                    own = np.bincount(np.concatenate(found), minlength=slots)
                    sums[lang] = sums[lang] + own if lang in sums else own
        for lang, own in sums.items():
            slot = np.flatnonzero(own)
            yield pa.RecordBatch.from_arrays(
                [pa.array([lang] * len(slot), pa.string()), pa.array(slot, pa.int32()), pa.array(own[slot], pa.int64())],
                names=["lang", "slot", "n"],
            )

    counted = rows.mapInArrow(count, "lang string, slot int, n long").groupBy("lang", "slot").agg(F.sum("n").alias("n"))
    table = counted.toArrow()
    names = sorted(set(table.column("lang").to_pylist()))
    number = {lang: i for i, lang in enumerate(names)}
    counts = np.full((len(names), slots), 0.5)
    if names:
        lang = np.array([number[v] for v in table.column("lang").to_pylist()])
        counts[lang, table.column("slot").to_numpy()] += table.column("n").to_numpy()
    return names, np.log(counts / counts.sum(axis=1, keepdims=True)).astype(np.float32)


def mixture(like: np.ndarray, weight: np.ndarray, rounds: int = ROUNDS) -> tuple[np.ndarray, float]:
    """Proportions of the languages (rows of ``like``) and the log-likelihood, by expectation-maximisation."""
    share = np.full(len(like), 1 / len(like))
    total = weight.sum()
    for _ in range(rounds):
        joint = share[:, None] * like
        new = (joint / joint.sum(axis=0)) @ weight / total
        if np.abs(new - share).max() < 1e-3:
            share = new
            break
        share = new
    return share, float(np.log(share @ like) @ weight)


def analyse(text: str, names: list[str], model: np.ndarray, penalty: float = PENALTY) -> list[tuple[str, float]]:
    """The chosen languages with their proportions, largest first."""
    found = ngram_slots(text, model.shape[1])
    if not len(names) or not len(found):
        return []
    slot, times = np.unique(found, return_counts=True)
    weight = times.astype(np.float64)
    logs = model[:, slot].astype(np.float64)
    peak = logs.max(axis=0)
    like = np.exp(logs - peak)
    share, _ = mixture(like, weight)
    order = np.argsort(-share, kind="stable")
    cost = penalty * 0.5 * np.log(len(found) + 1)
    best, best_share = float((logs[order[0]] - peak) @ weight), np.ones(1)
    chosen = order[:1]
    for size in range(2, len(names) + 1):
        own, fit = mixture(like[order[:size]], weight)
        if fit - cost * (size - 1) <= best:
            break
        best, best_share, chosen = fit - cost * (size - 1), own, order[:size]
    return sorted(((names[k], float(s)) for k, s in zip(chosen, best_share, strict=True)), key=lambda x: (-x[1], x[0]))


def predict(
    df: DataFrame, model: tuple[list[str], np.ndarray], text_col: str = "text", penalty: float = PENALTY,
) -> DataFrame:
    """Append languages, lang_pred, score and has_letters. The model is bounded by its slots, so it travels with the task."""
    shared = df.sparkSession.sparkContext.broadcast(model)

    def work(part: pa.RecordBatch) -> list[pa.Array]:
        names, likelihoods = shared.value
        texts = texts_of(part.column(text_col))
        letters = [has_letter(t) for t in texts]
        sets = [analyse(t, names, likelihoods, penalty) if ok else [] for t, ok in zip(texts, letters, strict=True)]
        flat = [x for own in sets for x in own]
        return [
            list_array(map(len, sets), pa.StructArray.from_arrays(
                [pa.array([x[0] for x in flat], pa.string()), pa.array([x[1] for x in flat], pa.float64())],
                names=["lang", "proportion"],
            )),
            pa.array([own[0][0] if own else UNKNOWN for own in sets]),
            pa.array([min(1.0, own[0][1]) if own else 0.0 for own in sets], pa.float64()),
            pa.array(letters),
        ]

    return add_columns(df, text_col, [
        T.StructField("languages", MIXTURE), T.StructField("lang_pred", T.StringType()),
        T.StructField("score", T.DoubleType()), T.StructField("has_letters", T.BooleanType()),
    ], work)
