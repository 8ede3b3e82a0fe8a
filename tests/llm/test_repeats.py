"""Repeat removal against brute force over all windows."""

import hashlib
import random
from collections import Counter

import pytest

from strataflow.llm import substring, suffix

SCHEMA = "doc_id long, text string, kept int, batch string"


def brute_mask(units, window, places):
    covered = [False] * len(units)
    for i in range(len(units) - window + 1):
        if places[tuple(units[i : i + window])] > 1:
            covered[i : i + window] = [True] * window
    return covered


def brute(docs, window, split):
    rows = [split((t or "").encode()) for t in docs]
    places = Counter(tuple(u[i : i + window]) for u in rows for i in range(len(u) - window + 1))
    return rows, [brute_mask(u, window, places) for u in rows]


def corpus(rng, words, length):
    base = [[rng.choice(words) for _ in range(rng.randint(1, length))] for _ in range(12)]
    shared = [rng.choice(words) for _ in range(60)]
    docs = [" ".join(b) for b in base]
    docs += [docs[0], docs[0], docs[3]]
    for b in base[:6]:
        edited = list(b)
        edited[rng.randrange(len(b))] = "edited"
        docs.append(" \n".join(edited))
        docs.append(" ".join(b[: len(b) // 2] + shared + b[len(b) // 2 :]))
        docs.append(" ".join(shared[rng.randint(0, 20) :] + b[:5] + shared[: rng.randint(34, 60)]))
        docs.append(" ".join(shared[5 : 5 + rng.randint(33, 37)]))
    return docs + ["", None, "  ", "same " * 100, "x y " * 60, "é" * 230 + "z", "é" * 230 + "y"]


CORPORA = [
    corpus(random.Random(seed), [f"w{i}" for i in range(size)], length) for seed, size, length in [(1, 400, 220), (2, 3, 120)]
]


def frame(spark, docs):
    return spark.createDataFrame([(i, t, 7, "b") for i, t in enumerate(docs)], SCHEMA).repartition(3)


@pytest.mark.parametrize("docs", CORPORA)
def test_words(spark, docs):
    rows, masks = brute(docs, 35, bytes.split)
    got = {r["doc_id"]: r for r in substring.remove_repeats(frame(spark, docs)).collect()}
    assert len(got) == len(docs)
    for i, (units, mask) in enumerate(zip(rows, masks, strict=True)):
        kept = b" ".join(u for u, m in zip(units, mask, strict=True) if not m).decode()
        assert (got[i]["n_words"], got[i]["n_removed"], got[i]["kept"]) == (len(units), sum(mask), kept), i
        assert got[i]["batch"] == "b"


@pytest.mark.parametrize("docs", CORPORA)
def test_bytes(spark, docs):
    rows, masks = brute(docs, 400, lambda b: list(b))
    got = {r["doc_id"]: r for r in suffix.remove_repeats(frame(spark, docs)).collect()}
    assert len(got) == len(docs)
    for i, (units, mask) in enumerate(zip(rows, masks, strict=True)):
        kept = bytes(u for u, m in zip(units, mask, strict=True) if not m)
        assert (got[i]["n_bytes"], got[i]["n_removed"]) == (len(units), sum(mask)), i
        assert hashlib.sha256(got[i]["kept"]).digest() == hashlib.sha256(kept).digest()
        spans = sum(m and not (k and mask[k - 1]) for k, m in enumerate(mask))
        assert got[i]["n_spans"] == spans == len(got[i]["removed"])


@pytest.mark.parametrize("window", [32, 45, 64, 128, 200, 255, 256, 257, 300, 448, 512, 700])
def test_sizes_of_any_window(window):
    cell, depth, anchor = suffix.sizes_of(window)
    assert depth <= window - cell + 1 and window + cell - 1 <= 3 * depth and suffix.GRAM <= anchor <= depth and cell > 0


@pytest.mark.parametrize("window", [32, 100, 256])
def test_other_windows(spark, window):
    """Passages of 51 to 60 words in otherwise different documents, copies with one other byte, and clean texts."""
    rng = random.Random(window)
    word = lambda: "".join(rng.choices("abcdefghij", k=rng.randint(3, 9)))
    passages = [" ".join(word() for _ in range(rng.randint(51, 60))) for _ in range(5)]
    docs = [" ".join(word() for _ in range(120)) for _ in range(8)]
    docs += [" ".join([word(), passages[i % 5], word(), word()]) for i in range(15)]
    docs += [p[:100] + "#" + p[101:] for p in passages] + ["é" * 60 + "x" * window, "x" * (window - 1), "x" * (window + 1), "", None]
    rows, masks = brute(docs, window, lambda b: list(b))
    got = {r["doc_id"]: r for r in suffix.remove_repeats(frame(spark, docs), window=window).collect()}
    for i, (units, mask) in enumerate(zip(rows, masks, strict=True)):
        kept = bytes(u for u, m in zip(units, mask, strict=True) if not m)
        assert (got[i]["n_bytes"], got[i]["n_removed"], bytes(got[i]["kept"])) == (len(units), sum(mask), kept), i
    # What a passage leaves of its document is words of its own; clean documents stay whole.
    assert all(got[i]["n_removed"] == 0 for i in range(8)) and all(got[i]["n_removed"] >= len(passages[0]) / 2 for i in range(8, 23))
    with pytest.raises(ValueError):
        suffix.remove_repeats(frame(spark, docs), window=31)


def test_empty_and_repeated_rows(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert substring.remove_repeats(empty).count() == suffix.remove_repeats(empty).count() == 0
    text = " ".join(f"w{i}" for i in range(150))
    twice = spark.createDataFrame([(None, text, 1, "b"), (None, text, 1, "b"), (3, "short", 1, None)], SCHEMA)
    assert sorted(r["n_removed"] for r in substring.remove_repeats(twice).collect()) == [0, 150, 150]
    assert sorted(r["n_removed"] for r in suffix.remove_repeats(twice).collect()) == [0, len(text), len(text)]


@pytest.mark.parametrize("period,cover", [(substring.PERIOD, substring.COVER)])
def test_cover(period, cover):
    assert {(a - b) % period for a in cover for b in cover} == set(range(period))
