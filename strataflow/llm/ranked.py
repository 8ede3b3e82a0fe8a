"""Ranked lexical search: an inverted index in shards, searched by a hybrid of term-at-a-time and document-at-a-time.

*Index.* Tasks read documents as they come and close a shard when it holds SHARD_BYTES of text or SHARD_DOCS documents, so the
texts are never shuffled. A shard is one row per term (documents by their place in the shard, and frequencies) and one row
with the ids and lengths of its documents, ordered by id. Both tables are written; they serve any number of searches.

*Search.* Items are dealt into blocks of at most ITEM_BLOCK. Posting lists meet the terms of the items in a join, so only lists
that are asked for are read on; then each (shard, block) finds its own best documents per item:

1. Term at a time: the shortest lists, together at most a part of the shard, are summed into accumulators. These become one
   sorted list whose bound is its highest sum. The k-th of these sums is the first threshold.
2. Document at a time: this list and the long lists go through the shard in ranges of documents. A range whose list
   maxima together stay below the threshold is skipped. In others, lists are taken in the order of their maxima: those that
   cannot reach the threshold together are only looked up, for documents that the other lists bring and whose bound still
   reaches it.

The best of all shards are ranked at the end, with limits before the shuffle. Statistics (documents with a term, terms, document
frequencies) cover all documents; a term's lists have one row per shard, so no term or source gathers in one task.

Scores are integers: a document's sum of w * ((10^9 tf) div (1000 tf + 8 m)) over the item's distinct terms, with
w = floor(1000 ln((2 N + 2) / (2 df + 1))) and m = 10 + (90 n N) div L.

Defined cases: a null or empty text has no terms and is never found; rows that repeat are documents of their own; a document
without id counts and ranks behind others of its score. Items: rows without id take no part, rows of one id are one item with
the terms of all. An item without terms, or whose terms no document has, has no rows.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window, functions as F, types as T

from .common import slices, texts_of
from .components import stored
from .terms import LETTERS_AND_DIGITS, terms_of

TOP = 10
SHARD_BYTES = 32 << 20
SHARD_DOCS = 1 << 16
ITEM_BLOCK = 512
# Accumulators take the shortest lists up to this part of a shard's documents; ranges have so many documents.
SHORT_PART = 8
RANGE_DOCS = 1024

_SHARD = "shard long, term string, df int, docs binary, tfs binary, ids binary, known binary, lengths binary"


class _Numbers(dict):
    """Numbers terms in the order in which they turn up."""

    def __missing__(self, term: bytes) -> int:
        self[term] = number = len(self)
        return number


def _small(values: np.ndarray) -> np.ndarray:
    """Frequencies in one, two or four bytes."""
    most = int(values.max(initial=0))
    return values.astype("u1" if most < 1 << 8 else "<u2" if most < 1 << 16 else "<u4")


class _Shard:
    def __init__(self):
        self.numbers, self.terms, self.lengths, self.ids, self.bytes = _Numbers(), [], [], [], 0

    def add(self, doc_id: int | None, text: str) -> None:
        n = 0
        for piece in terms_of(text, LETTERS_AND_DIGITS):
            self.terms.append(np.fromiter(map(self.numbers.__getitem__, piece), np.uint32, len(piece)))
            n += len(piece)
        if n:
            self.lengths.append(n)
            self.ids.append(doc_id)
            self.bytes += len(text)

    def full(self) -> bool:
        return self.bytes >= SHARD_BYTES or len(self.ids) >= SHARD_DOCS

    def rows(self, shard: int) -> Iterator[pa.RecordBatch]:
        known = np.array([i is not None for i in self.ids])
        ids = np.array([0 if i is None else i for i in self.ids], np.int64)
        lengths = np.array(self.lengths, np.int64)
        order = np.lexsort((ids, ~known))
        place = np.empty(len(order), np.uint64)
        place[order] = np.arange(len(order), dtype=np.uint64)
        # A posting is term << 16 | document; equal ones are one with its frequency.
        postings = np.concatenate(self.terms).astype(np.uint64) << np.uint64(16) | np.repeat(place, lengths)
        postings.sort()
        first = np.flatnonzero(np.concatenate([[True], postings[1:] != postings[:-1]]))
        tf = np.diff(np.append(first, len(postings)))
        postings = postings[first]
        term, docs = postings >> np.uint64(16), (postings & np.uint64(0xFFFF)).astype("<u2")
        cuts = np.searchsorted(term, np.arange(len(self.numbers) + 1, dtype=np.uint64))
        names = list(self.numbers)
        none = [None]
        yield self._batch(shard, none, none, none, none, [ids[order].tobytes()], [known[order].tobytes()], [lengths[order].tobytes()])
        for at in range(0, len(names), 10_000):
            own = range(at, min(at + 10_000, len(names)))
            n = len(own)
            yield self._batch(
                shard, [names[i].decode() for i in own], np.diff(cuts[at : at + n + 1]).tolist(),
                [docs[cuts[i] : cuts[i + 1]].tobytes() for i in own], [_small(tf[cuts[i] : cuts[i + 1]]).tobytes() for i in own],
                none * n, none * n, none * n,
            )

    @staticmethod
    def _batch(shard, *columns) -> pa.RecordBatch:
        types = [pa.string(), pa.int32()] + [pa.binary()] * 5
        made = [pa.array(c, t) for c, t in zip(columns, types, strict=True)]
        names = ["shard", "term", "df", "docs", "tfs", "ids", "known", "lengths"]
        return pa.RecordBatch.from_arrays([pa.array([shard] * len(made[0]), pa.int64()), *made], names=names)


def build_index(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The written index: rows with a term are posting lists, one row per shard without term has its documents."""

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number, shard = TaskContext.get().partitionId() << 32, _Shard()
        for batch in batches:
            for part in slices(batch, "text"):
                for doc_id, text in zip(part.column(0).to_pylist(), texts_of(part.column(1)), strict=True):
                    shard.add(doc_id, text)
                    if shard.full():
                        yield from shard.rows(number)
                        number, shard = number + 1, _Shard()
        if shard.ids:
            yield from shard.rows(number)

    return stored(df.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text")).mapInArrow(build, _SHARD), "index")


def item_terms(items: DataFrame, id_col: str = "item_id", text_col: str = "text") -> DataFrame:
    """(item, term): the distinct terms of each item."""

    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                for item, text in zip(part.column(0).to_pylist(), texts_of(part.column(1)), strict=True):
                    found = sorted({t for piece in terms_of(text, LETTERS_AND_DIGITS) for t in piece})
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([item] * len(found), pa.int64()), pa.array([t.decode() for t in found], pa.string())],
                        names=["item", "term"],
                    )

    rows = items.where(F.col(id_col).isNotNull()).select(F.col(id_col).cast("long").alias("item"), F.col(text_col).alias("text"))
    return rows.mapInArrow(split, "item long, term string").distinct()


def weight(documents: int, df: int) -> int:
    return math.floor(1000 * math.log((2 * documents + 2) / (2 * df + 1)))


def length_factor(lengths: np.ndarray, documents: int, total: int) -> np.ndarray:
    """m of documents with ``lengths`` terms; exact where 64 bits are too few."""
    if 90 * int(lengths.max(initial=0)) * documents < 1 << 63:
        return 10 + 90 * lengths * documents // max(total, 1)
    return np.array([10 + 90 * n * documents // total for n in lengths.tolist()], np.int64)


def accumulate(lists: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    """Term at a time: the sums of some lists as one list."""
    docs = np.concatenate([d for d, _ in lists])
    scores = np.concatenate([s for _, s in lists])
    order = np.argsort(docs, kind="stable")
    docs, scores = docs[order], scores[order]
    first = np.flatnonzero(np.concatenate([[True], docs[1:] != docs[:-1]]))
    return docs[first], np.add.reduceat(scores, first)


def search(lists: list[tuple[np.ndarray, np.ndarray]], n_docs: int, k: int) -> tuple[np.ndarray, np.ndarray, int]:
    """The ``k`` best documents (ties: the earlier place) and their scores, and how many postings were added or looked up.

    A list has rising places of documents and their scores.
    """
    lists = sorted(lists, key=lambda x: len(x[0]))
    sizes = np.cumsum([len(d) for d, _ in lists])
    short = int(np.searchsorted(sizes, max(n_docs // SHORT_PART, 1), side="right"))
    touched, threshold = 0, 0
    runs = lists[short:]
    if short:
        runs = [accumulate(lists[:short]), *runs]
        touched = int(sizes[short - 1])
        if len(runs[0][1]) >= k:
            threshold = max(0, int(np.partition(runs[0][1], -k)[-k]) - 1)
    edges = np.arange(0, n_docs + RANGE_DOCS, RANGE_DOCS)
    cuts = [np.searchsorted(d, edges) for d, _ in runs]
    tops = np.zeros((len(runs), len(edges) - 1), np.int64)
    for i, ((_, s), cut) in enumerate(zip(runs, cuts, strict=True)):
        some = np.flatnonzero(cut[1:] > cut[:-1])
        if len(some):
            tops[i, some] = np.maximum.reduceat(s, cut[some])
    best_docs, best = np.empty(0, np.int64), np.empty(0, np.int64)
    for r in np.flatnonzero(tops.sum(axis=0) > threshold):
        order = np.argsort(tops[:, r], kind="stable")
        below = np.cumsum(tops[order, r])
        if below[-1] <= threshold:
            continue
        looked_up = int(np.searchsorted(below, threshold, side="right"))
        sums = np.zeros(RANGE_DOCS, np.int64)
        for i in order[looked_up:]:
            docs, scores = runs[i][0][cuts[i][r] : cuts[i][r + 1]], runs[i][1][cuts[i][r] : cuts[i][r + 1]]
            sums[docs - edges[r]] += scores
            touched += len(docs)
        for j in range(looked_up - 1, -1, -1):
            i = order[j]
            open_ = np.flatnonzero(sums + below[j] > threshold) if sums.any() else np.empty(0, np.int64)
            open_ = open_[sums[open_] > 0]
            sums_open = sums[open_]
            docs, scores = runs[i][0][cuts[i][r] : cuts[i][r + 1]], runs[i][1][cuts[i][r] : cuts[i][r + 1]]
            at = np.searchsorted(docs, open_ + edges[r])
            at[at == len(docs)] = 0
            hit = docs[at] == open_ + edges[r] if len(docs) else np.zeros(len(open_), bool)
            sums_open[hit] += scores[at[hit]]
            new = np.zeros(RANGE_DOCS, np.int64)
            new[open_] = sums_open
            sums = new
            touched += len(open_)
        found = np.flatnonzero(sums > threshold)
        if len(found):
            best_docs, best = np.concatenate([best_docs, found + edges[r]]), np.concatenate([best, sums[found]])
            order = np.lexsort((best_docs, -best))[:k]
            best_docs, best = best_docs[order], best[order]
            if len(best) == k:
                threshold = max(threshold, int(best[-1]))
    return best_docs, best, touched


def _read_small(raw: bytes, n: int) -> np.ndarray:
    return np.frombuffer(raw, f"<u{len(raw) // n}").astype(np.int64)


def _search_shard(lists: pa.Table, documents: pa.Table, k: int) -> pa.Table:
    out: list[tuple] = []
    if lists.num_rows and documents.num_rows:
        row = documents.to_pylist()[0]
        ids, known, lengths = (np.frombuffer(row[c], t) for c, t in (("ids", "<i8"), ("known", bool), ("lengths", "<i8")))
        m = length_factor(lengths, row["n"], row["total"])
        runs: dict[int, list] = {}
        for term in lists.to_pylist():
            w = weight(row["n"], term["all_df"])
            if not w:
                continue
            docs, tf = np.frombuffer(term["docs"], "<u2").astype(np.int64), _read_small(term["tfs"], term["df"])
            run = docs, w * (1_000_000_000 * tf // (1000 * tf + 8 * m[docs]))
            for item in term["items"]:
                runs.setdefault(item, []).append(run)
        for item, own in runs.items():
            docs, scores, _ = search(own, len(ids), k)
            out += [(item, int(ids[d]) if known[d] else None, int(s)) for d, s in zip(docs, scores, strict=True)]
    return pa.table(
        [pa.array([x[i] for x in out], pa.int64()) for i in range(3)], names=["item_id", "doc_id", "score"],
    )


def search_index(index: DataFrame, asked: DataFrame, k: int = TOP) -> DataFrame:
    """item_id, rank, doc_id and score of the ``k`` best documents for each item of ``asked`` (item, term)."""
    items = asked.select("item").distinct().count()
    blocks = max(1, -(-items // ITEM_BLOCK))
    terms = asked.withColumn("block", F.pmod(F.xxhash64("item"), F.lit(blocks)).cast("int")).groupBy("block", "term").agg(
        F.sort_array(F.collect_list("item")).alias("items")
    )
    lists = index.where("term IS NOT NULL").select("shard", "term", "df", "docs", "tfs")
    dfs = index.where("term IS NOT NULL").select("term", "df").join(asked.select("term").distinct(), "term").groupBy("term").agg(
        F.sum("df").alias("all_df")
    )
    met = lists.join(terms.join(dfs, "term"), "term")
    shards = index.where("term IS NULL").select(F.col("shard").alias("home"), "ids", "known", "lengths")

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            own = [np.frombuffer(raw, "<i8") for raw in batch.column(0).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [pa.array([len(x) for x in own], pa.int64()), pa.array([int(x.sum()) for x in own], pa.int64())], names=["n", "total"],
            )

    whole = shards.select("lengths").mapInArrow(sums, "n long, total long").agg(F.sum("n").alias("n"), F.sum("total").alias("total")).first()
    documents = shards.withColumns({"n": F.lit(whole["n"] or 0), "total": F.lit(whole["total"] or 0)}).withColumn(
        "own_block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1)))
    )
    found = met.groupBy("shard", "block").cogroup(documents.groupBy("home", "own_block")).applyInArrow(
        lambda a, b: _search_shard(a, b, k), "item_id long, doc_id long, score long"
    )
    order = Window.partitionBy("item_id").orderBy(F.col("score").desc(), F.col("doc_id").asc_nulls_last())
    ranked = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return ranked.select("item_id", F.col("rank").cast("int").alias("rank"), "doc_id", "score")


def rank_documents(docs: DataFrame, items: DataFrame, k: int = TOP) -> DataFrame:
    """Index ``docs`` (doc_id, text) and search them for ``items`` (item_id, text)."""
    return search_index(build_index(docs), stored(item_terms(items), "asked"), k)
