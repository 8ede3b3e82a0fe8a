"""Exact top-k by integer inner product with block-at-a-time pruning.

Rows are dealt into document ranges; a range is cut into blocks of neighbouring ids. A block keeps a forward index (its rows'
integer vectors) and, per term (component), the largest and smallest weight. The best any row of a block can score for a
query is the sum of its terms' extremes, taken by the sign of the query's weight. A query first meets the block of a range with
the highest bound; the k-th score there is the least it needs. It then visits the blocks of the range and skips those whose
bound is below the k-th score known so far. The k best of each range are merged at last, so the result is exact.

Rows and queries travel as pieces, packed integer vectors of bounded size. A task holds one range and reads all queries piece
by piece, so the rows are sent once and the queries once per range. Ranges are as large as a task can hold; there are more of them
only where cores would idle, and not so many that the queries' copies outgrow the rows. Nothing is broadcast.
Blocks are visited in the order of ids, so that a later row has to score more than the k-th. Neighbouring blocks share one matrix
product if most of them are open for most queries. Products are done in the narrowest type in which every partial sum is exact.

Defined cases: rows without id and vectors that are null, empty or hold null or non-finite components take no part; of rows with
one id the smallest vector counts; missing trailing components count as 0; a query is never its own candidate; ties go
to the smaller id; fewer candidates than k are all returned. Scores are 64-bit integers.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, functions as F

from .vectors import best, smallest, taking_part

# A range holds at most so many rows and about so many bytes, and is not made smaller than LEAST_ROWS to keep cores busy.
RANGE_ROWS = 1 << 18
RANGE_BYTES = 1 << 25
LEAST_ROWS = 4096
TASKS_PER_CORE = 4
COPIES = 4
BLOCK_ROWS = 128
# Blocks that may share a product.
TURN_BLOCKS = 16
QUERY_ROWS = 512
# Components that are packed at once, and bytes of a piece.
PACK_VALUES = 1 << 20
PIECE_BYTES = 1 << 15
PIECE = "part int, asks boolean, ids binary, weights binary, kind string, width int"
SCALE = 256
# No score; its negative is an integer too.
NONE = np.iinfo(np.int64).min + 1


def integers(vectors: np.ndarray) -> np.ndarray:
    return np.floor(SCALE * vectors).astype(np.int64)


def largest(weights: np.ndarray) -> int:
    return max(int(weights.max(initial=0)), -int(weights.min(initial=0)))


def kind_for(most: float) -> str:
    """The smallest kind of integer that holds up to ``most``."""
    return next((t for t in ("<i2", "<i4") if most <= np.iinfo(t).max), "<i8")


def exact_type(queries: np.ndarray, most: int, width: int) -> type:
    """The fastest type in which inner products with weights of up to ``most`` are exact."""
    total = largest(queries) * most * width
    return np.float32 if total < 2**24 else np.float64 if total < 2**53 else np.int64


@dataclass
class Range:
    """Rows in the order of their ids, and the extremes of each block."""

    ids: np.ndarray
    rows: np.ndarray
    cuts: np.ndarray
    block_rows: int
    high: np.ndarray
    low: np.ndarray
    most: int

    @classmethod
    def of(cls, ids: np.ndarray, rows: np.ndarray, block_rows: int) -> Range:
        order = np.argsort(ids, kind="stable")
        if (order[1:] < order[:-1]).any():
            ids, rows = ids[order], rows[order]
        cuts = np.arange(0, len(ids), block_rows)
        high, low = np.maximum.reduceat(rows, cuts, axis=0), np.minimum.reduceat(rows, cuts, axis=0)
        return cls(ids, rows, cuts, block_rows, high, low, largest(rows))

    def bounds(self, queries: np.ndarray) -> np.ndarray:
        """For each query and block, the sum of the terms' extremes."""
        high, low = self.high.astype(queries.dtype), self.low.astype(queries.dtype)
        return np.maximum(queries, 0) @ high.T + np.minimum(queries, 0) @ low.T

    def places(self, blocks: np.ndarray) -> np.ndarray:
        """The places of the blocks' rows."""
        all_ = (self.cuts[blocks][:, None] + np.arange(self.block_rows)).ravel()
        return all_[all_ < len(self.ids)]


class Search:
    """The best rows of one range for a group of queries."""

    def __init__(self, range_: Range, query_ids: np.ndarray, queries: np.ndarray, k: int):
        width = range_.rows.shape[1]
        # Components beyond those of the range's rows meet zeros.
        queries = np.pad(queries, ((0, 0), (0, max(0, width - queries.shape[1]))))[:, :width]
        self.range, self.k = range_, k
        self.kind = exact_type(queries, range_.most, width)
        self.queries = np.ascontiguousarray(queries, self.kind)
        self.lowest = NONE if self.kind is np.int64 else -np.inf
        place = np.searchsorted(range_.ids, query_ids)
        self.own = np.where(range_.ids[np.minimum(place, len(range_.ids) - 1)] == query_ids, place, -1)
        self.ids, self.scores = np.full((len(queries), k), -1), np.full((len(queries), k), NONE)
        # What a row has to score at least.
        self.need = np.full(len(queries), NONE + 1, self.kind)
        self.scored = 0
        self.room = np.empty(len(queries) * TURN_BLOCKS * range_.block_rows, self.kind)

    def score(self, asking: np.ndarray, places: np.ndarray) -> np.ndarray:
        """Scores of the rows at ascending ``places``, the lowest for a query's own row; valid until the next call."""
        dense = places[-1] - places[0] + 1 == len(places)
        rows = self.range.rows[places[0] : places[-1] + 1] if dense else self.range.rows[places]
        queries = self.queries if len(asking) == len(self.queries) else self.queries[asking]
        out = self.room[: len(asking) * len(places)].reshape(len(asking), len(places))
        np.matmul(queries, rows.astype(self.kind).T, out=out)
        at = np.searchsorted(places, self.own[asking])
        mine = np.flatnonzero(places[np.minimum(at, len(places) - 1)] == self.own[asking])
        out[mine, at[mine]] = self.lowest
        return out

    def start(self, bounds: np.ndarray) -> None:
        """The k-th score in the block with the highest bound is the least that a query needs."""
        first = bounds.argmax(axis=1)
        for b in np.unique(first):
            asking, places = np.flatnonzero(first == b), self.range.places(np.array([b]))
            self.scored += len(asking)
            if len(places) >= self.k:
                score = self.score(asking, places)
                self.need[asking] = np.maximum(self.need[asking], np.partition(score, -self.k, axis=1)[:, -self.k])

    def visit(self, asking: np.ndarray, places: np.ndarray) -> None:
        """Take over rows that score what is needed; all rows before ``places`` with a part in the result were met."""
        score = self.score(asking, places)
        some = np.flatnonzero(score.max(axis=1) >= self.need[asking])
        if not len(some):
            return
        who, score = asking[some], score[some]
        hits = np.flatnonzero(score >= self.need[who][:, None])
        line, column = np.divmod(hits, len(places))
        many = np.bincount(line)
        if many.max() <= 4 * self.k:
            found = np.full((len(who), many.max()), -1)
            found[line, np.arange(len(line)) - (np.cumsum(many) - many)[line]] = column
        else:
            found = firsts(score, self.k)
        new = np.take_along_axis(score, np.maximum(found, 0), axis=1)
        there = (found >= 0) & (new > self.lowest)
        new = np.where(there, np.where(there, new, 0).astype(np.int64), NONE)
        ids = np.concatenate([self.ids[who], np.where(there, self.range.ids[places[found]], -1)], axis=1)
        scores = np.concatenate([self.scores[who], new], axis=1)
        # Rows met before have smaller ids, so they come first among equals.
        pick = np.argsort(-scores, axis=1, kind="stable")[:, : self.k]
        self.ids[who], self.scores[who] = (np.take_along_axis(x, pick, axis=1) for x in (ids, scores))
        self.need[who] = np.maximum(self.need[who], (self.scores[who, self.k - 1] + 1).astype(self.kind))

    def run(self) -> None:
        bounds = self.range.bounds(self.queries)
        self.start(bounds)
        for turn in range(0, bounds.shape[1], TURN_BLOCKS):
            open_ = bounds[:, turn : turn + TURN_BLOCKS] >= self.need[:, None]
            asking, blocks = np.flatnonzero(open_.any(axis=1)), np.flatnonzero(open_.any(axis=0))
            if 2 * np.count_nonzero(open_) >= len(asking) * len(blocks) > 0:
                self.scored += len(asking) * len(blocks)
                self.visit(asking, self.range.places(turn + blocks))
                continue
            for b in blocks:
                asking = np.flatnonzero(bounds[:, turn + b] >= self.need)
                if len(asking):
                    self.scored += len(asking)
                    self.visit(asking, self.range.places(np.array([turn + b])))


def firsts(score: np.ndarray, k: int) -> np.ndarray:
    """The columns of the k highest of each line, the first among equals, from the highest down."""
    found, line = np.empty((len(score), k), np.int64), np.arange(len(score))
    lowest = NONE if score.dtype == np.int64 else -np.inf
    rest = score.copy()
    for turn in range(k):
        found[:, turn] = rest.argmax(axis=1)
        rest[line, found[:, turn]] = lowest
    return found


def search_range(
    query_ids: np.ndarray, queries: np.ndarray, ids: np.ndarray, rows: np.ndarray, k: int, block_rows: int = BLOCK_ROWS,
) -> tuple[np.ndarray, np.ndarray, int]:
    """Ids and scores (NONE where there is none) of the k best per query; and the blocks scored."""
    search = Search(Range.of(ids, rows, block_rows), query_ids, queries, k)
    search.run()
    return search.ids, search.scores, search.scored


def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (id, vector, part, asks) as pieces: one set for their part and, of those that ask, one for all parts (part null)."""

    def made(held: list[pa.RecordBatch]) -> pa.RecordBatch:
        table = pa.Table.from_batches(held).combine_chunks()
        ids, part = table.column("id").to_numpy(), table.column("part").to_numpy()
        asks = table.column("asks").to_numpy(zero_copy_only=False).astype(bool)
        lists = table.column("vector").combine_chunks()
        sizes, values = pc.list_value_length(lists).to_numpy(), lists.flatten().to_numpy()
        starts = np.cumsum(sizes) - sizes
        out = []
        for width in np.unique(sizes):
            own = np.flatnonzero(sizes == width)
            weights = integers(values[starts[own][:, None] + np.arange(width)].astype(np.float64))
            weights = weights.astype(kind_for(largest(weights)))
            most = max(1, PIECE_BYTES // (weights.itemsize * int(width)))
            by_part = np.argsort(part[own], kind="stable")
            ends = np.flatnonzero(np.diff(part[own][by_part])) + 1
            groups = [(int(part[own[g[0]]]), g) for g in np.split(by_part, ends)] + [(None, np.flatnonzero(asks[own]))]
            for to, group in groups:
                for piece in (group[i : i + most] for i in range(0, len(group), most)):
                    out.append((
                        to, to is None, ids[own[piece]].astype("<i8").tobytes(), weights[piece].tobytes(), weights.dtype.str, int(width)
                    ))
        types = [pa.int32(), pa.bool_(), pa.binary(), pa.binary(), pa.string(), pa.int32()]
        return pa.RecordBatch.from_arrays(
            [pa.array(c, t) for c, t in zip(zip(*out, strict=True), types, strict=True)],
            names=["part", "asks", "ids", "weights", "kind", "width"],
        )

    held, values = [], 0
    for batch in batches:
        if batch.num_rows:
            held.append(batch)
            values += len(batch.column("vector").flatten())
        if values >= PACK_VALUES:
            yield made(held)
            held, values = [], 0
    if held:
        yield made(held)


def stacked(pieces: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    """The pieces' ids and weights as one block in the order of ids, filled with zeros to the longest vector; uses the pieces up."""
    width, kind = max(w.shape[1] for _, w in pieces), np.result_type(*{w.dtype for _, w in pieces})
    ids = np.concatenate([i for i, _ in pieces])
    order = np.argsort(ids, kind="stable")
    place = np.empty(len(ids), np.int64)
    place[order] = np.arange(len(ids))
    weights = np.zeros((len(ids), width), kind)
    end = len(ids)
    while pieces:
        own, block = pieces.pop()
        weights[place[end - len(own) : end], : block.shape[1]] = block
        end -= len(own)
    return ids[order], weights


def search_pieces(batches: Iterator[pa.RecordBatch], k: int) -> Iterator[pa.RecordBatch]:
    """The k best rows of each part for each query; pieces come by part, a part's rows before the queries."""
    part, range_, rows, asked, waiting = None, None, [], [], 0

    def searched() -> Iterator[pa.RecordBatch]:
        query_ids, queries = stacked(asked)
        for some in np.array_split(np.arange(len(query_ids)), max(1, len(query_ids) // QUERY_ROWS)):
            own, search = query_ids[some], Search(range_, query_ids[some], queries[some], k)
            search.run()
            there = search.scores > NONE
            yield pa.RecordBatch.from_arrays([
                pa.array(np.repeat(own, k)[there.ravel()]), pa.array(search.ids[there]), pa.array(search.scores[there]),
            ], names=["query_id", "vec_id", "score"])

    for batch in batches:
        for i in range(batch.num_rows):
            to, asks, ids, weights, kind, width = (batch.column(c)[i].as_py() for c in ("part", "asks", "ids", "weights", "kind", "width"))
            if to != part:
                if asked and range_:
                    yield from searched()
                part, range_, rows, asked, waiting = to, None, [], [], 0
            piece = np.frombuffer(ids, "<i8"), np.frombuffer(weights, kind).reshape(-1, width)
            if not asks:
                rows.append(piece)
                continue
            if rows:
                range_ = Range.of(*stacked(rows), BLOCK_ROWS)
            asked.append(piece)
            waiting += len(piece[0])
            if waiting >= QUERY_ROWS:
                if range_:
                    yield from searched()
                asked, waiting = [], 0
    if asked and range_:
        yield from searched()


def ranges_for(rows: int, queries: int, row_bytes: int, cores: int) -> int:
    """As many ranges as memory asks for; or more to keep cores busy, while the queries are copied to no more than COPIES times the rows."""
    fewest = max(1, -(-rows // RANGE_ROWS), -(-rows * row_bytes // RANGE_BYTES))
    return max(fewest, min(TASKS_PER_CORE * cores, -(-rows // LEAST_ROWS), COPIES * rows // max(1, queries)))


def top_k(
    df: DataFrame, is_query: Column, k: int = 5, id_col: str = "vec_id", vector_col: str = "embedding",
) -> DataFrame:
    """query_id, rank, vec_id and score for the rows where ``is_query`` (on the column ``id``) holds."""
    rows = taking_part(df, id_col, vector_col)
    sizes = rows.agg(
        F.count("*").alias("n"), F.count_if(is_query).alias("q"), F.max(F.size("vector")).alias("width"),
        F.max(F.greatest(F.array_max("vector"), -F.array_min("vector"))).cast("double").alias("most"),
    ).first()
    row_bytes = (sizes["width"] or 0) * np.dtype(kind_for(SCALE * (sizes["most"] or 0) + 1)).itemsize
    ranges = ranges_for(sizes["n"], sizes["q"], row_bytes, df.sparkSession.sparkContext.defaultParallelism)
    dealt = smallest(rows).select(
        "id", "vector", F.pmod(F.xxhash64("id"), F.lit(ranges)).cast("int").alias("part"),
        F.coalesce(is_query, F.lit(False)).alias("asks"),
    )
    everywhere = F.sequence(F.lit(0), F.lit(ranges - 1))
    sent = dealt.mapInArrow(pack, PIECE).withColumn(
        "part", F.explode(F.when(F.col("asks"), everywhere).otherwise(F.array("part")))
    ).repartitionById(ranges, "part").sortWithinPartitions("part", "asks")
    found = sent.mapInArrow(lambda batches: search_pieces(batches, k), "query_id long, vec_id long, score long")
    return best(found, k, "long")
