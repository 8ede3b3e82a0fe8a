"""Best-fit packing of tokenized documents by the linear grouping scheme.

Every document becomes its token ids and a closing id 0; documents over the capacity are cut into pieces of the capacity.
Packing plans on the histogram of piece lengths, which has at most ``capacity`` rows whatever the input:

1. Lengths over a part of the capacity are large. Sorted by length they are dealt into groups of equal cardinality, and
   each is rounded up to its group's largest length.
2. For these few sizes the number of sequences is minimised by configurations (how many of each size share a
   sequence), with columns generated by a knapsack; the solution is rounded down and the rest left to step 4.
3. Actual documents take the places of their group, longest first.
4. What is left, small ones above all, goes longest first into the fullest sequence that still has room (best fit).

Steps 1 to 4 run for a few settings of that part and the number of groups, and the shortest plan is taken. It is a list of runs "documents of length n with ranks r.. go to sequences s.., at this offset", also bounded. Ranks of
documents within their length are counted in hashed cells, so neither a length nor a table is ever in one task.
"""

from __future__ import annotations

import re
import zlib
from array import array
from collections import Counter
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F, types as T

from ..session import scratch_path
from .common import fresh, slices, texts_of

CAPACITY = 2048
# What counts as large (over this part of the capacity) and the number of groups: of these plans the shortest is taken.
SETTINGS = ((2, 48), (3, 96), (4, 96), (8, 96))
CLOSING_ID = 0
# Words kept per worker; the older half goes when a generation is full.
CACHE_WORDS = 400_000
# Letters that are their own lower case and composed form, and ASCII marks behind them.
_PLAIN = re.compile("([a-z\u00df-\u00f6\u00f8-\u00ff]+)([!-/:-@\\[-`{-~]*)")
# The Latin-1 capitals, 32 before their small letters.
_CAPITALS = {c: c + 32 for c in range(0xC0, 0xDF) if c != 0xD7}
# Byte-level vocabularies write bytes without a visible Latin-1 letter as the letters from 256 on.
_HIDDEN = [b for b in range(256) if not (33 <= b <= 126 or 161 <= b <= 172 or b >= 174)]
_BYTE_LETTERS = {b: 256 + i for i, b in enumerate(_HIDDEN)}
# About so many pieces are ranked by one sort.
CELL_ROWS = 200_000


class WordIds(dict):
    """Token ids of lower-cased words as little-endian bytes, remembered for the words seen last.

    The vocabulary drops white space and never joins across it, so a text's ids are its words' ids in a row. ASCII letters
    are lower-cased first, and ASCII marks behind letters are split off, as the vocabulary does itself. A word of small
    letters is one match that no normalisation changes, so its ids come from the merges of its bytes alone. The library finds
    added tokens such as <|endoftext|> in the text as it is, before all this: texts that hold one are left to it as a whole.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.whole = Tokenizer.from_file(path)
        self.added = [t.content for t in self.whole.get_added_tokens_decoder().values()]
        # Words are lower-cased before they come here, so none may be taken for an added token.
        self.model = Tokenizer.from_file(path)
        self.model.encode_special_tokens = True
        self.merges = self.model.model
        self.old: dict[bytes, bytes] = {}

    def __missing__(self, word: bytes) -> bytes:
        ids = self.old.get(word)
        if ids is None:
            ids = self._fresh(word)
        if len(self) >= CACHE_WORDS:
            self.old = dict(self)
            self.clear()
        if len(word) <= 64:
            self[word] = ids
        return ids

    def _fresh(self, word: bytes) -> bytes:
        if word.isalpha():
            return self._merged(word.decode())
        text = word.decode("utf-8", "replace").translate(_CAPITALS)
        plain = _PLAIN.fullmatch(text)
        if not plain:
            return array("I", self.model.encode(text, add_special_tokens=False).ids).tobytes()
        letters, marks = plain.groups()
        if marks:
            return self[letters.encode()] + self[marks.encode()]
        return self._merged(letters.encode().decode("latin-1").translate(_BYTE_LETTERS))

    def _merged(self, letters: str) -> bytes:
        return array("I", [t.id for t in self.merges.tokenize(letters)]).tobytes()

    def text(self, text: str) -> bytes:
        if any(token in text for token in self.added):
            return array("I", self.whole.encode(text, add_special_tokens=False).ids).tobytes()
        # bytes.split() cuts at ASCII white space only, all of which the vocabulary drops.
        words = text.encode("utf-8", "replace").lower().split()
        return b"".join([self[w] for w in words])


@lru_cache(maxsize=2)
def _words(path: str) -> WordIds:
    return WordIds(path)


def pieces(
    df: DataFrame, tokenizer_path: str, id_col: str = "doc_id", text_col: str = "text", capacity: int = CAPACITY,
    keep_ids: bool = False,
) -> DataFrame:
    """One row per piece: the id column, piece, start, length, ids_crc32 and, if asked for, ids (unsigned 32-bit, little-endian).

    A null or empty text is the closing id alone. Rows that repeat are packed as often as they occur.
    """
    fields = [
        T.StructField(id_col, df.schema[id_col].dataType), T.StructField("piece", T.IntegerType()),
        T.StructField("start", T.LongType()), T.StructField("length", T.LongType()),
        T.StructField("ids_crc32", T.LongType()),
    ] + ([T.StructField("ids", T.BinaryType())] if keep_ids else [])
    closing = np.asarray([CLOSING_ID], "<u4").tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = _words(tokenizer_path)
        for batch in batches:
            for part in slices(batch, text_col):
                row, number, crc, length, raw = [], [], [], [], []
                for i, text in enumerate(texts_of(part.column(text_col))):
                    ids = words.text(text) + closing
                    for k, at in enumerate(range(0, len(ids), 4 * capacity)):
                        own = ids[at : at + 4 * capacity]
                        row.append(i)
                        number.append(k)
                        length.append(len(own) // 4)
                        crc.append(zlib.crc32(own))
                        raw.append(own)
                columns = [
                    part.column(id_col).take(pa.array(row, pa.int64())), pa.array(number, pa.int32()),
                    pa.array([k * capacity for k in number], pa.int64()), pa.array(length, pa.int64()),
                    pa.array(crc, pa.int64()),
                ] + ([pa.array(raw, pa.binary())] if keep_ids else [])
                yield pa.RecordBatch.from_arrays(columns, names=[f.name for f in fields])

    return df.select(id_col, text_col).mapInArrow(run, T.StructType(fields))


def _groups(counts: dict[int, int], groups: int) -> list[list[tuple[int, int]]]:
    """Deal (length, count), longest first, into groups of equal cardinality."""
    total = sum(counts.values())
    size = max(1, -(-total // groups))
    out: list[list[tuple[int, int]]] = [[]]
    room = size
    for length in sorted(counts, reverse=True):
        left = counts[length]
        while left:
            take = min(left, room)
            out[-1].append((length, take))
            left, room = left - take, room - take
            if not room:
                out.append([])
                room = size
    return [g for g in out if g]


def _knapsack(sizes: np.ndarray, values: np.ndarray, capacity: int) -> tuple[float, np.ndarray]:
    """The most valuable multiset of sizes within the capacity."""
    best = np.zeros(capacity + 1)
    pick = np.full(capacity + 1, -1)
    smallest = int(sizes.min())
    for k, (size, value) in enumerate(zip(sizes.tolist(), values.tolist(), strict=True)):
        for _ in range(capacity // size if value > 0 else 0):
            with_one = best[:-size] + value
            better = with_one > best[size:] + 1e-12
            if not better.any():
                break
            best[size:] = np.where(better, with_one, best[size:])
            pick[size:][better] = k
    config, room = np.zeros(len(sizes), np.int64), capacity
    while room >= smallest:
        if pick[room] < 0:
            room -= 1
        else:
            config[pick[room]] += 1
            room -= int(sizes[pick[room]])
    return best[capacity], config


def _configurations(sizes: np.ndarray, demand: np.ndarray, capacity: int, rounds: int = 1500) -> list[tuple[np.ndarray, int]]:
    """Configurations and how often to use them: the rounded-down solution of the configuration programme."""
    n = len(sizes)
    basis = np.diag((capacity // sizes).astype(float))
    amount = demand / (capacity // sizes)
    for _ in range(rounds):
        price = np.linalg.solve(basis.T, np.ones(n))
        value, config = _knapsack(sizes, np.maximum(price, 0), capacity)
        if value <= 1 + 1e-7:
            break
        step = np.linalg.solve(basis, config.astype(float))
        grows = step > 1e-9
        ratio = np.where(grows, amount / np.where(grows, step, 1), np.inf)
        leaves = int(ratio.argmin())
        theta = ratio[leaves]
        amount = np.maximum(amount - theta * step, 0)
        amount[leaves] = theta
        basis[:, leaves] = config
    return [(basis[:, k].astype(np.int64), int(np.floor(amount[k] + 1e-9))) for k in range(n)]


def plan(
    histogram: dict[int, int], capacity: int = CAPACITY, settings: tuple[tuple[int, int], ...] = SETTINGS,
) -> list[tuple[int, int, int, int, int, int]]:
    """The runs of the setting that needs the fewest sequences; planning time does not depend on the number of pieces."""
    return min((grouped_plan(histogram, capacity, *s) for s in settings), key=sequences_of)


def sequences_of(runs: list[tuple[int, int, int, int, int, int]]) -> int:
    return max((r[3] + -(-r[2] // r[5]) for r in runs), default=0)


def grouped_plan(histogram: dict[int, int], capacity: int, share: int, groups: int) -> list[tuple[int, int, int, int, int, int]]:
    """Runs (length, first rank, number, first sequence, offset, documents per sequence) that pack the histogram."""
    runs: list[tuple[int, int, int, int, int, int]] = []
    used: Counter[int] = Counter()
    rooms: dict[int, list[tuple[int, int]]] = {}
    sequences = 0

    def place(length: int, number: int, sequence: int, offset: int, each: int = 1) -> None:
        runs.append((length, used[length], number, sequence, offset, each))
        used[length] += number

    large = {n: c for n, c in histogram.items() if capacity // share < n < capacity and c}
    if histogram.get(capacity):
        place(capacity, histogram[capacity], 0, 0)
        sequences = histogram[capacity]
    if large:
        queues = [list(g) for g in _groups(large, groups)]
        sizes = np.array([g[0][0] for g in queues])
        demand = np.array([sum(c for _, c in g) for g in queues])
        left = demand.copy()
        for config, times in _configurations(sizes, demand.astype(float), capacity):
            slots = np.flatnonzero(config)
            if not len(slots):
                continue
            times = min([times, *(int(left[g] // config[g]) for g in slots)])
            left -= config * times
            while times:
                # Sequences in a row whose places all get documents of unchanging lengths.
                many = min([times, *(max(1, queues[g][0][1] // int(config[g])) for g in slots)])
                whole = all(queues[g][0][1] >= many * int(config[g]) for g in slots)
                many = many if whole else 1
                offset = 0
                for g in slots:
                    for _ in range(int(config[g])):
                        length, count = queues[g][0]
                        place(length, many, sequences, offset)
                        offset += length
                        queues[g][0] = (length, count - many)
                        if count == many:
                            queues[g].pop(0)
                rooms.setdefault(capacity - offset, []).append((sequences, many))
                sequences, times = sequences + many, times - many
    for length in sorted((n for n in histogram if n < capacity), reverse=True):
        left_here = histogram[length] - used[length]
        while left_here:
            room = min((r for r in rooms if r >= length), default=None)
            if room is None:
                each = capacity // length
                full, rest = divmod(left_here, each)
                if full:
                    place(length, full * each, sequences, 0, each)
                    rooms.setdefault(capacity - each * length, []).append((sequences, full))
                if rest:
                    place(length, rest, sequences + full, 0, rest)
                    rooms.setdefault(capacity - rest * length, []).append((sequences + full, 1))
                sequences += full + (rest > 0)
                break
            first, many = rooms[room].pop()
            take = min(many, left_here)
            place(length, take, first, capacity - room)
            if take < many:
                rooms[room].append((first + take, many - take))
            if not rooms[room]:
                del rooms[room]
            rooms.setdefault(room - length, []).append((first, take))
            left_here -= take
    return runs


def _ranked(stored: DataFrame, id_col: str, rank: str, total: int) -> DataFrame:
    """Number the pieces of each length from 0, in hashed cells whose sizes are summed up first."""
    cell = fresh(stored, "cell")
    cells = max(1, -(-total // CELL_ROWS))
    marked = stored.withColumn(cell, F.pmod(F.xxhash64(id_col, "piece"), F.lit(cells)))
    before = Window.partitionBy("length").orderBy(cell).rowsBetween(Window.unboundedPreceding, -1)
    sizes = (
        marked.groupBy("length", cell).agg(F.count("*").alias("n"))
        .select("length", cell, F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before"))
    )
    own = Window.partitionBy("length", cell).orderBy(id_col, "piece")
    return (
        marked.withColumn(rank, F.row_number().over(own) - 1).join(sizes, ["length", cell])
        .withColumn(rank, F.col(rank) + F.col("before")).drop(cell, "before")
    )


def pack(df: DataFrame, id_col: str = "doc_id", capacity: int = CAPACITY, settings: tuple[tuple[int, int], ...] = SETTINGS) -> DataFrame:
    """Append sequence_id and offset to the pieces that ``pieces`` made. They are written once, as two jobs read them."""
    path = scratch_path(df.sparkSession, "pieces")
    df.write.parquet(path)
    stored = df.sparkSession.read.parquet(path)
    histogram = {int(r["length"]): r["count"] for r in stored.groupBy("length").count().collect()}
    runs = sorted(plan(histogram, capacity, settings))
    table = np.array(runs, np.int64).reshape(-1, 6)
    rank = fresh(stored, "rank")
    ranked = _ranked(stored, id_col, rank, sum(histogram.values()))
    names = stored.columns
    fields = [*stored.schema.fields, T.StructField("sequence_id", T.LongType()), T.StructField("offset", T.LongType())]

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys = (table[:, 0] << 44) + table[:, 1]
        for batch in batches:
            length = batch.column("length").to_numpy()
            own = batch.column(rank).to_numpy()
            run = table[np.searchsorted(keys, (length << 44) + own, side="right") - 1]
            nth, place = np.divmod(own - run[:, 1], np.maximum(run[:, 5], 1))
            yield pa.RecordBatch.from_arrays(
                [batch.column(n) for n in names] + [pa.array(run[:, 3] + nth), pa.array(run[:, 4] + place * length)],
                names=[f.name for f in fields],
            )

    return ranked.select(*names, rank).mapInArrow(assign, T.StructType(fields))
