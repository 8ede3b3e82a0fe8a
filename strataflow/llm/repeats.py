"""The distributed part that the two exact repeat removers share: which windows of a fixed length occur more than once.

A method (suffix buckets over bytes, difference-cover anchors over words) cuts the windows of each document into *cells*.
Windows with equal content lie at the same place of cells with equal *core*, the part common to all windows of a cell. The
*full* key of a cell stands for everything its windows cover. Four steps, each one pass over the texts:

1. Count cores. Cells whose core is unique are done: none of their windows repeats.
2. Count (core, full) for the rest. A repeated full key settles all windows of its cells. A core whose cells have different
   full keys is *mixed*.
3. Windows of unsettled cells of mixed cores are counted one by one, together with those of one settled cell of each full key.
4. Every document gets the mask of units that repeated windows cover.

Documents are dealt into batches of bounded bytes by a hash of the row's id, so a hot source or a large group of copies is
spread. A batch sends each key once, so a common passage costs one key per batch and not one per document; keys are
counted in buckets whose number follows the input. All steps use one shuffle of the texts. Core keys have 64 bits and a false
match costs work only; full and window keys have 128 bits.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F, types as T

from .common import fresh, texts_of

BATCH_BYTES = 4 << 20
CHUNK_BYTES = 96 << 10
# Bytes of text for each bucket of keys.
BUCKET_BYTES = 24 << 20

MIX = np.uint64(0x9E3779B97F4A7C15)
MIX_TOO = np.uint64(0xC2B2AE3D27D4EB4F)
DUPLICATED, MIXED, FIRST = 1, 2, 4

KEYS = "bucket int, batch long, level int, keys binary, flags binary"
FOUND = "batch long, level int, keys binary, flags binary"


def mix(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """A 64-bit identifier of the pair (a, b)."""
    t = a * MIX
    t ^= t >> np.uint64(29)
    t += b * MIX_TOO
    t ^= t >> np.uint64(32)
    return t


def twin(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Two identifiers of the pair (a, b), each of which alone nearly always tells pairs apart."""
    return np.stack([mix(a, b), mix(b, ~a)], axis=1)


@dataclass
class Cells:
    """Cells of a chunk of documents: keys, and the first and last window of each (positions in the chunk)."""

    core: np.ndarray
    full: np.ndarray  # two columns; zero where the cell has no full key
    has_full: np.ndarray
    low: np.ndarray
    high: np.ndarray

    def pair_keys(self) -> np.ndarray:
        return twin(mix(self.core, self.full[:, 0]), mix(self.full[:, 1], self.core))


@dataclass
class Method:
    """How documents become units, cells and windows. ``read`` gets the texts of a chunk."""

    window: int
    read: Callable[[list[bytes]], "Chunk"]


class Chunk:
    """Units of some documents in a row; ``starts`` has one entry more than there are documents."""

    starts: np.ndarray

    def cells(self) -> Cells:
        raise NotImplementedError

    def window_keys(self, at: np.ndarray) -> np.ndarray:
        raise NotImplementedError

    def release(self) -> None:
        """Give up what keys are made from; the rest is kept until a batch's results are written."""


def chunks(texts: list[bytes]) -> Iterator[list[bytes]]:
    start, held = 0, 0
    for i, text in enumerate(texts):
        if held and held + len(text) > CHUNK_BYTES:
            yield texts[start:i]
            start, held = i, 0
        held += len(text)
    if start < len(texts):
        yield texts[start:]


def _ranges(low: np.ndarray, high: np.ndarray) -> np.ndarray:
    """All distinct numbers in the closed ranges."""
    if not len(low):
        return np.empty(0, np.int64)
    sizes = high - low + 1
    first = np.repeat(low - np.concatenate([[0], np.cumsum(sizes)[:-1]]), sizes)
    return np.unique(first + np.arange(sizes.sum()))


def _sorted_rows(keys: np.ndarray) -> np.ndarray:
    return np.lexsort(keys.T[::-1])


def _unique(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct rows, and whether a row occurs more than once."""
    if not len(keys):
        return keys, np.empty(0, np.uint8)
    keys = keys[_sorted_rows(keys)]
    new = np.concatenate([[True], (keys[1:] != keys[:-1]).any(axis=1)])
    at = np.flatnonzero(new)
    return keys[at], (np.diff(np.append(at, len(keys))) > 1).astype(np.uint8)


def _blobs(batch: int, level: int, keys: np.ndarray, flags: np.ndarray, buckets: int) -> pa.Table:
    """One row per bucket with the keys that fall into it."""
    bucket = ((keys[:, 0] >> np.uint64(20)) % np.uint64(buckets)).astype(np.int64)
    order = np.argsort(bucket, kind="stable")
    keys, flags, bucket = keys[order], flags[order], bucket[order]
    cuts = np.flatnonzero(np.concatenate([[True], bucket[1:] != bucket[:-1]])) if len(bucket) else np.empty(0, np.int64)
    ends = np.append(cuts[1:], len(bucket)) if len(cuts) else cuts
    return _rows({
        "bucket": pa.array(bucket[cuts], pa.int32()), "batch": pa.array([batch] * len(cuts), pa.int64()),
        "level": pa.array([level] * len(cuts), pa.int32()),
        "keys": pa.array([keys[a:b].tobytes() for a, b in zip(cuts, ends, strict=True)], pa.binary()),
        "flags": pa.array([flags[a:b].tobytes() for a, b in zip(cuts, ends, strict=True)], pa.binary()),
    })


def _rows(columns: dict[str, pa.Array]) -> pa.Table:
    return pa.table(list(columns.values()), names=list(columns))


def _read(table: pa.Table, width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Keys and flags of all rows, and the row each belongs to."""
    blobs, flags = table.column("keys").to_pylist(), table.column("flags").to_pylist()
    keys = np.frombuffer(b"".join(blobs), np.uint64).reshape(-1, width)
    return keys, np.frombuffer(b"".join(flags), np.uint8), np.repeat(np.arange(len(blobs)), [len(f) for f in flags])


def _verdicts(table: pa.Table, keys: np.ndarray, flags: np.ndarray, row: np.ndarray, level: int) -> pa.Table:
    """Send chosen keys back to their batches; ``row`` rises."""
    cuts = np.searchsorted(row, np.arange(table.num_rows + 1))
    batches = table.column("batch").to_pylist()
    some = [i for i in range(table.num_rows) if cuts[i + 1] > cuts[i]]
    return _rows({
        "batch": pa.array([batches[i] for i in some], pa.int64()), "level": pa.array([level] * len(some), pa.int32()),
        "keys": pa.array([keys[cuts[i]:cuts[i + 1]].tobytes() for i in some], pa.binary()),
        "flags": pa.array([flags[cuts[i]:cuts[i + 1]].tobytes() for i in some], pa.binary()),
    })


def _repeated(width: int, level: int) -> Callable[[pa.Table], pa.Table]:
    """The keys of a bucket that occur more than once, for each batch that holds them."""

    def count(table: pa.Table) -> pa.Table:
        keys, flags, row = _read(table, width)
        order = _sorted_rows(keys)
        same = (keys[order][1:] == keys[order][:-1]).all(axis=1)
        twice = flags.astype(bool)
        twice[order[1:]] |= same
        twice[order[:-1]] |= same
        return _verdicts(table, keys[twice], flags[twice], row[twice], level)

    return count


def _settle(table: pa.Table) -> pa.Table:
    """Step 2 for a bucket: sort its cells by core and full key and tell each batch what its cells are."""
    keys, many, row = _read(table, 4)
    order = np.lexsort((row, keys[:, 2], keys[:, 1], keys[:, 0]))
    ordered, more = keys[order], many[order].astype(bool)
    new_core = np.concatenate([[True], ordered[1:, 0] != ordered[:-1, 0]])
    new_full = new_core | np.concatenate([[True], (ordered[1:, 1:3] != ordered[:-1, 1:3]).any(axis=1)])
    core, full = np.cumsum(new_core) - 1, np.cumsum(new_full) - 1
    has_full = ordered[:, 3].astype(bool)
    size = np.bincount(full) + np.bincount(full, weights=more).astype(np.int64)
    kinds = np.bincount(core, weights=new_full)
    bare = np.bincount(core, weights=~has_full) > 0
    state = (
        DUPLICATED * (has_full & (size[full] > 1)) + MIXED * ((kinds[core] > 1) | bare[core]) + FIRST * new_full
    ).astype(np.uint8)
    back = np.empty_like(state)
    back[order] = state
    pairs = twin(mix(keys[:, 0], keys[:, 1]), mix(keys[:, 2], keys[:, 0]))
    return _verdicts(table, pairs, back, row, 2)


def _known(found: pa.Table, level: int, width: int) -> tuple[np.ndarray, np.ndarray]:
    """What a batch was told at a level: keys in order, and their flags."""
    own = found.filter(pc.equal(found.column("level"), level))
    keys, flags, _ = _read(own, width)
    order = _sorted_rows(keys)
    return keys[order], flags[order]


def _lookup(known: np.ndarray, keys: np.ndarray) -> np.ndarray:
    """The place of each key among the known ones, or -1; the first column alone tells known keys apart."""
    if not len(known) or not len(keys):
        return np.full(len(keys), -1)
    at = np.searchsorted(known[:, 0], keys[:, 0])
    at[at == len(known)] = 0
    return np.where((known[at] == keys).all(axis=1), at, -1)


def _texts(docs: pa.Table, text_col: str) -> list[bytes]:
    return [t.encode("utf-8", "surrogatepass") for t in texts_of(docs.column(text_col))]


def _batch(docs: pa.Table, found: pa.Table | None, column: str) -> int:
    return (docs.column(column) if docs.num_rows else found.column("batch"))[0].as_py()


def repeated_units(
    df: DataFrame, id_col: str, text_col: str, method: Method, fields: list[T.StructField],
    results: Callable[[list[bytes], list[np.ndarray], list[Chunk]], list[pa.Array]],
) -> DataFrame:
    """Append ``fields``: ``results`` gets the texts of a batch, the masks of covered units of its chunks, and the chunks."""
    total = df.select(F.sum(F.octet_length(text_col)).alias("n")).first()["n"] or 0
    batches, buckets = max(1, -(-total // BATCH_BYTES)), max(1, -(-total // BUCKET_BYTES))
    batch = fresh(df, "batch")
    dealt = df.withColumn(batch, F.pmod(F.xxhash64(id_col, F.when(F.col(id_col).isNull(), F.col(text_col))), F.lit(batches)))
    docs = dealt.groupBy(batch)

    def step(found: DataFrame | None, level: int, keys_of) -> DataFrame:
        def run(table: pa.Table, told: pa.Table | None = None) -> pa.Table:
            keys, many = _unique(keys_of(_texts(table, text_col), told))
            return _blobs(_batch(table, told, batch), level, keys, many, buckets)

        if found is None:
            return docs.applyInArrow(lambda table: run(table), KEYS)
        return docs.cogroup(found.groupBy("batch")).applyInArrow(lambda table, told: run(table, told), KEYS)

    def joined(parts: list[np.ndarray], width: int) -> np.ndarray:
        return np.concatenate(parts) if parts else np.empty((0, width), np.uint64)

    def cores(texts: list[bytes], _) -> np.ndarray:
        return joined([method.read(part).cells().core[:, None] for part in chunks(texts)], 1)

    def fulls(texts: list[bytes], told: pa.Table) -> np.ndarray:
        known, _ = _known(told, 1, 1)
        out = []
        for part in chunks(texts) if len(known) else ():
            cells = method.read(part).cells()
            some = _lookup(known, cells.core[:, None]) >= 0
            out.append(np.column_stack([cells.core, cells.full, cells.has_full.astype(np.uint64)])[some])
        return joined(out, 4)

    def windows(texts: list[bytes], told: pa.Table) -> np.ndarray:
        known, state = _known(told, 2, 2)
        out = []
        for part in chunks(texts) if len(known) else ():
            chunk = method.read(part)
            cells = chunk.cells()
            at = _lookup(known, cells.pair_keys())
            own = np.where(at >= 0, state[at], 0)
            open_ = (own & MIXED > 0) & ((own & DUPLICATED == 0) | (own & FIRST > 0))
            out.append(chunk.window_keys(_ranges(cells.low[open_], cells.high[open_])))
        return joined(out, 2)

    first = step(None, 1, cores).groupBy("bucket").applyInArrow(_repeated(1, 1), FOUND)
    second = step(first, 2, fulls).groupBy("bucket").applyInArrow(_settle, FOUND)
    third = step(second, 3, windows).groupBy("bucket").applyInArrow(_repeated(2, 3), FOUND)

    new = {f.name.lower() for f in fields}
    kept = [f for f in df.schema.fields if f.name.lower() not in new]

    def finish(table: pa.Table, told: pa.Table) -> pa.Table:
        texts = _texts(table, text_col)
        known, state = _known(told, 2, 2)
        repeated, _ = _known(told, 3, 2)
        masks, parts = [], []
        for part in chunks(texts):
            chunk = method.read(part)
            edges = np.zeros(chunk.starts[-1] + 1, np.int32)
            if len(known):
                cells = chunk.cells()
                at = _lookup(known, cells.pair_keys())
                own = np.where(at >= 0, state[at], 0)
                settled = own & DUPLICATED > 0
                np.add.at(edges, cells.low[settled], 1)
                np.add.at(edges, cells.high[settled] + method.window, -1)
                open_ = (own & MIXED > 0) & ~settled
                places = _ranges(cells.low[open_], cells.high[open_])
                places = places[_lookup(repeated, chunk.window_keys(places)) >= 0]
                np.add.at(edges, places, 1)
                np.add.at(edges, places + method.window, -1)
            masks.append(np.cumsum(edges[:-1]) > 0)
            chunk.release()
            parts.append(chunk)
        made = results(texts, masks, parts)
        return pa.table([table.column(f.name) for f in kept] + made, names=[f.name for f in kept + fields])

    told = second.unionByName(third).groupBy("batch")
    return docs.cogroup(told).applyInArrow(lambda table, found: finish(table, found), T.StructType(kept + fields))
