"""Suffix-array dedup by bucket-pointer refinement.

Suffixes start in buckets of equal 8-byte q-grams; the q-gram itself is the first bucket pointer. A bucket is refined by the
bucket pointers of its suffixes at a later offset: the pointer for 2h bytes at a position is the pair of the pointers for h
bytes there and h bytes further on, and every refined pointer is used again for the next one (8, 16, ... 256 bytes), so one
recursion per doubling replaces comparisons of text. Pointers are 64-bit identifiers of such pairs, hence the same
everywhere, and any depth up to three times that of the last pointers is two or three overlapping ones. The last depth, the size of a
cell and that of an anchor follow from the window.

Only what the question needs is sorted over all documents: does a string of ``window`` bytes start anywhere else? Windows
choose the same suffix wherever they occur, the one with the smallest 32-byte pointer inside, and windows with
neighbouring distances to it form a cell. The suffixes' buckets at core depth (common to a cell's windows) are
sorted first, unique ones drop out, the rest is refined by the pointers at full depth, and what is still undecided at the exact
depth of each window (see ``repeats``).

Texts are UTF-8 bytes; matches never cross documents, overlapping ones count, and strings are judged on the input.
Defined cases: a null text is empty; documents shorter than a window keep all; repeated rows count as documents of their own;
columns named like an output are replaced.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, types as T

from .common import list_array
from .repeats import MIX, Cells, Chunk, Method, mix, repeated_units, twin

WINDOW = 400
GRAM = 8
ANCHOR_BYTES = 32
LEAST_WINDOW = 32

SPANS = T.ArrayType(T.StructType([T.StructField("start", T.LongType()), T.StructField("end", T.LongType())]))


def _sliding_min(values: np.ndarray, size: int) -> np.ndarray:
    """The minimum of each ``size`` values in a row, from every position."""
    blocks = -(-(len(values) + size) // size)
    padded = np.full(blocks * size, np.iinfo(values.dtype).max, values.dtype)
    padded[: len(values)] = values
    table = padded.reshape(blocks, size)
    ahead = np.minimum.accumulate(table, axis=1).ravel()
    behind = np.minimum.accumulate(table[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(behind[: len(values)], ahead[size - 1 : size - 1 + len(values)])


def sizes_of(window: int) -> tuple[int, int, int]:
    """Windows of a cell, bytes of the last pointers (a power of two) and of an anchor."""
    cell = window * 4 // 25
    depth = 1 << (window - cell + 1).bit_length() - 1
    return cell, depth, max(GRAM, min(ANCHOR_BYTES, depth // 4))


class ByteChunk(Chunk):
    def __init__(self, texts: list[bytes], window: int):
        self.window = window
        self.cell, self.depth, self.anchor_bytes = sizes_of(window)
        self.starts = np.concatenate([[0], np.cumsum([len(t) for t in texts])]).astype(np.int64)
        self.pointers = None
        if max(map(len, texts), default=0) >= window:
            self._refine(b"".join(texts))

    def _refine(self, data: bytes) -> None:
        padded = np.zeros(len(data) + 2 * self.depth, np.uint8)
        padded[: len(data)] = np.frombuffer(data, np.uint8)
        pointers = np.ndarray(len(padded) - GRAM + 1, "<u8", padded, strides=(1,))
        depth = GRAM
        while True:
            if depth == self.anchor_bytes:
                rank = (pointers[: len(data)] * MIX) & np.uint64(0xFFFFFFFF00000000)
            if depth == self.depth:
                break
            pointers = mix(pointers[:-depth], pointers[depth:])
            depth *= 2
        self.pointers = pointers
        least = _sliding_min(rank | np.arange(len(data), dtype=np.uint64), self.window - self.anchor_bytes + 1)
        self.anchor = (least & np.uint64(0xFFFFFFFF)).astype(np.int64)

    def release(self) -> None:
        self.pointers = self.anchor = None

    def _none(self) -> Cells:
        none = np.empty(0, np.int64)
        return Cells(np.empty(0, np.uint64), np.empty((0, 2), np.uint64), np.empty(0, bool), none, none)

    def cells(self) -> Cells:
        if self.pointers is None:
            return self._none()
        begin, end = self.starts[:-1], self.starts[1:]
        counts = np.maximum(end - begin - self.window + 1, 0)
        place = np.repeat(begin - np.concatenate([[0], np.cumsum(counts)[:-1]]), counts) + np.arange(counts.sum())
        anchor = self.anchor[place]
        cell = (anchor - place) // self.cell
        first = np.concatenate([[True], (anchor[1:] != anchor[:-1]) | (cell[1:] != cell[:-1])])
        cuts = np.flatnonzero(first)
        low, high = place[cuts], place[np.append(cuts[1:], len(place)) - 1]
        anchor, cell = anchor[cuts], cell[cuts]
        doc = np.searchsorted(self.starts, low, side="right") - 1
        last = anchor - cell * self.cell
        earliest = last - self.cell + 1
        core = self._pair(last, self.window - self.cell + 1)
        has_full = (earliest >= begin[doc]) & (last + self.window <= end[doc])
        full = np.zeros((len(low), 2), np.uint64)
        full[has_full] = self._pair(earliest[has_full], self.window + self.cell - 1)
        # The distance to the anchor is part of the key: cells of two anchors may lie on one another.
        return Cells(mix(mix(core[:, 0], core[:, 1]), cell.astype(np.uint64)), full, has_full, low, high)

    def _pair(self, at: np.ndarray, depth: int) -> np.ndarray:
        """The pointers of ``depth`` bytes from each position: two overlapping ones, or three where two are too short."""
        first, last = self.pointers[at], self.pointers[at + depth - self.depth]
        if depth > 2 * self.depth:
            last = mix(self.pointers[at + self.depth], last)
        return np.stack([first, last], axis=1)

    def window_keys(self, at: np.ndarray) -> np.ndarray:
        if not len(at):
            return np.empty((0, 2), np.uint64)
        pair = self._pair(at, self.window)
        return twin(pair[:, 0], pair[:, 1])


def _results(texts: list[bytes], masks: list[np.ndarray], _) -> list[pa.Array]:
    data = np.frombuffer(b"".join(texts), np.uint8)
    sizes = np.array([len(t) for t in texts], np.int64)
    starts = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int64)
    removed = np.concatenate(masks) if masks else np.empty(0, bool)
    before = np.concatenate([[0], np.cumsum(removed)])
    gone = before[starts[1:]] - before[starts[:-1]]
    # Runs of removed bytes, cut at the ends of documents.
    opens = removed & ~np.concatenate([[False], removed[:-1]])
    closes = removed & ~np.concatenate([removed[1:], [False]])
    inner = starts[:-1][sizes > 0]
    opens[inner] = removed[inner]
    closes[inner[1:] - 1] = removed[inner[1:] - 1]
    at, to = np.flatnonzero(opens), np.flatnonzero(closes) + 1
    doc = np.searchsorted(starts, at, side="right") - 1
    spans = np.bincount(doc, minlength=len(texts))
    kept = data[~removed].tobytes()
    ends = np.cumsum(sizes - gone)
    parts = [kept[e - n : e] for e, n in zip(ends.tolist(), (sizes - gone).tolist(), strict=True)]
    return [
        pa.array(sizes, pa.int64()), pa.array(gone, pa.int64()), pa.array(spans, pa.int64()), pa.array(parts, pa.binary()),
        list_array(spans.tolist(), pa.StructArray.from_arrays(
            [pa.array(at - starts[doc], pa.int64()), pa.array(to - starts[doc], pa.int64())], names=["start", "end"]
        )),
    ]


def remove_repeats(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW) -> DataFrame:
    """Append n_bytes, n_removed, n_spans, kept (binary) and removed (byte spans). ``window`` has at least 32 bytes."""
    fields = [
        T.StructField("n_bytes", T.LongType()), T.StructField("n_removed", T.LongType()), T.StructField("n_spans", T.LongType()),
        T.StructField("kept", T.BinaryType()), T.StructField("removed", SPANS),
    ]
    return repeated_units(df, id_col, text_col, _method(window), fields, _results)


def _method(window: int) -> Method:
    if window < LEAST_WINDOW:
        raise ValueError(f"a window needs at least {LEAST_WINDOW} bytes")
    return Method(window, lambda texts: ByteChunk(texts, window))


def _whole_characters(texts: list[bytes], masks: list[np.ndarray], _) -> list[pa.Array]:
    """The texts without every character that lost a byte."""
    data = np.frombuffer(b"".join(texts), np.uint8)
    removed = np.concatenate(masks) if masks else np.empty(0, bool)
    character = np.cumsum((data & 0xC0) != 0x80) - 1
    hit = np.zeros(int(character[-1]) + 1 if len(character) else 0, bool)
    hit[character[removed]] = True
    out, at = [], 0
    for text in texts:
        own = slice(at, at + len(text))
        at = own.stop
        out.append(data[own][~hit[character[own]]].tobytes().decode("utf-8"))
    return [pa.array(out, pa.string())]


def remove_from_text(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW) -> DataFrame:
    """Append kept_text: the text without repeated bytes and without the characters they cut into."""
    return repeated_units(df, id_col, text_col, _method(window), [T.StructField("kept_text", T.StringType())], _whole_characters)
