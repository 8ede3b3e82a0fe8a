"""Substring dedup with difference-cover anchors.

A window is a fixed number of consecutive words. Word sequences are hashed only where their position in the document lies in
a difference cover modulo a period: for any two positions some shift below the period takes both into the cover, so
two equal windows share an aligned anchor, with a core of ``window - period + 1`` words inside both. Anchors with equal cores
are then extended: by a whole period to both sides at once, and window by window where that is not the same everywhere
(see ``repeats``). Removed is each word that a window covers whose words also start anywhere else.

Words are the stretches between ASCII white space, unchanged; matches never cross documents; windows are judged on the
input. Defined cases: null and empty texts have no words; documents shorter than a window keep all; repeated rows count as
documents of their own; columns named like an output are replaced.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, types as T

from .repeats import Cells, Chunk, Method, mix, repeated_units
from .words import Words

WINDOW = 35
# A perfect difference set, whose differences modulo 21 are all residues.
PERIOD = 21
COVER = (0, 1, 4, 14, 16)

_BASES = (0x9E3779B97F4A7C15 | 1, 0xD6E8FEB86659FD93 | 1)
_powers: list[np.ndarray] = []


def _power_tables(size: int) -> list[np.ndarray]:
    """Powers of both bases and of their inverses modulo 2**64."""
    if not _powers or len(_powers[0]) < size:
        size = max(size, 1 << 15) * 5 // 4
        _powers[:] = []
        for base in _BASES:
            for factor in (base, pow(base, -1, 1 << 64)):
                table = np.full(size, factor, np.uint64)
                table[0] = 1
                _powers.append(np.cumprod(table, dtype=np.uint64))
    return _powers


class WordChunk(Chunk):
    def __init__(self, texts: list[bytes], window: int):
        self.window = window
        self.words = Words(texts)
        self.starts = self.words.starts
        total = int(self.starts[-1])
        one = self.words.hashes()
        tables = _power_tables(total + 1)
        self.sums, self.back = [], []
        for hashes, table, inverse in ((one, tables[0], tables[1]), (mix(one, one), tables[2], tables[3])):
            self.sums.append(np.concatenate([np.zeros(1, np.uint64), np.cumsum(hashes * table[:total], dtype=np.uint64)]))
            self.back.append(inverse)

    def keys(self, at: np.ndarray, size: int, columns: int) -> np.ndarray:
        """Hashes of the ``size`` words from each position."""
        out = np.empty((len(at), columns), np.uint64)
        for k in range(columns):
            value = (self.sums[k][at + size] - self.sums[k][at]) * self.back[k][at]
            out[:, k] = mix(value, value >> np.uint64(7))
        return out

    def cells(self) -> Cells:
        core = self.window - PERIOD + 1
        place = np.arange(self.starts[-1])
        doc = np.repeat(np.arange(len(self.starts) - 1), np.diff(self.starts))
        begin, end = self.starts[:-1][doc], self.starts[1:][doc]
        in_cover = np.isin(np.arange(PERIOD), COVER)
        low, high = np.maximum(begin, place - PERIOD + 1), np.minimum(place, end - self.window)
        chosen = in_cover[(place - begin) % PERIOD] & (place + core <= end) & (low <= high)
        at, low, high, begin, end = place[chosen], low[chosen], high[chosen], begin[chosen], end[chosen]
        has_full = (at - PERIOD + 1 >= begin) & (at + self.window <= end)
        full = np.zeros((len(at), 2), np.uint64)
        full[has_full] = self.keys(at[has_full] - PERIOD + 1, self.window + PERIOD - 1, 2)
        return Cells(self.keys(at, core, 1)[:, 0], full, has_full, low, high)

    def window_keys(self, at: np.ndarray) -> np.ndarray:
        return self.keys(at, self.window, 2)

    def release(self) -> None:
        self.sums = self.back = None


def _results(texts: list[bytes], masks: list[np.ndarray], parts: list[WordChunk]) -> list[pa.Array]:
    words, gone, kept = [], [], []
    for part, mask in zip(parts, masks, strict=True):
        before = np.concatenate([[0], np.cumsum(mask)])
        words.append(np.diff(part.starts))
        gone.append(before[part.starts[1:]] - before[part.starts[:-1]])
        kept += part.words.joined(~mask)
    none = np.empty(0, np.int64)
    return [
        pa.array(np.concatenate([none, *words]), pa.int64()), pa.array(np.concatenate([none, *gone]), pa.int64()),
        pa.array(kept, pa.string()),
    ]


def remove_repeats(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW) -> DataFrame:
    """Append n_words, n_removed and kept (the words that stay, joined by one space). ``window`` exceeds the period."""
    if window <= PERIOD:
        raise ValueError(f"a window needs more than {PERIOD} words")
    fields = [
        T.StructField("n_words", T.LongType()), T.StructField("n_removed", T.LongType()), T.StructField("kept", T.StringType()),
    ]
    method = Method(window, lambda texts: WordChunk(texts, window))
    return repeated_units(df, id_col, text_col, method, fields, _results)
