"""Words between ASCII white space, found and hashed for many documents at once."""

from __future__ import annotations

import numpy as np
import xxhash

from .repeats import mix

# The bytes 09 to 0D and 20 separate words.
_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
# Masks that keep the first bytes of a little-endian word.
_FIRST = np.array([(1 << 8 * n) - 1 for n in range(9)], np.uint64)
_LONG = 256


class Words:
    """The words of some documents in a row. Document i has the words ``starts[i]`` to ``starts[i + 1]``."""

    def __init__(self, texts: list[bytes]):
        joined = b"\n".join(texts) + b"\n"
        self.padded = np.zeros(len(joined) + 8, np.uint8)
        self.data = self.padded[: len(joined)]
        self.data[:] = np.frombuffer(joined, np.uint8)
        space = _SPACE[self.data]
        edges = np.flatnonzero(space[1:] != space[:-1]) + 1
        if not space[0]:
            edges = np.concatenate([[0], edges])
        # Texts end with a separator, so begins and ends take turns.
        self.begin, self.end = edges[::2], edges[1::2]
        self.documents = np.concatenate([[0], np.cumsum([len(t) + 1 for t in texts])]).astype(np.int64)
        self.starts = np.searchsorted(self.begin, self.documents).astype(np.int64)

    def hashes(self) -> np.ndarray:
        """A 64-bit hash of each word, eight bytes at a time."""
        size = self.end - self.begin
        eight = np.ndarray(len(self.data), "<u8", self.padded, strides=(1,))
        out = mix(size.astype(np.uint64), size.astype(np.uint64))
        some, at = np.arange(len(size)), 0
        while len(some):
            left = size[some] - at
            out[some] = mix(out[some], eight[self.begin[some] + at] & _FIRST[np.minimum(left, 8)])
            at += 8
            some = some[(left > 8) & (size[some] <= _LONG)]
        for k in np.flatnonzero(size > _LONG):
            out[k] = xxhash.xxh3_64_intdigest(self.data[self.begin[k] : self.end[k]].tobytes())
        return out

    def joined(self, keep: np.ndarray) -> list[str]:
        """Each document's kept words, joined by one space."""
        first = np.zeros(len(keep) + 1, bool)
        counted = np.concatenate([[0], np.cumsum(keep)])
        # The first kept word of a document has no space before it.
        leads = np.searchsorted(counted, counted[self.starts[:-1]], side="right") - 1
        first[leads] = True
        begin, end = self.begin[keep], self.end[keep]
        edges = np.zeros(len(self.data) + 1, np.int8)
        edges[begin] += 1
        edges[end] -= 1
        chosen = np.cumsum(edges[:-1], dtype=np.int8).astype(bool)
        spaced = begin[~first[:-1][keep]] - 1
        chosen[spaced] = True
        text = self.data.copy()
        text[spaced] = 32
        sizes = np.concatenate([[0], np.cumsum(chosen)])[self.documents]
        raw = text[chosen].tobytes()
        return [raw[a:b].decode("utf-8", "replace") for a, b in zip(sizes[:-1].tolist(), sizes[1:].tolist(), strict=True)]
