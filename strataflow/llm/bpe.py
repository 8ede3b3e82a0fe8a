"""Byte-level BPE encoding and decoding with a local rank file.

The text is cut by the vocabulary's pattern and each match is merged by rank, as the tiktoken library does. Long texts
are handed over in segments that end at safe boundaries: the pattern reads from left to right and looks ahead only
behind white space, so a cut before white space that follows another character changes no match. A white-space run
between two segments is cut as the pattern would: all but its last character is one match when something follows.
Special tokens are never recognised. Decoding joins the tokens' raw bytes, so any id sequence can be decoded.

Defined cases: a null or empty text has no tokens and decodes to zero bytes; rows may repeat and come out as often;
other columns pass unchanged, except those named like an output, which are replaced.
"""

from __future__ import annotations

import base64
import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, types as T

from .common import add_columns, list_array, texts_of

SEGMENT_CHARS = 50_000
LONG_SPACE = 1_000
# White space as the pattern's \s has it.
_SPACE = r"\x09-\x0d\x20\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
_BOUNDARY = re.compile(f"[^{_SPACE}][{_SPACE}]")
_LONG_SPACE = re.compile(f"[{_SPACE}]{{{LONG_SPACE},}}")


@lru_cache(maxsize=4)
def encoding(rank_file: str, pattern: str):
    """The tiktoken encoding of a rank file, built once per worker."""
    import tiktoken

    with open(rank_file, "rb") as lines:
        ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
    return tiktoken.Encoding("local", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})


def segments(text: str, size: int = SEGMENT_CHARS) -> Iterator[tuple[str, bool]]:
    """Cut ``text`` without changing any match: (piece, whether the piece is one match in itself)."""
    start = 0
    for run in _LONG_SPACE.finditer(text):
        begin, end = run.span()
        yield from ((p, False) for p in _cut(text[start:begin], size))
        # Followed by something, the last white-space character starts the next match or is one.
        start = end if end == len(text) else end - 1
        yield text[begin:start], True
    yield from ((p, False) for p in _cut(text[start:], size))


def _cut(text: str, size: int) -> Iterator[str]:
    start = 0
    while len(text) - start > size:
        found = _BOUNDARY.search(text, start + size - 1)
        if not found:
            break
        yield text[start : found.start() + 1]
        start = found.start() + 1
    if start < len(text):
        yield text[start:]


def encode_text(text: str, rank_file: str, pattern: str, segment_chars: int = SEGMENT_CHARS) -> np.ndarray:
    enc = encoding(rank_file, pattern)
    if len(text) <= LONG_SPACE:
        return np.asarray(enc.encode_ordinary(text), np.int32)
    parts = [
        enc._encode_single_piece(piece) if whole else enc.encode_ordinary(piece)
        for piece, whole in segments(text, segment_chars)
    ]
    return np.concatenate([np.asarray(p, np.int32) for p in parts]) if parts else np.empty(0, np.int32)


def encode(
    df: DataFrame, rank_file: str, pattern: str, text_col: str = "text", segment_chars: int = SEGMENT_CHARS,
) -> DataFrame:
    """Append ``ids`` array<int>, the tokens of each whole text."""

    def work(part: pa.RecordBatch) -> list[pa.Array]:
        ids = [encode_text(t, rank_file, pattern, segment_chars) for t in texts_of(part.column(text_col))]
        joined = np.concatenate(ids) if ids else np.empty(0, np.int32)
        return [list_array(map(len, ids), pa.array(joined, pa.int32()))]

    return add_columns(df, text_col, [T.StructField("ids", T.ArrayType(T.IntegerType()))], work)


def decode(df: DataFrame, rank_file: str, pattern: str, ids_col: str = "ids") -> DataFrame:
    """Append ``decoded`` binary, the joined bytes of the tokens; null ids decode to zero bytes."""
    fields = [f for f in df.schema.fields if f.name.lower() != "decoded"]
    names = [f.name for f in fields]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoding(rank_file, pattern)
        for batch in batches:
            for i in range(0, batch.num_rows, 500):
                part = batch.slice(i, 500)
                raw = [enc.decode_bytes(ids or []) for ids in part.column(ids_col).to_pylist()]
                yield pa.RecordBatch.from_arrays(
                    [part.column(n) for n in names] + [pa.array(raw, pa.binary())], names=names + ["decoded"]
                )

    return df.mapInArrow(run, T.StructType([*fields, T.StructField("decoded", T.BinaryType())]))
