"""BPE against the library on whole texts, and exact round trips."""

import random

import public_tokenizers
import pytest
from hypothesis import given, settings, strategies as st

from strataflow.llm import bpe

RANKS, PATTERN = public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN

ALPHABET = "ab'sé1 \n\t  .,!-日́\U0001f600"


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet=ALPHABET, max_size=80))
def test_cuts_change_no_token(text):
    whole = bpe.encoding(RANKS, PATTERN).encode_ordinary(text)
    parts = []
    for piece, one in bpe.segments(text, 5):
        enc = bpe.encoding(RANKS, PATTERN)
        parts += enc._encode_single_piece(piece) if one else enc.encode_ordinary(piece)
    assert parts == whole


@pytest.mark.parametrize("run", [" ", "\n", " \n", "\t  "])
@pytest.mark.parametrize("before,after", [("", ""), ("a", ""), ("", "b"), ("a", "b"), ("a", "'s"), (" ", "1")])
def test_long_white_space(run, before, after):
    text = before + run * 1500 + after
    assert list(bpe.encode_text(text, RANKS, PATTERN)) == bpe.encoding(RANKS, PATTERN).encode_ordinary(text)


def test_very_long_texts():
    rng = random.Random(2)
    enc = bpe.encoding(RANKS, PATTERN)
    words = " ".join("".join(rng.choices("abcdeé'", k=rng.randint(1, 12))) for _ in range(60_000))
    for text in (words, "x" * 300_000, "\n" * 2_000_000, " " * 2_000_000 + "x", words[:70_000] + "\t" * 5_000 + words[:70_000]):
        ids = bpe.encode_text(text, RANKS, PATTERN)
        assert enc.decode_bytes(list(ids)) == text.encode()
    assert list(bpe.encode_text(words, RANKS, PATTERN)) == enc.encode_ordinary(words)


def test_rows(spark):
    texts = [None, "", "Hello  world's \n\n <|endoftext|> é日本", "Hello", "Hello"]
    df = spark.createDataFrame([(i, t, 3, "y") for i, t in enumerate(texts)], "doc_id long, text string, ids int, decoded string")
    got = bpe.decode(bpe.encode(df, RANKS, PATTERN), RANKS, PATTERN)
    assert got.columns == ["doc_id", "text", "ids", "decoded"]
    for row in got.collect():
        text = row["text"] or ""
        assert row["ids"] == bpe.encoding(RANKS, PATTERN).encode_ordinary(text)
        assert bytes(row["decoded"]) == text.encode()
    assert bpe.encode(df.limit(0), RANKS, PATTERN).count() == 0
    none = spark.createDataFrame([(None,), ([],), ([50],)], "ids array<int>")
    assert [bytes(r["decoded"]) for r in bpe.decode(none, RANKS, PATTERN).collect()][:2] == [b"", b""]
