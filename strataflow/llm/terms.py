"""Terms of whole texts as UTF-8 bytes: stretches of given ASCII characters and of all characters beyond ASCII."""

from __future__ import annotations

from collections.abc import Iterator

# Bytes of text that are split into terms at once.
PIECE = 1 << 20


def byte_table(ascii_letters: str) -> bytes:
    """A table for bytes.translate: A-Z in lower case, white space for all ASCII that belongs to no term."""
    kept = set(ascii_letters.encode())
    return bytes(b + 32 if 65 <= b <= 90 else b if b >= 128 or b in kept else 32 for b in range(256))


# What the contracts' patterns [^...]+ leave of ASCII.
LETTERS = byte_table("abcdefghijklmnopqrstuvwxyz")
LETTERS_AND_DIGITS = byte_table("abcdefghijklmnopqrstuvwxyz0123456789")


def terms_of(text: str, table: bytes) -> Iterator[list[bytes]]:
    """The terms of a text, in order, in lists of about PIECE bytes; no term is cut."""
    data = text.encode("utf-8", "replace").translate(table)
    start = 0
    while len(data) - start > PIECE:
        cut = data.rfind(b" ", start, start + PIECE)
        if cut < start:
            cut = data.find(b" ", start + PIECE)
            if cut < 0:
                break
        yield data[start:cut].split()
        start = cut + 1
    yield (data[start:] if start else data).split()
