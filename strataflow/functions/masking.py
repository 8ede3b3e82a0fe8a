"""Masking of personal columns in serving views."""

from __future__ import annotations

import hashlib

from pyspark.sql import Column, DataFrame, functions as F

# The columns that hold personal data.
PHI_COLUMNS = ("FirstName", "LastName", "AddressLine")

POLICIES = {
    "mask": lambda c: F.mask(F.col(c)),
    # Equal names stay equal, but whoever has a list of names can look them up: see "keyed".
    "hash": lambda c: F.sha2(F.col(c), 256),
    "null": lambda c: F.lit(None).cast("string"),
}


def pads(secret: bytes) -> tuple[bytes, bytes]:
    """The inner and the outer key block of HMAC-SHA256."""
    key = (hashlib.sha256(secret).digest() if len(secret) > 64 else secret).ljust(64, b"\0")
    return bytes(b ^ 0x36 for b in key), bytes(b ^ 0x5C for b in key)


def keyed_hash(col: Column, secret: bytes) -> Column:
    """HMAC-SHA256 of a text column as hex. The secret is part of the plan: keep explain output as safe as the secret."""
    if not secret:
        raise ValueError("a keyed hash needs a secret")
    inner, outer = (F.lit(bytearray(p)) for p in pads(secret))
    return F.sha2(F.concat(outer, F.unhex(F.sha2(F.concat(inner, F.encode(col, "UTF-8")), 256))), 256)


def mask_columns(df: DataFrame, cols=PHI_COLUMNS, policy: str = "mask", secret: bytes | None = None) -> DataFrame:
    """The columns masked by a policy of POLICIES, or by keyed hashes ("keyed"), which need the secret."""
    apply = (lambda c: keyed_hash(F.col(c), secret or b"")) if policy == "keyed" else POLICIES[policy]
    return df.withColumns({c: apply(c) for c in cols if c in df.columns})
