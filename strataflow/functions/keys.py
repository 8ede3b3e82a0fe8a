"""Surrogate keys."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def utc_text(ts: Column) -> Column:
    """A timestamp as UTC text, whatever the session time zone is.

    Built from the microseconds since 1970: going through a local time would merge the two hours
    around a change of the clocks.
    """
    micros = F.unix_micros(ts)
    seconds = F.floor(micros / F.lit(1_000_000).cast("decimal(20,0)")).cast("long")
    day = F.date_add(F.lit("1970-01-01").cast("date"), F.floor(seconds / F.lit(86_400).cast("decimal(20,0)")).cast("int"))
    rest = F.pmod(seconds, F.lit(86_400))
    clock = F.concat_ws(":", *[
        F.lpad(F.floor(part).cast("string"), 2, "0") for part in (rest / 3600, (rest % 3600) / 60, rest % 60)
    ])
    fraction = F.rtrim(F.lpad(F.pmod(micros, F.lit(1_000_000)).cast("string"), 6, "0"), F.lit("0"))
    return F.concat(day.cast("string"), F.lit(" "), clock, F.when(fraction != "", F.concat(F.lit("."), fraction)).otherwise(""))


def business_key(key: str) -> Column:
    """Hash of the business key; NULL stays NULL."""
    return F.md5(F.col(key))


def version_key(key: str, version_time: str) -> Column:
    """Hash of business key and version time; NULL in either gives NULL."""
    return F.when(
        F.col(key).isNotNull() & F.col(version_time).isNotNull(),
        F.md5(F.concat_ws("||", F.col(key), utc_text(F.col(version_time)))),
    )
