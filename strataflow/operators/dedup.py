"""Keep-latest de-duplication and grain checks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F


def _all_present(keys) -> Column:
    present = F.col(keys[0]).isNotNull()
    for key in keys[1:]:
        present = present & F.col(key).isNotNull()
    return present


def split_null_keys(df: DataFrame, keys) -> tuple[DataFrame, DataFrame]:
    """Rows with a complete key, and rows without one."""
    present = _all_present(keys)
    return df.where(present), df.where(~present)


def keep_latest(df: DataFrame, keys, newest_first) -> DataFrame:
    """One row per key: the first under ``newest_first``, with all other columns as tie-break.

    The tie-break makes the order total up to identical rows, so the result does not depend on
    partitioning. Spark applies the rank limit before the shuffle as well (WindowGroupLimit), so a
    key that holds a large share of the rows sends at most one row per map task.
    Rows with a NULL key would all compete for one place: split them off first.
    """
    return _first_per(df, keys, newest_first)


def _first_per(df: DataFrame, group, newest_first) -> DataFrame:
    order = [F.col(c).desc() if isinstance(c, str) else c for c in newest_first]
    named = {c for c in newest_first if isinstance(c, str)}
    ties = [F.col(c).asc_nulls_last() for c in df.columns if c not in named and c not in group]
    window = Window.partitionBy(*group).orderBy(*order, *ties)
    return df.withColumn("_rank", F.row_number().over(window)).where("_rank = 1").drop("_rank")


def keep_latest_with_nulls(df: DataFrame, keys, newest_first) -> DataFrame:
    """keep_latest, with every NULL-key row passed through so that the rules can count it.

    A row without a complete key gets a group of its own, so the input is read once.
    """
    alone = F.when(~_all_present(keys), F.monotonically_increasing_id())
    marked = df.withColumn("_alone", alone)
    return _first_per(marked, [*keys, "_alone"], newest_first).drop("_alone")


def duplicates(df: DataFrame, keys) -> DataFrame:
    """Keys that occur more than once, with their count."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("copies")).where("copies > 1")


def require_unique(df: DataFrame, keys) -> DataFrame:
    """The DataFrame itself, or an error when ``keys`` do not identify its rows."""
    if not duplicates(df, keys).isEmpty():
        raise ValueError(f"rows are not unique by {list(keys)}")
    return df
