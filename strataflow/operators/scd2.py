"""Slowly changing dimension, type 2, on plain tables.

A version table has the entity's columns plus PatientSK-like key, IsCurrent, EffectiveStartDate and
EffectiveEndDate. The open end is a fixed far date.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.keys import version_key
from .ordered import MAX_GROUP_ROWS, in_order

# End of an open version, and the columns whose change opens a new one.
OPEN_END = "9999-12-31 23:59:59"
PATIENT_TRACKED = ("AddressLine", "City", "PrimaryInsurancePayer")

START, END, CURRENT = "EffectiveStartDate", "EffectiveEndDate", "IsCurrent"


def open_end() -> Column:
    return F.lit(OPEN_END).cast("timestamp")


def any_changed(old: str, new: str, tracked) -> Column:
    """Any tracked column differs; NULL against a value is a change."""
    return reduce(
        lambda a, b: a | b, [~F.col(f"{old}.{c}").eqNullSafe(F.col(f"{new}.{c}")) for c in tracked]
    )


def any_unequal(old: str, new: str, tracked) -> Column:
    """Like any_changed but with plain inequality, blind to NULLs (for comparison only)."""
    unequal = [F.col(f"{old}.{c}") != F.col(f"{new}.{c}") for c in tracked]
    return F.coalesce(reduce(lambda a, b: a | b, unequal), F.lit(False))


def stage(
    df: DataFrame, key: str = "PatientID", updated: str = "UpdatedTimestamp",
    surrogate: str = "PatientSK",
) -> DataFrame:
    """Add the version columns: every row current and open."""
    return df.withColumns(
        {
            surrogate: version_key(key, updated),
            CURRENT: F.lit(True),
            START: F.col(updated),
            END: open_end(),
        }
    )


def _bound_versions(df: DataFrame, order) -> DataFrame:
    """End each version where the next begins, and mark the last one current."""
    closed = order.following(df, [START], "_next")
    return closed.withColumns(
        {END: F.coalesce(F.col(f"_next.{START}"), open_end()), CURRENT: F.col("_next").isNull()}
    ).drop("_next")


def _sequence(order, df: DataFrame, tracked, tied: bool = False) -> DataFrame:
    """Reduce rows in time order to versions and bound them.

    With ``tied`` several rows may share a start; the last in order stands. Rows equal to the version
    before them open nothing. All steps use one partitioning and one sort.
    """
    if tied:
        df = order.following(df, [START], "_next").where(
            ~F.col(f"_next.{START}").eqNullSafe(F.col(START))
        ).drop("_next")
    seen = order.previous(df, list(tracked), "_before").withColumn("_now", F.struct(*tracked))
    opening = F.col("_before").isNull() | any_changed("_before", "_now", tracked)
    return _bound_versions(seen.where(opening).drop("_before", "_now"), order)


def history_from_changelog(
    df: DataFrame, keys, tracked, tie_break=(), max_rows: int | None = MAX_GROUP_ROWS
) -> DataFrame:
    """Full version history of a change log that carries EffectiveStartDate.

    Neighbours with equal tracked values merge into one version. ``tie_break`` orders rows at one
    (key, start), of which the last stands; without it the caller vouches that they are unique.
    """
    def work(order, rows):
        return _sequence(order, rows, tracked, tied=bool(tie_break))

    return in_order(df, keys, [START, *tie_break], work, max_rows, sizes_from=df.select(*keys))


def _usable(batch: DataFrame, key: str, updated: str) -> DataFrame:
    return batch.where(F.col(key).isNotNull() & F.col(updated).isNotNull())


def _content(batch: DataFrame) -> Column:
    """Hash of a row's own columns, without audit columns, whose values differ from load to load."""
    return F.xxhash64(*[c for c in batch.columns if not c.startswith("_")])


def initial_load(
    batch: DataFrame, key: str = "PatientID", tracked=PATIENT_TRACKED,
    updated: str = "UpdatedTimestamp", surrogate: str = "PatientSK",
    max_rows: int | None = MAX_GROUP_ROWS,
) -> DataFrame:
    """First version table of a batch. A key that repeats becomes consecutive versions."""
    staged = stage(_usable(batch, key, updated), key, updated, surrogate)
    tied = staged.withColumn("_tie", _content(batch))
    return history_from_changelog(tied, [key], tracked, ["_tie"], max_rows).drop("_tie")


def apply_scd2(
    target: DataFrame, batch: DataFrame, key: str = "PatientID", tracked=PATIENT_TRACKED,
    updated: str = "UpdatedTimestamp", surrogate: str = "PatientSK",
    max_rows: int | None = MAX_GROUP_ROWS, small_batch: bool = False,
) -> DataFrame:
    """The version table after ``batch``: changed versions closed, successors opened, new keys added.

    The versions of a key and its batch rows are put in time order, so a late row, a key that repeats
    within the batch and a rerun of the same batch all come out right. At an equal start time the
    batch row replaces the existing version, whose surrogate key it shares.

    The target is shuffled once by key. For a batch that names few keys set ``small_batch``: rows of
    other keys then pass through a join with those keys, which Spark broadcasts if small enough.
    """
    staged = stage(_usable(batch, key, updated), key, updated, surrogate)
    arriving = staged.withColumns({"_from_batch": F.lit(1), "_tie": _content(batch)})
    if small_batch:
        touched = staged.select(key).distinct()
        untouched = target.join(touched, key, "left_anti")
        target = target.join(touched, key, "left_semi")
    existing = target.withColumns({"_from_batch": F.lit(0), "_tie": F.lit(0).cast("long")})
    rows = existing.unionByName(arriving, allowMissingColumns=True)
    sequenced = in_order(
        rows, [key], [START, "_from_batch", "_tie"],
        lambda order, part: _sequence(order, part, tracked, tied=True), max_rows,
        sizes_from=target.select(key).unionByName(staged.select(key)),
    ).drop("_from_batch", "_tie")
    return untouched.unionByName(sequenced, allowMissingColumns=True) if small_batch else sequenced


def merge_close_only(
    target: DataFrame, batch: DataFrame, key: str = "PatientID", tracked=PATIENT_TRACKED,
    updated: str = "UpdatedTimestamp", surrogate: str = "PatientSK",
) -> DataFrame:
    """Plain merge: close changed current rows, insert rows whose key has no current version.

    A changed key gets its new version only when the batch is merged again, NULLs never count as a
    change, and a late row closes with an end before its start. Kept to compare results; use apply_scd2.
    """
    staged = stage(batch, key, updated, surrogate)
    current, history = target.where(CURRENT), target.where(~F.col(CURRENT))
    source = staged.select(
        F.col(key).alias("_key"), F.struct(*tracked).alias("_new"), F.col(START).alias("_start")
    )
    matched = current.withColumn("_old", F.struct(*tracked)).join(
        source, F.col(key) == F.col("_key"), "left"
    )
    changed = any_unequal("_old", "_new", tracked)
    closed = matched.withColumns(
        {END: F.when(changed, F.col("_start")).otherwise(F.col(END)), CURRENT: ~changed}
    ).select(*target.columns)
    inserted = staged.join(current.select(key), key, "left_anti").select(*target.columns)
    return history.unionByName(closed).unionByName(inserted)


def version_stats(df: DataFrame) -> DataFrame:
    """Total versions and current versions, in one aggregation."""
    return df.agg(
        F.count(F.lit(1)).alias("total_versions"), F.count_if(F.col(CURRENT)).alias("current_versions")
    )


def violations(df: DataFrame, key: str, max_rows: int | None = MAX_GROUP_ROWS) -> DataFrame:
    """Rows of (key, problem, rows): keys with several or no current version, empty or overlapping
    versions. One ordered pass and one aggregation on the same partitioning."""

    def mark(order, part):
        ahead = order.following(part, [START], "_next")
        return ahead.withColumn("_overlap", F.col(f"_next.{START}") < F.col(END)).drop("_next")

    spans = df.select(key, START, END, CURRENT)
    marked = in_order(spans, [key], [START, END], mark, max_rows, sizes_from=df.select(key))
    current, empty = F.count_if(F.col(CURRENT)), F.count_if(F.col(START) >= F.col(END))
    counted = marked.groupBy(key).agg(
        F.when(current > 1, current).alias("several current"),
        F.when(current == 0, current).alias("no current"),
        F.nullif(empty, F.lit(0)).alias("empty version"),
        F.nullif(F.count_if("_overlap"), F.lit(0)).alias("overlap"),
    )
    problems = [c for c in counted.columns if c != key]
    return counted.select(
        key, F.inline(F.array(*[F.struct(F.lit(p).alias("problem"), F.col(p).alias("rows")) for p in problems]))
    ).where("rows IS NOT NULL")


def as_current(df: DataFrame) -> DataFrame:
    return df.where(F.col(CURRENT))
