"""Distinct counts for any slice from one small table of bitmaps.

Keys are numbered densely. The slice table has, for every combination of slicer values and every 32,768 numbers, one bitmap of
4 KB with the keys seen there, beside sums that add up. Bitmaps of finer slices are merged by OR, so the exact number of keys
of any coarser slice or filter comes from this table alone; the fact is read once, when the table is made.
"""

from __future__ import annotations

from itertools import combinations

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..sources.tables import store
from .marts import sliced

NUMBER, BUCKET, KEYS = "_number", "_bucket", "_keys"


def numbered(keys: DataFrame, key: str, known: DataFrame | None = None) -> DataFrame:
    """(key, _number): the distinct non-NULL keys with numbers from 0 on; ``known`` ones keep theirs and new ones follow.

    Keys are sorted over many tasks and numbered within each; only the tasks' counts meet in one place.
    """
    new, base = keys.select(key).where(F.col(key).isNotNull()).distinct(), F.lit(0).cast("long")
    if known is not None:
        new = new.join(known.select(key), key, "left_anti")
        base = known.agg(F.coalesce(F.max(NUMBER) + 1, F.lit(0))).scalar()
    place = F.monotonically_increasing_id()
    dealt = new.repartitionByRange(F.col(key)).sortWithinPartitions(key).select(
        key, F.shiftright(place, 33).alias("_task"), place.bitwiseAND(F.lit((1 << 33) - 1)).alias("_place"),
    )
    dealt = store(dealt, "numbered")  # a second sort could deal the keys otherwise
    sizes = dealt.groupBy("_task").agg(F.count(F.lit(1)).alias("n"))
    before = Window.orderBy("_task").rowsBetween(Window.unboundedPreceding, -1)  # one row per task
    starts = sizes.select("_task", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("_start"))
    out = dealt.join(starts, "_task").select(key, (F.col("_start") + F.col("_place") + base).alias(NUMBER))
    return out if known is None else known.select(key, NUMBER).unionByName(out)


def slice_table(fact: DataFrame, numbers: DataFrame, key: str, slicers, sums: dict[str, Column]) -> DataFrame:
    """One row per combination of slicer values and bucket of numbers; rows without key are in a bucket of their own."""
    rows = fact.join(numbers, key, "left")
    bucket = F.bitmap_bucket_number(F.col(NUMBER)).alias(BUCKET)
    bits = F.bitmap_construct_agg(F.bitmap_bit_position(F.col(NUMBER))).alias(KEYS)
    return rows.groupBy(*slicers, bucket).agg(bits, *[c.alias(n) for n, c in sums.items()])


def by_slice(slices: DataFrame, by, sums, distinct: str, filters: dict | None = None) -> DataFrame:
    """The number of keys (column ``distinct``) and the sums per value of ``by``, after ``filters`` on any slicer."""
    per_bucket = sliced(slices, filters).groupBy(*by, BUCKET).agg(
        F.bitmap_count(F.bitmap_or_agg(KEYS)).alias("_distinct"), *[F.sum(c).alias(c) for c in sums]
    )
    return per_bucket.groupBy(*by).agg(F.sum("_distinct").alias(distinct), *[F.sum(c).alias(c) for c in sums])


def every_slice(slices: DataFrame, slicers, sums, distinct: str) -> DataFrame:
    """All combinations of slicers at once. ``level`` has a bit for each slicer that is rolled up, the first one highest."""
    sets = [[F.col(c) for c in chosen] + [F.col(BUCKET)] for n in range(len(slicers) + 1) for chosen in combinations(slicers, n)]
    level = sum((F.grouping(c).cast("long") * F.lit(1 << (len(slicers) - 1 - i)) for i, c in enumerate(slicers)), F.lit(0).cast("long"))
    per_bucket = slices.groupingSets(sets, *slicers, BUCKET).agg(
        level.alias("level"), F.bitmap_count(F.bitmap_or_agg(KEYS)).alias("_distinct"), *[F.sum(c).alias(f"_sum_{c}") for c in sums]
    )
    return per_bucket.groupBy(*slicers, "level").agg(F.sum("_distinct").alias(distinct), *[F.sum(f"_sum_{c}").alias(c) for c in sums])
