"""Previous, next and last-seen values per key, in order, without one task per hot key.

A window function puts all rows of a key into one task. That is right for keys of ordinary size. Keys
with more than ``max_rows`` rows are range-partitioned by (key, order) instead and cut into slices of at most
``max_rows`` rows, the window runs within each slice, and a small table of slice edges carries the values across
slice borders. Both ways give the same rows. The sliced rows are written to the shared scratch folder first: range
borders come from a sample, so the slice of a row must be settled once before two branches of a plan rely on it.

A sorted range holds as many slices as it takes, so there are no more ranges than a shuffle has partitions. Sample,
tasks and files grow with the ranges, not with the slices: the sample and the tasks' reports go to the driver.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..session import scratch_path

# A group this large still sorts and spills comfortably in one task.
MAX_GROUP_ROWS = 5_000_000

_SLICE = "_slice"


def _on_keys(other: DataFrame, keys) -> tuple[DataFrame, Column]:
    """The other side of a join by ``keys`` under new names, and the condition; NULL equals NULL."""
    renamed = other.withColumnsRenamed({k: f"_other_{i}" for i, k in enumerate(keys)})
    return renamed, reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"_other_{i}")) for i, k in enumerate(keys)])


class InOrder:
    """Ordered access to the neighbours of a row within its key."""

    def __init__(self, keys, order, slices: int = 0, slice_rows: int = MAX_GROUP_ROWS):
        self.keys, self.order, self.slices, self.slice_rows = list(keys), list(order), slices, slice_rows
        self.group = [*self.keys, _SLICE] if slices else self.keys
        self.window = Window.partitionBy(*self.group).orderBy(*self.order)
        self.across = Window.partitionBy(*self.keys).orderBy(_SLICE)

    def start(self, df: DataFrame) -> DataFrame:
        if not self.slices:
            return df
        spark, path = df.sparkSession, scratch_path(df.sparkSession, "slices")
        by = [*self.keys, *self.order]
        ranges = min(self.slices, int(spark.conf.get("spark.sql.shuffle.partitions")))
        ranged = df.repartitionByRange(ranges, *by).sortWithinPartitions(*by)
        # The range's number in the upper bits, the row's place in the range below: slices number along both.
        place = F.col("_place")
        number = place - F.pmod(F.pmod(place, F.lit(1 << 33)), F.lit(self.slice_rows))
        numbered = ranged.withColumn("_place", F.monotonically_increasing_id())
        numbered.withColumn(_SLICE, number).drop("_place").write.parquet(path)
        return spark.read.parquet(path)

    def finish(self, df: DataFrame) -> DataFrame:
        return df.drop(_SLICE)

    def _carry(self, df: DataFrame, edges: DataFrame, out: str) -> DataFrame:
        return (
            df.join(*_on_keys(edges, self.group), "left")
            .withColumn(out, F.coalesce(F.col(out), F.col("_carried")))
            .select(*df.columns)
        )

    def previous(self, df: DataFrame, cols, out: str) -> DataFrame:
        """Struct of ``cols`` from the row before; NULL at the first row of a key."""
        value = F.struct(*cols)
        result = df.withColumn(out, F.lag(value).over(self.window))
        if not self.slices:
            return result
        edges = df.groupBy(*self.group).agg(
            F.max_by(value, F.struct(*self.order)).alias("_edge")
        )
        edges = edges.withColumn("_carried", F.lag("_edge").over(self.across)).drop("_edge")
        return self._carry(result, edges, out)

    def following(self, df: DataFrame, cols, out: str) -> DataFrame:
        """Struct of ``cols`` from the row after; NULL at the last row of a key."""
        value = F.struct(*cols)
        result = df.withColumn(out, F.lead(value).over(self.window))
        if not self.slices:
            return result
        edges = df.groupBy(*self.group).agg(
            F.min_by(value, F.struct(*self.order)).alias("_edge")
        )
        edges = edges.withColumn("_carried", F.lead("_edge").over(self.across)).drop("_edge")
        return self._carry(result, edges, out)

    def last_seen(self, df: DataFrame, col: str, out: str) -> DataFrame:
        """The latest non-NULL ``col`` up to and including the row."""
        rows = self.window.rowsBetween(Window.unboundedPreceding, Window.currentRow)
        result = df.withColumn(out, F.last(col, ignorenulls=True).over(rows))
        if not self.slices:
            return result
        seen = F.when(F.col(col).isNotNull(), F.struct(*self.order))
        edges = df.groupBy(*self.group).agg(F.max_by(F.col(col), seen).alias("_edge"))
        before = self.across.rowsBetween(Window.unboundedPreceding, -1)
        edges = edges.withColumn(
            "_carried", F.last("_edge", ignorenulls=True).over(before)
        ).drop("_edge")
        return self._carry(result, edges, out)


def in_order(
    df: DataFrame, keys, order, work: Callable[[InOrder, DataFrame], DataFrame],
    max_rows: int | None = MAX_GROUP_ROWS, sizes_from: DataFrame | None = None,
) -> DataFrame:
    """Apply ``work`` to the rows of every key in order.

    One map-side combined count over the key columns finds the keys above ``max_rows``; there can be
    at most (rows / max_rows) of them. ``sizes_from`` may name a cheaper table with the same or more
    rows per key to count instead. ``max_rows=None`` skips the count where group sizes are known to be
    small. ``order`` must be unique within a key.
    """
    plain = InOrder(keys, order)
    if max_rows is None:
        return work(plain, df)
    counted = (df if sizes_from is None else sizes_from).groupBy(*keys)
    large = counted.agg(F.count(F.lit(1)).alias("_rows")).where(F.col("_rows") > max_rows)
    total = large.agg(F.sum("_rows").alias("n")).first().n
    if not total:
        return work(plain, df)
    large = large.select(*keys)
    sliced = InOrder(keys, order, 1 + -(-total // max_rows), max_rows)
    hot = sliced.start(df.join(*_on_keys(large, keys), "left_semi"))
    rest = df.join(*_on_keys(large, keys), "left_anti")
    return work(plain, rest).unionByName(sliced.finish(work(sliced, hot)))
