"""Continuity of broker offsets: which were lost, which came again.

A source that tolerates loss does not say what it skipped, but offsets of a partition are consecutive. Rows are reduced to islands,
stretches of offsets without a gap: first within slices of SLICE offsets, which spreads a partition that holds most rows over
many tasks, then over the slices. Islands of several loads are merged in the same way, so a log of islands, one row per gap or
load, tells the state of the whole stream without its rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

SLICE = 1 << 20
PARTITION, OFFSET = "_kafka_partition", "_kafka_offset"


def _merged(spans: DataFrame, keys) -> DataFrame:
    """Join spans (first, last, deliveries) that touch or overlap, per ``keys``."""
    order = Window.partitionBy(*keys).orderBy("first", "last")
    reached = F.max("last").over(order.rowsBetween(Window.unboundedPreceding, -1))
    opens = reached.isNull() | (F.col("first") > reached + 1)
    counted = spans.withColumn("_opens", opens.cast("long"))
    run = F.sum("_opens").over(order.rowsBetween(Window.unboundedPreceding, 0))
    return counted.withColumn("_run", run).groupBy(*keys, "_run").agg(
        F.min("first").alias("first"), F.max("last").alias("last"), F.sum("deliveries").alias("deliveries")
    ).drop("_run")


def islands(rows: DataFrame, partition: str = PARTITION, offset: str = OFFSET, slice_size: int = SLICE) -> DataFrame:
    """(partition, first, last, deliveries): stretches of consecutive offsets. Rows without partition or offset have no place."""
    placed = rows.where(F.col(partition).isNotNull() & F.col(offset).isNotNull())
    spans = placed.groupBy(F.col(partition).alias("partition"), F.col(offset).alias("first")).agg(
        F.count(F.lit(1)).alias("deliveries")
    ).withColumns({"last": F.col("first"), "_slice": F.floor(F.col("first") / slice_size)})
    return merged(_merged(spans, ["partition", "_slice"]).drop("_slice"))


def merged(spans: DataFrame) -> DataFrame:
    """Islands of several loads as those of all of them: gaps that a later load filled close."""
    return _merged(spans.select("partition", "first", "last", "deliveries"), ["partition"])


def gaps(spans: DataFrame) -> DataFrame:
    """(partition, first_missing, last_missing, missing) between merged islands."""
    order = Window.partitionBy("partition").orderBy("first")
    return spans.withColumn("_next", F.lead("first").over(order)).where("_next IS NOT NULL").select(
        "partition", (F.col("last") + 1).alias("first_missing"), (F.col("_next") - 1).alias("last_missing"),
        (F.col("_next") - F.col("last") - 1).alias("missing"),
    )


def summary(spans: DataFrame) -> DataFrame:
    """Per partition: bounds, offsets seen, missing ones between the bounds, and deliveries beyond the first of an offset."""
    seen = F.sum(F.col("last") - F.col("first") + 1)
    return spans.groupBy("partition").agg(
        F.min("first").alias("first"), F.max("last").alias("last"), seen.alias("seen"),
        (F.max("last") - F.min("first") + 1 - seen).alias("missing"), (F.sum("deliveries") - seen).alias("repeated"),
    )
