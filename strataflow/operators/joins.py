"""Key resolution, point-in-time lookup, orphan checks.

No join carries a broadcast hint for a table that grows with the data. Spark broadcasts a side whose
size is below spark.sql.autoBroadcastJoinThreshold, measured again at run time, and otherwise shuffles
both sides; AQE then splits a partition that a hot key has made too large.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from .ordered import MAX_GROUP_ROWS, in_order

# Sides up to this size are sent to all executors.
BROADCAST_BYTES = 64 << 20


def row_bytes(df: DataFrame) -> Column:
    """About the bytes of a row in memory: text by its length, other plain values by their kind, nested ones as text."""
    parts = []
    for field in df.schema.fields:
        if isinstance(field.dataType, (T.StringType, T.BinaryType)):
            parts.append(F.coalesce(F.octet_length(field.name), F.lit(0)).cast("long") + 16)
        elif isinstance(field.dataType, (T.ArrayType, T.MapType, T.StructType)):
            parts.append(F.coalesce(F.octet_length(F.to_json(F.struct(field.name))), F.lit(0)).cast("long") + 16)
        else:
            parts.append(F.lit(16 if isinstance(field.dataType, T.DecimalType) else 8).cast("long"))
    return reduce(lambda a, b: a + b, parts)


def measured_bytes(df: DataFrame) -> int:
    """The size of the rows; only the lengths of texts are read."""
    return df.agg(F.sum(row_bytes(df)).alias("n")).first().n or 0


def lookup(facts: DataFrame, dim: DataFrame, key: str, add) -> DataFrame:
    """Left join that adds the columns ``add`` of a dimension with unique ``key``."""
    return facts.join(dim.select(key, *add), key, "left")


def orphans(child: DataFrame, parent: DataFrame, child_key: str, parent_key: str | None = None) -> DataFrame:
    """Child rows whose key is present but unknown to the parent."""
    known = parent.select(F.col(parent_key or child_key).alias(child_key)).where(
        F.col(child_key).isNotNull()
    )
    return child.where(F.col(child_key).isNotNull()).join(known, child_key, "left_anti")


def orphan_counts(child: DataFrame, parent: DataFrame, key: str) -> DataFrame:
    """The number of child rows whose key is present but unknown to the parent.

    Child rows are counted per key first, so a hot key meets the parent once.
    """
    per_key = child.where(F.col(key).isNotNull()).groupBy(key).agg(F.count(F.lit(1)).alias("_n"))
    return orphans(per_key, parent, key).agg(F.coalesce(F.sum("_n"), F.lit(0)).alias("Orphans"))


def as_of(
    facts: DataFrame, versions: DataFrame, key: str, at: str, start: str, end: str, add,
    max_rows: int | None = MAX_GROUP_ROWS, broadcast_bytes: int = BROADCAST_BYTES, versions_per_key: int = 64,
    sizes_from: DataFrame | None = None,
) -> DataFrame:
    """Add the columns of the version valid at each fact's time (start <= time < end).

    The version of a time is the one with the latest start up to it, if that has not ended by then. So a
    version ends no later than its successor starts, however far its own end lies beyond. Versions that
    end at or before their start are none. Of versions with one start the one with the latest end
    stands, then the one with the greatest values of ``add``. Facts without key, time or valid version
    keep NULLs. Every fact comes out once.

    The size of the versions picks the way, never the result. Up to ``broadcast_bytes`` and
    ``versions_per_key`` they are cut to non-overlapping spans and broadcast, and the facts are not
    shuffled. Otherwise facts and versions merge into one sequence per key, where each fact takes the last
    version before it: the work grows with facts plus versions, never with their product.
    ``sizes_from`` may name a cheaper table with at least the facts' rows per key, to look for hot keys in.
    """
    known = versions.where(F.col(key).isNotNull() & (F.col(start) < F.col(end))).select(
        *dict.fromkeys([key, start, end, *add])
    )
    per_key = known.groupBy(key).agg(
        F.count(F.lit(1)).alias("n"), F.sum(row_bytes(known)).alias("b")
    )
    size = per_key.agg(F.sum("b").alias("bytes"), F.max("n").alias("most")).first()
    if (size.bytes or 0) <= broadcast_bytes and (size.most or 0) <= versions_per_key:
        return _as_of_broadcast(facts, known, key, at, start, end, add)
    return _as_of_merged(facts, known, key, at, start, end, add, max_rows, sizes_from)


def _as_of_broadcast(facts, versions, key, at, start, end, add) -> DataFrame:
    # A key has few versions here, so its window is small.
    ordered = Window.partitionBy(key).orderBy(start, end, F.struct(*add))
    side = versions.withColumn("_next", F.lead(start).over(ordered)).where(
        F.col("_next").isNull() | (F.col("_next") > F.col(start))
    ).select(
        F.col(key).alias("_key"), F.col(start).alias("_start"), F.least(end, "_next").alias("_end"), *add
    )
    valid = (F.col(key) == F.col("_key")) & (F.col("_start") <= F.col(at)) & (F.col(at) < F.col("_end"))
    return facts.join(F.broadcast(side), valid, "left").drop("_key", "_start", "_end")


def _as_of_merged(facts, versions, key, at, start, end, add, max_rows, sizes_from) -> DataFrame:
    version = F.struct(F.col(end).alias("_end"), *[F.col(c) for c in add])
    known = versions.select(
        F.col(key).alias("_key"), F.col(start).alias("_at"), F.lit(0).alias("_kind"),
        F.lit(None).cast("long").alias("_tie"), version.alias("_version"),
    ).distinct()
    placed = F.col(key).isNotNull() & F.col(at).isNotNull()
    located = facts.where(placed).select(
        F.col(key).alias("_key"), F.col(at).alias("_at"), F.lit(1).alias("_kind"),
        F.xxhash64(*facts.columns).alias("_tie"), F.struct(*facts.columns).alias("_fact"),
    )
    merged = known.unionByName(located, allowMissingColumns=True)
    counted = facts if sizes_from is None else sizes_from
    fact_keys = counted.where(F.col(key).isNotNull()).select(F.col(key).alias("_key"))

    def carry(order, rows):
        seen = order.last_seen(rows, "_version", "_valid")
        return seen.where(F.col("_kind") == 1).select("_fact", "_at", "_valid")

    joined = in_order(
        merged, ["_key"], ["_at", "_kind", "_version", "_tie"], carry, max_rows,
        sizes_from=fact_keys.unionByName(known.select("_key")),
    )
    inside = F.col("_at") < F.col("_valid._end")
    result = joined.select(
        "_fact.*", *[F.when(inside, F.col(f"_valid.{c}")).alias(c) for c in add]
    )
    unplaced = facts.where(~placed).withColumns(
        {c: F.lit(None).cast(versions.schema[c].dataType) for c in add}
    )
    return result.unionByName(unplaced)


def replicated(dim: DataFrame, max_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """The dimension marked for broadcast if its rows take at most ``max_bytes``, else unmarked.

    Past the bound Spark's own size rule decides.
    """
    return F.broadcast(dim) if measured_bytes(dim) <= max_bytes else dim
