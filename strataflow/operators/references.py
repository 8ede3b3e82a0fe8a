"""Referential and uniqueness checks of an increment against a large published table.

The table is kept in hash parts of its key (tables.publish_parts). Beside it lies a Bloom filter per part, made of 4 KB
bitmaps; a part's filter is made once per state of the part, so a load that rewrites two parts has two filters made. Keys of an
increment are tried on the filters first: most that are not in the table are settled there. The rest are joined
exactly, with the parts they fall into; no other part is listed or read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..sources import tables

_FILTERS = "_filters"
FILTER = "part int, folder string, bits long, bucket long, bitmap binary"
BITS_PER_KEY, HASHES = 10, 7
BUCKET_BITS = 32_768


def _positions(key: str, bits: Column) -> Column:
    """The bit positions of a key in a filter of ``bits`` bits: double hashing."""
    text = F.col(key).cast("string")
    one, step = F.xxhash64(text, F.lit("a")), F.xxhash64(text, F.lit("b")).bitwiseOR(F.lit(1))
    # Shifted right, so that sums of up to HASHES steps stay within 64 bits.
    return F.array(*[F.pmod(F.shiftright(one, 4) + i * F.shiftright(step, 4), bits) for i in range(HASHES)])


def _folders(spark: SparkSession, root: str) -> DataFrame:
    return spark.createDataFrame(list(tables.part_folders(spark, root).items()), "part int, folder string")


def update_filters(spark: SparkSession, root: str, key: str) -> list[int]:
    """Make the filters of all parts whose present state has none. Returns these parts."""
    folders = _folders(spark, root)
    made = tables.read_if_present(spark, f"{root}/{_FILTERS}", FILTER)
    missing = folders if made is None else folders.join(made.select("part", "folder").distinct(), ["part", "folder"], "left_anti")
    parts = sorted(r.part for r in missing.collect())  # at most the number of parts
    if not parts:
        return []
    count = tables.part_settings(spark, root)[1]
    keys = tables.read_parts(spark, root, parts).select(key).where(F.col(key).isNotNull()).distinct()
    placed = keys.withColumn("part", tables.part_of(key, count))
    bits = (F.ceil(F.count(F.lit(1)) * BITS_PER_KEY / BUCKET_BITS) * BUCKET_BITS).cast("long")
    sizes = placed.groupBy("part").agg(bits.alias("bits")).join(folders, "part")
    positions = placed.join(sizes, "part").select("part", "folder", "bits", F.explode(_positions(key, F.col("bits"))).alias("at"))
    # A bucket's number counts from 0 here; bitmap_bucket_number counts from 1.
    filters = positions.groupBy("part", "folder", "bits", F.floor(F.col("at") / BUCKET_BITS).cast("long").alias("bucket")).agg(
        F.bitmap_construct_agg((F.col("at") % BUCKET_BITS)).alias("bitmap")
    )
    filters.write.mode("append").parquet(f"{root}/{_FILTERS}")
    return parts


def _tried(keys: DataFrame, spark: SparkSession, root: str, key: str) -> DataFrame:
    """The keys with their part and whether the filters say that the table may hold them."""
    filters = spark.read.schema(FILTER).parquet(f"{root}/{_FILTERS}").join(_folders(spark, root), ["part", "folder"])
    sizes = filters.select("part", "bits").distinct()
    placed = keys.withColumn("part", tables.part_of(key, tables.part_settings(spark, root)[1])).join(sizes, "part", "left")
    at = placed.select(key, "part", F.explode_outer(_positions(key, F.col("bits"))).alias("at")).withColumn(
        "bucket", F.floor(F.col("at") / BUCKET_BITS).cast("long")
    )
    inside = (F.col("at") % BUCKET_BITS).cast("int")
    byte = F.conv(F.hex(F.substring("bitmap", F.floor(inside / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    bit = F.call_function("shiftright", byte, inside % 8).bitwiseAND(F.lit(1)) == 1
    seen = at.join(filters.select("part", "bucket", "bitmap"), ["part", "bucket"], "left").select(
        key, "part", F.coalesce(bit, F.lit(False)).alias("hit")
    )
    return seen.groupBy(key, "part").agg(F.min("hit").alias("possible"))


def _known_keys(keys: DataFrame, root: str, key: str, table_key: str) -> tuple[DataFrame, DataFrame]:
    """Distinct keys as (those in the table, those not in it)."""
    spark = keys.sparkSession
    update_filters(spark, root, table_key)
    tried = tables.store(_tried(keys, spark, root, key), "tried")
    parts = sorted(r.part for r in tried.where("possible").select("part").distinct().collect())  # at most the number of parts
    held = tables.read_parts(spark, root, parts).select(F.col(table_key).alias(key)).where(F.col(key).isNotNull()).distinct()
    possible = tried.where("possible").select(key)
    known = possible.join(held, key, "left_semi")
    return known, possible.join(held, key, "left_anti").unionByName(tried.where("NOT possible").select(key))


def orphans_in_parts(child: DataFrame, root: str, child_key: str, parent_key: str | None = None) -> DataFrame:
    """Child rows whose key is present but unknown to the published parent."""
    keys = child.select(child_key).where(F.col(child_key).isNotNull()).distinct()
    _, unknown = _known_keys(keys, root, child_key, parent_key or child_key)
    return child.join(unknown, child_key, "left_semi")


def repeated_keys(increment: DataFrame, root: str, key: str) -> DataFrame:
    """(key, rows, in_table): keys of the increment that the published table holds already or that it has more than once."""
    counted = increment.where(F.col(key).isNotNull()).groupBy(key).agg(F.count(F.lit(1)).alias("rows"))
    known, _ = _known_keys(counted.select(key), root, key, key)
    both = counted.join(known.withColumn("in_table", F.lit(True)), key, "left").withColumn("in_table", F.coalesce("in_table", F.lit(False)))
    return both.where((F.col("rows") > 1) | F.col("in_table"))
