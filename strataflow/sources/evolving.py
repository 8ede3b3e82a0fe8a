"""Appends whose columns change over time, read by stored schemas.

Every append writes a folder and then one log row with the schema of its rows and the merged schema of the table up to
it. New columns are added, types are widened where no value is lost; rows with a value that fits neither way are written
to quarantine, counted. Readers take the few distinct schemas from the log, so no file's footer is opened to plan a scan.
"""

from __future__ import annotations

import json
import uuid

from pyspark.sql import Column, DataFrame, Observation, SparkSession, functions as F, types as T
from pyspark.sql.utils import AnalysisException

from .tables import read_if_present

_LOG, _HELD = "_appends", "_quarantine"
APPENDS = T.StructType(
    [
        T.StructField("append", T.LongType()), T.StructField("run_id", T.StringType()), T.StructField("folder", T.StringType()),
        T.StructField("schema", T.StringType()), T.StructField("merged", T.StringType()),
    ]
)
HELD = T.StructType(
    [
        T.StructField("columns", T.ArrayType(T.StringType())), T.StructField("row", T.StringType()),
        T.StructField("run_id", T.StringType()),
    ]
)
# Whole numbers by their digits, narrow ones first.
_WHOLE = {T.ByteType(): 3, T.ShortType(): 5, T.IntegerType(): 10, T.LongType(): 19}


def widened(a: T.DataType, b: T.DataType) -> T.DataType | None:
    """The type that holds all values of both, or None if there is none."""
    if a == b or isinstance(b, T.NullType):
        return a
    if isinstance(a, T.NullType):
        return b
    kinds = {type(a), type(b)}
    if a in _WHOLE and b in _WHOLE:
        return max(a, b, key=_WHOLE.get)
    if kinds == {T.FloatType, T.DoubleType}:
        return T.DoubleType()
    if T.DoubleType in kinds or T.FloatType in kinds:
        # Whole numbers of up to 10 digits are exact in a double.
        other = a if b in (T.DoubleType(), T.FloatType()) else b
        return T.DoubleType() if _WHOLE.get(other, 99) <= 10 else None
    if kinds == {T.DateType, T.TimestampType}:
        return T.TimestampType()
    if all(isinstance(t, T.DecimalType) or t in _WHOLE for t in (a, b)):
        whole, scale = zip(*[(_WHOLE[t], 0) if t in _WHOLE else (t.precision - t.scale, t.scale) for t in (a, b)], strict=True)
        return T.DecimalType(max(whole) + max(scale), max(scale)) if max(whole) + max(scale) <= 38 else None
    if kinds == {T.ArrayType}:
        element = widened(a.elementType, b.elementType)
        return T.ArrayType(element) if element else None
    if kinds == {T.StructType}:
        merged, conflicts = merge(a, b)
        return None if conflicts else merged
    return None


def merge(old: T.StructType, new: T.StructType) -> tuple[T.StructType, list[str]]:
    """The columns of both, types widened, and the columns whose types have nothing in common; those keep the old type."""
    by_name = {f.name.lower(): f for f in new}
    fields, conflicts = [], []
    for field in old:
        other = by_name.pop(field.name.lower(), None)
        kind = field.dataType if other is None else widened(field.dataType, other.dataType)
        if kind is None:
            conflicts.append(field.name)
            kind = field.dataType
        fields.append(T.StructField(field.name, kind))
    return T.StructType([*fields, *[T.StructField(f.name, f.dataType) for f in by_name.values()]]), conflicts


def _appends(spark: SparkSession, path: str) -> DataFrame | None:
    return read_if_present(spark, f"{path}/{_LOG}", APPENDS)


def stored_schema(spark: SparkSession, path: str) -> T.StructType | None:
    """The merged schema of all appends."""
    log = _appends(spark, path)
    last = None if log is None else log.orderBy(F.desc("append"), F.desc("folder")).first()
    return None if last is None else T.StructType.fromJson(json.loads(last.merged))


def _cast(df: DataFrame, column: str, kind: T.DataType) -> Column:
    """The column as another type; NULL where its value, or its whole type, does not fit. Nested values are not turned into text."""
    nested = (T.ArrayType, T.MapType, T.StructType)
    if isinstance(df.select(column).schema[0].dataType, nested) != isinstance(kind, nested):
        return F.lit(None).cast(kind)
    cast = F.col(column).try_cast(kind)
    try:
        df.select(cast).schema
    except AnalysisException:
        return F.lit(None).cast(kind)
    return cast


def append_evolving(df: DataFrame, path: str, run_id: str) -> dict[str, int]:
    """Append rows under the table's merged schema. Returns how many were added and how many quarantined."""
    spark = df.sparkSession
    old = stored_schema(spark, path)
    merged, conflicts = merge(old, df.schema) if old is not None else (T.StructType([T.StructField(f.name, f.dataType) for f in df.schema]), [])
    folder, seen = f"append-{uuid.uuid4().hex[:12]}", Observation(f"evolving-{uuid.uuid4().hex}")
    bad = [F.when(F.col(c).isNotNull() & _cast(df, c, merged[c].dataType).isNull(), c) for c in conflicts]
    marked = df.withColumn("_conflicts", F.array_compact(F.array(*bad)) if bad else F.array().cast("array<string>"))
    held = F.size("_conflicts") > 0
    counted = marked.observe(seen, F.count_if(~held).alias("rows"), F.count_if(held).alias("quarantined"))
    rows = counted.where(~held).withColumns({c: _cast(df, c, merged[c].dataType) for c in conflicts}).drop("_conflicts")
    if conflicts:
        whole = F.to_json(F.struct(*[F.col(c) for c in df.columns]))
        marked.where(held).select(F.col("_conflicts").alias("columns"), whole.alias("row"), F.lit(run_id).alias("run_id")).write.parquet(
            f"{path}/{_HELD}/folder={folder}"
        )
    rows.write.parquet(f"{path}/{folder}")
    log = _appends(spark, path)
    number = ((log.agg(F.max("append").alias("n")).first()["n"] if log is not None else None) or 0) + 1
    entry = (number, run_id, folder, rows.schema.json(), merged.json())
    spark.createDataFrame([entry], APPENDS).coalesce(1).write.mode("append").parquet(f"{path}/{_LOG}")
    return seen.get


def read_evolved(spark: SparkSession, path: str) -> DataFrame:
    """All rows under the merged schema; columns that an append did not have are NULL."""
    merged = stored_schema(spark, path)
    if merged is None:
        raise FileNotFoundError(f"nothing appended at {path}")
    by_schema: dict[str, list[str]] = {}
    for row in _appends(spark, path).select("schema", "folder").collect():  # one row per append
        by_schema.setdefault(row.schema, []).append(f"{path}/{row.folder}")
    out = None
    for text, folders in sorted(by_schema.items()):
        own = T.StructType.fromJson(json.loads(text))
        have = {f.name.lower(): f.name for f in own}
        part = spark.read.schema(own).parquet(*folders).select(*[
            (F.col(have[f.name.lower()]) if f.name.lower() in have else F.lit(None)).cast(f.dataType).alias(f.name) for f in merged
        ])
        out = part if out is None else out.unionByName(part)
    return out


def read_held(spark: SparkSession, path: str) -> DataFrame:
    """Quarantined rows as JSON text, with the columns that did not fit."""
    log = _appends(spark, path)
    held = read_if_present(spark, f"{path}/{_HELD}", T.StructType([*HELD, T.StructField("folder", T.StringType())]))
    if log is None or held is None:
        return spark.createDataFrame([], HELD)
    return held.join(log.select("folder"), "folder", "left_semi").select(*HELD.names)
