"""Table writes that survive reruns and lost executors.

A published table is a folder of complete versions plus a small log naming them. Writers add a version
and then its log row; readers follow the latest row. Nothing that is being read gets overwritten, and a
reader never sees the files of two versions.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Observation, SparkSession, functions as F, types as T
from pyspark.sql.utils import AnalysisException

from ..operators.quality import FAILED, UNDECIDED, Rule, is_invalid, is_valid, observed, quarantine_columns
from ..session import scratch_path

_LOG = "_published"
PART = "_part"
# A version of a table in hash parts names the folder of each part; other tables have one folder and no parts.
VERSIONS = T.StructType(
    [
        T.StructField("version", T.LongType()), T.StructField("run_id", T.StringType()),
        T.StructField("folder", T.StringType()), T.StructField("part_key", T.StringType()),
        T.StructField("part_count", T.IntegerType()), T.StructField("parts", T.MapType(T.IntegerType(), T.StringType())),
        T.StructField("schema", T.StringType()),
    ]
)


def read_if_present(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame | None:
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as missing:
        if "PATH_NOT_FOUND" not in str(missing):
            raise
        return None


def _log(spark: SparkSession, root: str) -> DataFrame | None:
    return read_if_present(spark, f"{root}/{_LOG}", VERSIONS)


def _latest(spark: SparkSession, root: str):
    """The current row of the log; of two writers with one version number the one with the later folder name."""
    log = _log(spark, root)
    return None if log is None else log.orderBy(F.desc("version"), F.desc("folder")).first()


def current_version(spark: SparkSession, root: str) -> int | None:
    latest = _latest(spark, root)
    return None if latest is None else latest.version


def published_folders(spark: SparkSession, root: str) -> list[str]:
    """The folders of all versions, oldest first."""
    log = _log(spark, root)
    return [] if log is None else [r.folder for r in log.orderBy("version", "folder").select("folder").collect()]


def last_run(spark: SparkSession, root: str) -> str | None:
    """The run id of the current version."""
    latest = _latest(spark, root)
    return None if latest is None else latest.run_id


def table_exists(spark: SparkSession, root: str) -> bool:
    return current_version(spark, root) is not None


def _new_folder(version: int) -> str:
    """A folder of its own for every writer, also for two that take the same number."""
    return f"attempt=v{version}-{uuid.uuid4().hex[:12]}"


def publish(df: DataFrame, root: str, run_id: str, partition_by=()) -> int:
    """Write ``df`` as the next version, then make it current."""
    spark = df.sparkSession
    version = (current_version(spark, root) or 0) + 1
    folder = _new_folder(version)
    df.write.partitionBy(*partition_by).parquet(f"{root}/{folder}")
    _append_version(spark, root, version, run_id, folder)
    return version


def publish_together(
    spark: SparkSession, root: str, run_id: str, build: Callable[[str], None],
) -> int:
    """Let ``build`` write any number of tables below a new folder, then make them current by one log row.

    If ``build`` raises, the folder is never named and readers stay with the version before.
    """
    version = (current_version(spark, root) or 0) + 1
    folder = _new_folder(version)
    build(f"{root}/{folder}")
    _append_version(spark, root, version, run_id, folder)
    return version


def _append_version(
    spark: SparkSession, root: str, version: int, run_id: str, folder: str, key: str | None = None, count: int | None = None,
    parts: dict[int, str] | None = None, schema: T.StructType | None = None,
) -> None:
    row = (version, run_id, folder, key, count, parts, schema.json() if schema is not None else None)
    spark.createDataFrame([row], VERSIONS).coalesce(1).write.mode("append").parquet(f"{root}/{_LOG}")


def part_of(key: str, count: int) -> Column:
    """The hash part of a key."""
    return F.pmod(F.xxhash64(F.col(key).cast("string")), F.lit(count)).cast("int")


def touched_parts(rows: DataFrame, root: str) -> list[int] | None:
    """The parts of a published table that the keys of ``rows`` fall into; None if the table is not in parts."""
    latest = _latest(rows.sparkSession, root)
    if latest is None or latest.parts is None:
        return None
    part = part_of(latest.part_key, latest.part_count).alias(PART)
    return sorted(r[PART] for r in rows.select(part).distinct().collect())  # at most part_count numbers


def read_parts(spark: SparkSession, root: str, parts: list[int]) -> DataFrame:
    """The rows of some parts of the current version; no other part is listed or read."""
    latest = _latest(spark, root)
    schema = T.StructType.fromJson(json.loads(latest.schema))
    folders = [f"{root}/{latest.parts[p]}/{PART}={p}" for p in parts if p in latest.parts]
    if not folders:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(*folders)


def publish_parts(
    df: DataFrame, root: str, run_id: str, key: str | None = None, count: int | None = None, only: list[int] | None = None,
) -> int:
    """Write ``df`` in hash parts of ``key`` as the next version, then make it current.

    With ``only``, the rows are those of these parts of the table at ``root``, and the version refers to the folders
    that the one before names for the others. A part is written by one task into one file, so take ``count`` such that
    a part has some hundred MB.
    """
    spark = df.sparkSession
    latest = _latest(spark, root)
    kept: dict[int, str] = {}
    schema = df.schema
    if only is not None:
        key, count = latest.part_key, latest.part_count
        kept = {p: f for p, f in latest.parts.items() if p not in only}
        before = T.StructType.fromJson(json.loads(latest.schema))
        schema = T.StructType([*before, *[f for f in df.schema if f.name not in before.names]])
    version = (latest.version if latest is not None else 0) + 1
    folder = _new_folder(version)
    seen = Observation(f"parts-{uuid.uuid4().hex}")
    placed = conform(df, schema).withColumn(PART, part_of(key, count)).observe(seen, F.collect_set(PART).alias("parts"))
    placed.repartition(min(count, len(only)) if only else count, PART).write.partitionBy(PART).parquet(f"{root}/{folder}")
    new = dict.fromkeys(seen.get["parts"], folder)
    _append_version(spark, root, version, run_id, folder, key, count, kept | new, schema)
    return version


def part_settings(spark: SparkSession, root: str) -> tuple[str, int]:
    """The key of a table's parts and their number."""
    latest = _latest(spark, root)
    return latest.part_key, latest.part_count


def part_folders(spark: SparkSession, root: str) -> dict[int, str]:
    """The folder of each part of the current version."""
    return dict(_latest(spark, root).parts)


def read_current(
    spark: SparkSession, root: str, schema: T.StructType | None = None, table: str | None = None
) -> DataFrame:
    """The current version; ``table`` names one of several that were published together."""
    latest = _latest(spark, root)
    if latest is None:
        raise FileNotFoundError(f"nothing published at {root}")
    if latest.parts is not None:
        rows = read_parts(spark, root, sorted(latest.parts))
        return rows if schema is None else conform(rows, schema).select(*schema.names)
    reader = spark.read.schema(schema) if schema is not None else spark.read
    return reader.parquet(f"{root}/{latest.folder}" + (f"/{table}" if table else ""))


def overwrite(df: DataFrame, path: str, fmt: str = "parquet") -> None:
    """Replace a folder that the DataFrame does not read from."""
    df.write.format(fmt).mode("overwrite").save(path)


def append(df: DataFrame, path: str, fmt: str = "parquet", partition_by=()) -> None:
    df.write.format(fmt).mode("append").partitionBy(*partition_by).save(path)


def write_run(df: DataFrame, path: str, run_id: str) -> None:
    """Append the rows of one run; writing the same run again replaces them."""
    df.drop("run_id").write.mode("overwrite").parquet(f"{path}/run_id={run_id}")


def conform(df: DataFrame, contract: T.StructType) -> DataFrame:
    """The contract's columns in order, missing ones as NULL; further columns follow."""
    have = set(df.columns)
    cols = [
        (F.col(f.name) if f.name in have else F.lit(None)).cast(f.dataType).alias(f.name)
        for f in contract
    ]
    return df.select(*cols, *[c for c in df.columns if c not in contract.names])


LANDED_FILES = T.StructType(
    [
        T.StructField("path", T.StringType()), T.StructField("modificationTime", T.TimestampType()),
        T.StructField("uri", T.StringType()),
    ]
)
_LOADS = "_loads"
LOADS = T.StructType(
    [
        T.StructField("load", T.LongType()), T.StructField("run_id", T.StringType()),
        T.StructField("attempt", T.StringType()), T.StructField("full", T.BooleanType()),
        T.StructField("rows", T.LongType()),
    ]
)


def land(df: DataFrame, path: str, run_id: str, measures: dict | None = None, derived: dict | None = None) -> dict:
    """Add one run's rows in a folder of their own and count what is there.

    ``measures`` names further aggregates to report, ``derived`` columns that these need and that are not written. They are
    taken from the folder just written, where only the columns they need are read: to count on the way would carry every
    row through a step more. Landing under an equal run id adds to its rows and never replaces any. ``attempt`` in the
    result names the folder.
    """
    attempt, rows = uuid.uuid4().hex[:12], df.drop("run_id")
    folder = f"{path}/run_id={run_id}/attempt={attempt}"
    rows.write.parquet(folder)
    written = df.sparkSession.read.schema(rows.schema).parquet(folder).withColumns(derived or {})
    wanted = {"rows": F.count(F.lit(1)), **(measures or {})}
    return {**written.agg(*[m.alias(n) for n, m in wanted.items()]).first().asDict(), "attempt": attempt}


def _completed_loads(spark: SparkSession, path: str) -> DataFrame | None:
    return read_if_present(spark, f"{path}/{_LOADS}/log", LOADS)


def files_landed(spark: SparkSession, path: str) -> DataFrame | None:
    """(path, modificationTime, uri, load): the files whose rows completed loads have brought."""
    done = _completed_loads(spark, path)
    listed = T.StructType([*LANDED_FILES, T.StructField("attempt", T.StringType())])
    named = read_if_present(spark, f"{path}/{_LOADS}/files", listed)
    if done is None or named is None:
        return None
    return named.join(done.select("attempt", "load"), "attempt").drop("attempt")


def land_files(
    df: DataFrame, files: DataFrame, path: str, run_id: str, full: bool, measures: dict | None = None, derived: dict | None = None,
) -> dict:
    """Land the rows of ``files`` so that rows and file names count from one log row on.

    Rows and names are written first. If the load breaks off before its log row, its folders are never named and the next
    load reads the files again; so no load has to look at the rows that are there. ``full`` rows stand in for
    all loads before. A file that comes again in a new state stands in for its earlier rows.
    """
    spark = df.sparkSession
    seen = land(df, path, run_id, measures, derived)
    files.select(*LANDED_FILES.names).coalesce(1).write.parquet(f"{path}/{_LOADS}/files/attempt={seen['attempt']}")
    done = _completed_loads(spark, path)
    last = done.agg(F.max("load").alias("n")).first()["n"] if done is not None else None
    row = ((last or 0) + 1, run_id, seen["attempt"], full, seen["rows"])
    spark.createDataFrame([row], LOADS).coalesce(1).write.mode("append").parquet(f"{path}/{_LOADS}/log")
    return seen


def read_landed(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """The rows that count now: those of the last full load and of all loads after it, each file in its last state.

    ``schema`` needs ``_source_file``. Only folders that the log names are listed; the driver holds their names, one per
    load since the last full one.
    """
    done = _completed_loads(spark, path)
    if done is None:
        return spark.createDataFrame([], schema)
    latest = F.max(F.when(F.col("full"), F.col("load")))
    first = done.agg(F.coalesce(latest, F.lit(0)).alias("n")).first()["n"]
    loads = done.where(F.col("load") >= first)
    folders = [f"{path}/run_id={r.run_id}/attempt={r.attempt}" for r in loads.where("rows > 0").select("run_id", "attempt").collect()]
    if not folders:
        return spark.createDataFrame([], schema)
    places = [T.StructField(c, T.StringType()) for c in ("run_id", "attempt")]
    fields = [f for f in schema if f.name not in ("run_id", "attempt")]
    rows = spark.read.schema(T.StructType([*fields, *places])).option("basePath", path).parquet(*folders)
    # Files of several loads: their rows count in the last one.
    named = spark.read.schema(T.StructType([*LANDED_FILES, places[1]])).parquet(f"{path}/{_LOADS}/files")
    named = named.join(loads.select("attempt", "load"), "attempt")
    again = named.groupBy("uri").agg(F.max_by("attempt", "load").alias("last"), F.count(F.lit(1)).alias("n")).where("n > 1")
    old = named.join(again.drop("n"), "uri").where("attempt <> last").select(F.col("uri").alias("_source_file"), "attempt")
    return rows.join(old, ["_source_file", "attempt"], "left_anti").select(*schema.names)


def gate(df: DataFrame, rules: list[Rule], root: str, run_id: str) -> dict:
    """Validate, write both sides and count every rule: one scan, one job.

    Valid rows and quarantined rows go to the partitions ``side=valid`` and ``side=quarantine`` of a
    new folder, which the log names when it is complete. Returns the counts seen by that write. A run
    that is repeated stands in for its earlier rows; readers of those keep their files.
    """
    tagged, seen = observed(df, rules, f"gate-{run_id}")
    side = F.when(is_valid(), "valid").when(is_invalid(), "quarantine")
    rows = quarantine_columns(tagged.withColumn("side", side), run_id).where("side IS NOT NULL")
    out = rows.drop(UNDECIDED, "run_id").withColumns(
        {
            c: F.when(F.col("side") == "quarantine", F.col(c))
            for c in (FAILED, "_quarantine_reason", "_quarantined_at")
        }
    )
    spark = df.sparkSession
    version = (current_version(spark, root) or 0) + 1
    folder = _new_folder(version)
    out.write.partitionBy("side").parquet(f"{root}/{folder}")
    _append_version(spark, root, version, run_id, folder)
    return seen.get


def _side(spark: SparkSession, path: str, side: str, fields: T.StructType) -> DataFrame:
    schema = T.StructType([*fields, T.StructField("side", T.StringType())])
    return spark.read.schema(schema).parquet(path).where(F.col("side") == side).drop("side")


_AUDIT = [
    T.StructField(FAILED, T.StringType()),
    T.StructField("_quarantine_reason", T.StringType()),
    T.StructField("_quarantined_at", T.TimestampType()),
]


def read_valid(spark: SparkSession, root: str, schema: T.StructType) -> DataFrame:
    """Valid rows of the latest gated run; none before the first."""
    latest = _latest(spark, root)
    if latest is None:
        return spark.createDataFrame([], schema)
    return _side(spark, f"{root}/{latest.folder}", "valid", schema)


def read_quarantine(spark: SparkSession, root: str, schema: T.StructType) -> DataFrame:
    """Quarantined rows of all runs, each run's last attempt, with run_id and reason."""
    fields = T.StructType([*schema, *_AUDIT])
    log = _log(spark, root)
    if log is None:
        return spark.createDataFrame([], T.StructType([*fields, T.StructField("run_id", T.StringType())]))
    last = log.groupBy("run_id").agg(F.max_by("folder", F.struct("version", "folder")).alias("folder"))
    places = [T.StructField("attempt", T.StringType()), T.StructField("side", T.StringType())]
    rows = spark.read.schema(T.StructType([*fields, *places])).parquet(root).where(F.col("side") == "quarantine")
    complete = last.select(F.split_part("folder", F.lit("="), F.lit(2)).alias("attempt"), "run_id")
    return rows.join(complete, "attempt").drop("attempt", "side")


def store(df: DataFrame, name: str = "stored") -> DataFrame:
    """Write to a new path of the shared scratch folder and read back: cuts the lineage for good."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def create_table(spark: SparkSession, name: str, schema: T.StructType, path: str) -> None:
    """Create or replace a catalog table with a declared schema at a given place."""
    spark.sql(f"DROP TABLE IF EXISTS {name}")
    spark.catalog.createTable(name, path=path, source="parquet", schema=schema)
