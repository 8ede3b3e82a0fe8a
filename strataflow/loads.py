"""Loads: raw files to Bronze, Bronze to Silver, patient versions, with their run and rule logs.

The driver only walks the list of configured entities, a handful of rows; each entity is one Spark job.
"""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Callable
from functools import partial
from threading import Lock

from pyspark.sql import DataFrame, Observation, SparkSession, functions as F, types as T
from pyspark.sql.streaming import StreamingQuery

from .contracts import ENTITIES, GOLD, INGESTION_CONTROL, text_contract
from .functions.parsing import parse
from .operators import control as ctl, star
from .operators.dedup import duplicates
from .operators.joins import replicated
from .operators.quality import Rule, contract_rules, enforce, misfit_rule, not_null
from .operators.scd2 import apply_scd2, initial_load
from .session import at_once
from .sources.files import list_files, read_csv, read_json_array, read_json_lines, with_provenance
from .sources.jdbc import append_audit, batch_name
from .sources.tables import (
    LANDED_FILES, conform, files_landed, gate, land_files, publish, publish_parts, publish_together, read_current, read_landed,
    read_parts, read_valid, table_exists, touched_parts,
)
from .streaming.vitals import progress

INGEST = "INGEST_RAW_TO_BRONZE"
ALL_ENTITIES = "ALL_BATCH_ENTITIES"


def read_raw(spark: SparkSession, entity: str, fmt: str, path: str | list[str], json_array: bool = False) -> DataFrame:
    """A raw drop as text columns, under the entity's contract."""
    contract = ENTITIES[entity]
    if fmt.upper() == "CSV":
        return read_csv(spark, path, contract)
    if fmt.upper() == "JSON":
        read = read_json_array if json_array else read_json_lines
        return read(spark, path, text_contract(contract))
    raise ValueError(f"no raw reader for format {fmt}")


BRONZE_FIELDS = T.StructType([
    T.StructField("_source_file", T.StringType()), T.StructField("_ingested_at", T.TimestampType()),
    T.StructField("_source_system", T.StringType()),
])


def _unread_files(spark: SparkSession, folder: str, target: str) -> tuple[DataFrame, list[str]]:
    """Files of a drop folder that no completed load has read in their present state."""
    found = list_files(spark, folder)
    known = files_landed(spark, target)
    new = found if known is None else found.join(known, ["path", "modificationTime"], "left_anti")
    rows = new.collect()  # names of the new files, which the scan's own listing holds on the driver as well
    return spark.createDataFrame(rows, LANDED_FILES), [r.path for r in rows]


def land_entity(spark: SparkSession, row, raw_root: str, bronze_root: str, run_id: str, json_array: bool = False) -> dict:
    """Copy one entity's new rows to Bronze with provenance, as they are. Returns what was landed.

    A full reload reads all files, and its rows stand in for those of the loads before. An incremental load reads the
    files that no completed load has read in their present state and lands all their rows, whatever their time:
    rows at the watermark, rows older than it (counted as late), rows without a readable time (counted as
    unreadable), rows equal to others. Rows and files count from one log row on (see tables.land_files), so a load that
    failed starts over, and none reads Bronze. The new watermark is the highest time landed, at most the present.
    """
    source, target = f"{raw_root}/{row.SourceFolderPath}", f"{bronze_root}/{row.TargetBronzePath}".rstrip("/")
    incremental, contract = row.IngestionType == ctl.INCREMENTAL, ENTITIES[row.EntityName]
    if incremental:
        files, paths = _unread_files(spark, source, target)
        if not paths:
            return {"rows": 0, "high": None, "late": 0, "unreadable": 0}
    else:
        files, paths = list_files(spark, source), source
    raw = with_provenance(read_raw(spark, row.EntityName, row.SourceFormat, paths, json_array), row.SourceSystem)
    measures, derived = {}, {}
    if incremental:
        time = F.col("_watermark")
        derived = {"_watermark": parse(F.col(row.WatermarkColumn), contract[row.WatermarkColumn].dataType).cast("timestamp")}
        measures = {
            "high": F.max(F.when(time <= F.current_timestamp(), time)),
            "late": F.count_if(time < F.lit(row.WatermarkValue).cast("timestamp")), "unreadable": F.count_if(time.isNull()),
        }
    seen = land_files(raw, files, target, run_id, not incremental, measures, derived)
    high = seen.get("high")
    if high is not None and row.WatermarkValue is not None:
        high = max(high, row.WatermarkValue)
    return {"rows": seen["rows"], "high": high, "late": seen.get("late", 0), "unreadable": seen.get("unreadable", 0)}


def read_bronze(spark: SparkSession, entity: str, bronze_root: str, folder: str | None = None) -> DataFrame:
    """The rows of an entity that completed loads have brought to Bronze, as text, with provenance."""
    place = folder or next(r[4] for r in ctl.SEED if r[1] == entity)
    schema = T.StructType([*text_contract(ENTITIES[entity]), *BRONZE_FIELDS])
    return read_landed(spark, f"{bronze_root}/{place}".rstrip("/"), schema)


def read_control_of(spark: SparkSession, root: str) -> DataFrame:
    """The control table that ``ingest`` keeps at ``root``."""
    return read_current(spark, root, INGESTION_CONTROL)


def ingest(
    spark: SparkSession, control: DataFrame, raw_root: str, bronze_root: str, log_sink: str | dict,
    run_id: str, json_array: bool = False, control_root: str | None = None,
) -> DataFrame:
    """Load all active batch entities; returns the control table with advanced watermarks.

    With ``control_root`` the new control table is published there, so that its marks are stored with the
    run. Entities load beside each other, those of one Bronze folder in turn. Every entity logs SUCCESS or FAILED
    with its row count, and the run always logs an end, also when the control table cannot be read. A watermark
    moves only after its rows are written.
    """
    def log(entity, status, rows=0, error=None, started=None, ended=None):
        event = ctl.run_event(spark, run_id, entity, "BRONZE", status, INGEST, rows, 0, error, started=started, ended=ended)
        append_audit(event, log_sink)

    def load(rows):
        for place, row in rows:
            started = _now()
            try:
                done = land_entity(spark, row, raw_root, bronze_root, run_id, json_array)
            except Exception as error:  # an entity must not stop the others; the log keeps its message
                ended = _now()
                with one_at_a_time:
                    failed[place] = row.EntityName
                    log(row.EntityName, ctl.FAILED, error=str(error), started=started, ended=ended)
                continue
            ended = _now()  # the wait for the log is none of the load's time
            notes = [f"{done[k]} {k}" for k in ("late", "unreadable") if done.get(k)]
            with one_at_a_time:  # appends to one log folder would take each other's unfinished files away
                log(row.EntityName, ctl.SUCCESS, done["rows"], ", ".join(notes) or None, started, ended)
                if done["high"] is not None:
                    marks.append((row.SourceSystem, row.EntityName, done["high"]))

    log(ALL_ENTITIES, ctl.STARTED)
    begun, marks, failed, one_at_a_time = _now(), [], {}, Lock()
    try:
        targets: dict[str, list] = {}
        for place, row in enumerate(ctl.active_entities(control).orderBy("SourceID").toLocalIterator()):
            targets.setdefault((row.TargetBronzePath or "").rstrip("/"), []).append((place, row))
        at_once(spark, [partial(load, rows) for rows in targets.values()])
        new = spark.createDataFrame(marks, "SourceSystem string, EntityName string, NewWatermarkValue timestamp")
        moved = ctl.set_watermarks(control, new).drop("_updated")
        if control_root:
            publish(moved, control_root, run_id)
            moved = read_control_of(spark, control_root)
    except Exception as error:
        log(ALL_ENTITIES, ctl.FAILED, error=str(error), started=begun)
        raise
    names = ", ".join(failed[place] for place in sorted(failed))
    log(ALL_ENTITIES, ctl.FAILED if failed else ctl.SUCCESS, error=names or None, started=begun)
    return moved


def _now() -> dt.datetime:
    return dt.datetime.now(dt.timezone.utc).replace(tzinfo=None)


def audited(df: DataFrame, source_system: str | None) -> DataFrame:
    """Silver's audit columns: processing time, and the source system unless the rows carry one."""
    known = F.col("_source_system") if "_source_system" in df.columns else F.lit(source_system)
    return df.withColumns({"_processed_at": F.current_timestamp(), "_source_system": known.cast("string")})


def _logged(
    spark: SparkSession, run_id: str, entity: str, layer: str, pipeline: str, sink: str | dict | None,
    work: Callable[[], dict],
) -> dict:
    """Run ``work`` and log its counts, or its failure, as one row per run, layer and entity."""
    started = _now()
    name = batch_name(run_id, layer, entity)

    def log(status, counts, error=None):
        if sink is not None:
            event = ctl.run_event(
                spark, run_id, entity, layer, status, pipeline, counts.get("passed", 0), counts.get("quarantined", 0),
                error, started=started, execution_id=execution_id(run_id, layer, entity),
            )
            append_audit(event, sink, name)

    try:
        counts = work()
    except Exception as error:
        log(ctl.FAILED, {}, str(error))
        raise
    log(ctl.final_status(counts.get("quarantined", 0)), counts, counts.get("note"))
    return counts


def execution_id(run_id: str, layer: str, entity: str) -> str:
    """One id per run, layer and entity; a repeated load has the same."""
    return str(uuid.uuid5(uuid.NAMESPACE_URL, batch_name(run_id, layer, entity)))


def load_silver(
    source: DataFrame, rules: list[Rule], root: str, table: str, entity: str, run_id: str,
    run_sink: str | dict, rule_sink: str | dict, source_system: str | None = None,
) -> dict:
    """Gate one entity into Silver and log the run and its rules from the counts of that write."""
    spark = source.sparkSession

    def work() -> dict:
        counts = gate(audited(source, source_system), rules, root, run_id)
        rows = ctl.rule_log(spark, execution_id(run_id, "SILVER", entity), table, rules, counts, f"{root} (run_id {run_id})")
        append_audit(rows, rule_sink, batch_name(run_id, "SILVER", entity))
        return counts

    return _logged(spark, run_id, entity, "SILVER", f"SILVER_{entity.upper()}", run_sink, work)


def load_versions(
    batch: DataFrame, root: str, run_id: str, run_sink: str | dict | None = None, key: str = "PatientID",
    updated: str = "UpdatedTimestamp", entity: str = "Patients", source_system: str | None = None, parts: int = 16, **opts,
) -> int:
    """Create the version table, or apply the batch to it. Returns the version published.

    The table is kept in ``parts`` hash parts of the key. A batch reads, merges and writes the parts that its keys fall into;
    the new version refers to the others as they are. Take ``parts`` so that one has some hundred MB.

    Rows without key or time cannot become versions. They are written to ``_quarantine`` of the table and
    counted, as are (key, time) pairs with several different rows, of which one stands.
    """
    spark = batch.sparkSession
    rules = [not_null(key, updated, name="NOT_NULL_VERSION_KEY")]
    done = {}

    def work() -> dict:
        landed = f"{root}/_quarantine"
        counts = gate(audited(batch, source_system), rules, landed, run_id)
        rows = read_valid(spark, landed, audited(batch, source_system).schema)
        pairs = rows.groupBy(key, updated).agg(F.countDistinct(F.xxhash64(*[c for c in batch.columns if not c.startswith("_")])).alias("n"))
        tied = pairs.where("n > 1").count()
        if not table_exists(spark, root):
            result = initial_load(rows, key=key, updated=updated, **opts)
            done["version"] = publish_parts(result, root, run_id, key, parts)
        else:
            touched = touched_parts(rows, root)
            target = read_current(spark, root) if touched is None else read_parts(spark, root, touched)
            # A table from before the audit columns gets them as NULL.
            result = apply_scd2(conform(target, _audit_fields()), rows, key=key, updated=updated, **opts)
            done["version"] = publish_parts(result, root, run_id, key, parts, touched)
        return {**counts, "note": f"{tied} tied" if tied else None}

    _logged(spark, run_id, entity, "SILVER", f"SILVER_VERSIONS_{entity.upper()}", run_sink, work)
    return done["version"]


def _audit_fields() -> T.StructType:
    return T.StructType([T.StructField("_processed_at", T.TimestampType()), T.StructField("_source_system", T.StringType())])


class GoldRejected(ValueError):
    """The built tables break the warehouse contract; the version before stays current."""


def check_gold(name: str, rows: DataFrame) -> tuple[DataFrame, dict]:
    """A Gold table in warehouse types, and its rows and the number of them that break each rule of its contract."""
    typed = enforce(rows, GOLD[name])
    rules = [*contract_rules(GOLD[name]), misfit_rule()]
    seen = Observation(f"gold-{name}-{uuid.uuid4().hex}")
    # Only the counts are asked for, so no row gets the names of its failed rules.
    counted = typed.observe(seen, F.count(F.lit(1)).alias("total"), *[F.count_if(~r.passed).alias(r.name) for r in rules])
    names = [c.name for c in GOLD[name]]
    extra = [c for c in rows.columns if c not in names]
    if extra:
        raise GoldRejected(f"{name}: columns beyond the contract: {extra}")
    return counted.select(*names), seen


def build_gold(
    versions: DataFrame, providers: DataFrame, departments: DataFrame, encounters: DataFrame, vitals: DataFrame,
    root: str, run_id: str, run_sink: str | dict | None = None,
) -> int:
    """Build the three dimensions and two facts, check them and make them current together.

    Checked are the contract's types, NULLs and lengths while each table is written, and that the key of each
    table is unique. Any breach raises GoldRejected before the one log row that readers follow is
    written. The facts take their keys from the dimensions just written, so all five agree. Read a table
    with read_current(spark, root, table=name). The dimensions are written beside each other, then the facts; provider and
    department keys reach the encounters by broadcast if they are small.
    """
    spark = versions.sparkSession
    grain = {
        "dim_patient": ["PatientID"], "dim_provider": ["ProviderID"], "dim_department": ["DepartmentID"],
        "fact_patient_encounters": ["EncounterID"], "fact_vitals_telemetry": ["TelemetryID"],
    }
    done, counts = {}, {}

    def put(folder: str, name: str, rows: DataFrame) -> DataFrame:
        checked, seen = check_gold(name, rows)
        out = checked.withColumn("_created_at", F.current_timestamp()) if name == "fact_patient_encounters" else checked
        out.write.parquet(f"{folder}/{name}")
        broken = {rule: n for rule, n in seen.get.items() if n and rule != "total"}
        written = spark.read.schema(out.schema).parquet(f"{folder}/{name}")
        repeated = duplicates(written, grain[name]).count()
        if broken or repeated:
            raise GoldRejected(f"{name}: {broken}, {repeated} repeated keys")
        counts[name] = seen.get["total"]
        return written

    def build(folder: str) -> None:
        patients, providers_now, departments_now = at_once(spark, [
            lambda: put(folder, "dim_patient", star.dim_patient(versions)),
            lambda: put(folder, "dim_provider", star.dim_provider(providers)),
            lambda: put(folder, "dim_department", star.dim_department(departments)),
        ])
        small = [
            replicated(providers_now.select("ProviderID", "ProviderSK")), replicated(departments_now.select("DepartmentID", "DepartmentSK")),
        ]
        at_once(spark, [
            lambda: put(folder, "fact_patient_encounters", star.fact_encounters(encounters, patients, *small)),
            lambda: put(folder, "fact_vitals_telemetry", star.fact_vitals(vitals, patients)),
        ])

    def work() -> dict:
        done["version"] = publish_together(spark, root, run_id, build)
        return {"passed": sum(counts.values())}

    _logged(spark, run_id, "ALL_GOLD_TABLES", "GOLD", "BUILD_GOLD", run_sink, work)
    return done["version"]


def log_stream(spark: SparkSession, query: StreamingQuery, sink: str | dict, entity: str = "PatientVitals") -> None:
    """Write what a stream has read so far to the run log."""
    seen = progress(query)
    failure = query.exception()
    status = ctl.FAILED if failure else ctl.STARTED if seen["active"] else ctl.SUCCESS
    event = ctl.run_event(
        spark, str(query.runId), entity, "BRONZE", status, query.name or "STREAM_VITALS_TO_BRONZE",
        seen["input_rows"], 0, str(failure) if failure else None,
    )
    append_audit(event, sink)
