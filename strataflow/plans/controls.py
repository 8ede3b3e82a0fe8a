"""C-*, L-*: control plane, audit logs and file layout."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from .. import contracts, loads
from ..operators import control, joins, layout, quality, star
from ..session import scratch_path
from ..sources import files, jdbc, tables
from . import bindings as b
from .registry import plain, query, ts
from .relational import _ENC_TEXT, _FENC_TEXT, _FVIT_TEXT
from .transport import landing


@query("c01_control_table", f"""
SELECT SourceID, SourceSystem, EntityName, SourceFormat, IngestionType, WatermarkColumn, {ts('WatermarkValue')}, IsActive FROM ctl""")
def c01(spark, sf):
    rows = tables.conform(b.control(spark, sf), contracts.INGESTION_CONTROL)
    return plain(rows.drop("SourceFolderPath", "TargetBronzePath", "TargetSilverTable", "CreatedDate", "UpdatedDate"))


@query("c02_ingest_active_entities", """
SELECT 'Patients' AS SourceEntity, 'SUCCESS' AS Status, count(*) AS RecordsIngested FROM pat
UNION ALL SELECT 'Providers', 'SUCCESS', count(*) FROM prov UNION ALL SELECT 'Departments', 'SUCCESS', count(*) FROM dept
UNION ALL SELECT 'Encounters', 'SUCCESS', count(*) FROM enc UNION ALL SELECT 'LabResults', 'SUCCESS', count(*) FROM lab
UNION ALL SELECT 'BillingClaims', 'SUCCESS', count(*) FROM clm""")
def c02(spark, sf):
    """All six batch entities landed in Bronze, as the run log tells it."""
    log = scratch_path(spark, "run_log")
    loads.ingest(spark, control.seed_control(spark), landing(spark, sf), scratch_path(spark, "bronze"), log, "r1")
    rows = spark.read.schema(contracts.RUN_LOG).parquet(log).where(F.col("SourceEntity") != loads.ALL_ENTITIES)
    return rows.select("SourceEntity", "Status", "RecordsIngested")


@query("c03_advance_watermarks", f"""
SELECT SourceID, {ts('coalesce(latest, WatermarkValue)', 'WatermarkValue')}, latest IS NOT NULL AS _updated
FROM ctl LEFT JOIN (SELECT o_custkey, max(o_orderdate) AS latest FROM orders GROUP BY 1) ON o_custkey = SourceID""")
def c03(spark, sf):
    """Every entity that received rows moves to its highest time."""
    ctl = b.control(spark, sf)
    latest = b.table(spark, sf, "orders").groupBy(F.col("o_custkey").alias("SourceID")).agg(
        F.max("o_orderdate").alias("NewWatermarkValue")
    )
    new = latest.join(ctl.select("SourceID", "SourceSystem", "EntityName"), "SourceID")
    return plain(control.set_watermarks(ctl, new).select("SourceID", "WatermarkValue", "_updated"))


@query("c03_update_watermark", """
SELECT SourceID, SourceSystem = 'HOUSEHOLD' AND EntityName = 'Customer#000000000' AS moved, (SELECT count(*) FROM ctl WHERE SourceSystem = 'HOUSEHOLD' AND EntityName = 'Customer#000000000') AS rows_updated FROM ctl""")
def c03_one(spark, sf):
    """The single-entity form, with the number of rows set."""
    new, n = control.advance_watermark(b.control(spark, sf), "HOUSEHOLD", "Customer#000000000", dt.datetime(2024, 5, 1))
    moved = F.col("WatermarkValue").eqNullSafe(F.lit(dt.datetime(2024, 5, 1)))
    return new.select("SourceID", moved.alias("moved"), F.lit(n).cast("long").alias("rows_updated"))


@query("c04_incremental", "SELECT o_orderkey, strftime(o_orderdate, '%Y-%m-%d') AS o_orderdate FROM orders WHERE o_orderdate > TIMESTAMP '1999-01-01'")
def c04(spark, sf):
    rows = control.incremental(b.table(spark, sf, "orders"), "o_orderdate", dt.datetime(1999, 1, 1))
    return plain(rows.select("o_orderkey", F.to_date("o_orderdate").alias("o_orderdate")))


@query("c04_ingest_twice", """
SELECT 'Patients' AS SourceEntity, 0::BIGINT AS RecordsIngested UNION ALL SELECT 'Providers', count(*) FROM prov
UNION ALL SELECT 'Departments', count(*) FROM dept UNION ALL SELECT 'Encounters', 0
UNION ALL SELECT 'LabResults', 0 UNION ALL SELECT 'BillingClaims', 0""")
def c04_twice(spark, sf):
    """A second run finds nothing above the watermarks; full reloads copy everything again."""
    raw, bronze, log = landing(spark, sf), scratch_path(spark, "bronze"), scratch_path(spark, "run_log")
    moved = tables.store(loads.ingest(spark, control.seed_control(spark), raw, bronze, log + "/r1", "r1"))
    loads.ingest(spark, moved, raw, bronze, log + "/r2", "r2")
    rows = spark.read.schema(contracts.RUN_LOG).parquet(log + "/r2")
    return rows.where(F.col("SourceEntity") != loads.ALL_ENTITIES).select("SourceEntity", "RecordsIngested")


def _claim_files(spark, sf):
    """A drop folder of claims and a control table that names it alone."""
    root, folder = scratch_path(spark, "raw"), "landing/claims/billing_claims/"
    claims = b.claims(spark, sf)

    def drop(rows):
        b.as_text(rows).write.mode("append").option("header", True).csv(f"{root}/{folder}")

    seed = control.seed_control(spark).where("EntityName = 'BillingClaims'")
    return root, claims, drop, seed


def _claims_landed(spark, bronze):
    return loads.read_bronze(spark, "BillingClaims", bronze).groupBy("ClaimID").agg(F.count(F.lit(1)).alias("copies"))


@query("c04_same_day_rows", "SELECT ClaimID, count(*) AS copies FROM clm GROUP BY 1")
def c04_same_day(spark, sf):
    """Claims of each day arrive in two drops: rows at the watermark and below it are landed, once."""
    root, claims, drop, seed = _claim_files(spark, sf)
    bronze, log, marks = scratch_path(spark, "bronze"), scratch_path(spark, "run_log"), scratch_path(spark, "control")
    even = F.xxhash64("ClaimID") % 2 == 0
    for run, rows in (("r1", claims.where(even)), ("r2", claims.where(~even)), ("r3", None)):
        if rows is not None:
            drop(rows)
        seed = loads.ingest(spark, seed, root, bronze, f"{log}/{run}", run, control_root=marks)
    return _claims_landed(spark, bronze)


@query("c04_rerun_after_advance", "SELECT ClaimID, count(*) AS copies FROM clm GROUP BY 1")
def c04_rerun(spark, sf):
    """The same run id again, with the control table it advanced, leaves what it landed."""
    root, claims, drop, seed = _claim_files(spark, sf)
    bronze, log, marks = scratch_path(spark, "bronze"), scratch_path(spark, "run_log"), scratch_path(spark, "control")
    drop(claims)
    loads.ingest(spark, seed, root, bronze, log, "r1", control_root=marks)
    loads.ingest(spark, loads.read_control_of(spark, marks), root, bronze, log, "r1", control_root=marks)
    return _claims_landed(spark, bronze)


@query("c04_unreadable_time_once", """
SELECT ClaimID, count(*) AS copies, CASE WHEN right(ClaimID, 1) = '1' THEN 'soon' END AS date_text FROM clm GROUP BY 1, 3""")
def c04_unreadable(spark, sf):
    """Rows whose date is no date are landed by the run that finds their file and not by the next, which finds new files beside it."""
    root, claims, drop, seed = _claim_files(spark, sf)
    bronze, log = scratch_path(spark, "bronze"), scratch_path(spark, "run_log")
    broken = F.col("ClaimID").endswith("1")
    text = b.as_text(claims).withColumn("ClaimDate", F.when(broken, "soon").otherwise(F.col("ClaimDate")))
    even = F.xxhash64("ClaimID") % 2 == 0
    for run, rows in (("r1", text.where(even)), ("r2", text.where(~even))):
        drop(rows)
        seed = tables.store(loads.ingest(spark, seed, root, bronze, f"{log}/{run}", run))
    landed = loads.read_bronze(spark, "BillingClaims", bronze).groupBy("ClaimID").agg(
        F.count(F.lit(1)).alias("copies"), F.max(F.when(F.col("ClaimDate") == "soon", F.col("ClaimDate"))).alias("date_text")
    )
    return landed


@query("k10_repeated_row", """
SELECT ClaimID, count(*) * CASE WHEN right(ClaimID, 1) = '1' THEN 2 ELSE 1 END AS copies FROM clm GROUP BY 1""")
def k10_repeated(spark, sf):
    """Bronze is a copy: rows that a later file repeats are landed again, and only those."""
    root, claims, drop, seed = _claim_files(spark, sf)
    bronze, log = scratch_path(spark, "bronze"), scratch_path(spark, "run_log")
    for run, rows in (("r1", claims), ("r2", claims.where(F.col("ClaimID").endswith("1"))), ("r3", None)):
        if rows is not None:
            drop(rows)
        seed = tables.store(loads.ingest(spark, seed, root, bronze, f"{log}/{run}", run))
    return _claims_landed(spark, bronze)


@query("k10_broken_load_unseen", "SELECT ClaimID, count(*) AS copies FROM clm GROUP BY 1")
def k10_broken(spark, sf):
    """A load that wrote its rows and ended before its log row: readers do not see them, the next load brings them once."""
    root, claims, drop, seed = _claim_files(spark, sf)
    bronze = scratch_path(spark, "bronze")
    drop(claims)
    raw = files.read_csv(spark, f"{root}/landing/claims/billing_claims/", contracts.CLAIMS)
    tables.land(files.with_provenance(raw, "CLAIMS_ENGINE"), f"{bronze}/bronze/claims/billing_claims", "r1")
    loads.ingest(spark, seed, root, bronze, scratch_path(spark, "run_log"), "r1")
    return _claims_landed(spark, bronze)


@query("c05_full_reload_twice", """
SELECT DepartmentID, DepartmentName, FacilityName, 'FACILITY_PM' AS _source_system, CAST(DepartmentID AS BIGINT) % 2 = 0 AS in_last FROM dept
WHERE CAST(DepartmentID AS BIGINT) % 2 = 0""")
def c05_twice(spark, sf):
    """Departments loaded twice under one run id and once more with half of them: Bronze holds what the last load found."""
    raw, bronze, log = scratch_path(spark, "raw"), scratch_path(spark, "bronze"), scratch_path(spark, "run_log")
    seed = control.seed_control(spark).where("EntityName = 'Departments'")
    departments = b.as_text(b.departments(spark, sf))
    even = F.col("DepartmentID").cast("long") % 2 == 0
    for run, rows in (("r1", departments), ("r1", departments), ("r2", departments.where(even))):
        rows.write.mode("overwrite").option("header", True).csv(f"{raw}/landing/pm/departments/")
        loads.ingest(spark, seed, raw, bronze, log, run)
    return loads.read_bronze(spark, "Departments", bronze).select(*contracts.DEPARTMENTS.names, "_source_system", even.alias("in_last"))


@query("c06_entity_durations", """
SELECT unnest(['Patients', 'Providers', 'Departments', 'Encounters', 'LabResults', 'BillingClaims', 'ALL_BATCH_ENTITIES']) AS SourceEntity, TRUE AS lasted""")
def c06_durations(spark, sf):
    """Every entity's row says when its load began and ended, and the run's last row spans them all."""
    log = scratch_path(spark, "run_log")
    loads.ingest(spark, control.seed_control(spark), landing(spark, sf), scratch_path(spark, "bronze"), log, "r1")
    rows = spark.read.schema(contracts.RUN_LOG).parquet(log).where(F.col("Status") != control.STARTED)
    run = rows.where(F.col("SourceEntity") == loads.ALL_ENTITIES).select(
        "RunID", F.col("ExecutionStartTime").alias("began"), F.col("ExecutionEndTime").alias("done")
    )
    started, ended = F.col("ExecutionStartTime"), F.col("ExecutionEndTime")
    # Entities load beside each other, so their times may add up to more than the run's.
    inside = (F.col("began") <= started) & (ended <= F.col("done"))
    return rows.join(run, "RunID").select("SourceEntity", ((started < ended) & inside).alias("lasted"))


@query("c05_full_reload", "SELECT ProviderSK, ProviderID, NPI_Number, ProviderName, Specialty, DepartmentID FROM dimprov")
def c05(spark, sf):
    root = scratch_path(spark, "dim_provider")
    for run in ("r1", "r2"):
        tables.publish(b.dim_provider(spark, sf), root, run)
    return tables.read_current(spark, root)


@query("c06_current_run_status", f"""
SELECT RunID, SourceEntity, arg_max(Status, (ExecutionStartTime, ExecutionID)) AS Status,
  {ts('min(ExecutionStartTime)', 'StartedAt')}, {ts('max(ExecutionStartTime)', 'LastEventAt')} FROM runs GROUP BY 1, 2""")
def c06(spark, sf):
    return plain(control.current_status(b.run_log(spark, sf)))


@query("c07_silver_run_log", """
SELECT 'Encounters' AS SourceEntity, 'SILVER' AS Layer, 'QUARANTINED' AS Status,
  count(*) FILTER (WHERE LengthOfStayHours IS NULL OR LengthOfStayHours BETWEEN 0 AND 8760) AS RecordsIngested,
  count(*) FILTER (WHERE NOT LengthOfStayHours BETWEEN 0 AND 8760) AS RecordsQuarantined FROM enc""")
def c07(spark, sf):
    """One run row per Silver load; rerunning the load replaces it."""
    base = scratch_path(spark, "silver")
    for _ in range(2):
        loads.load_silver(
            b.encounters(spark, sf), quality.encounter_rules(), f"{base}/fact_encounters", "silver.fact_encounters",
            "Encounters", "run1", f"{base}/run_log", f"{base}/rule_log",
        )
    rows = spark.read.parquet(f"{base}/run_log")
    return rows.select("SourceEntity", "Layer", "Status", "RecordsIngested", "RecordsQuarantined")


@query("c07_two_entities_one_run", """
SELECT 'Encounters' AS SourceEntity, (SELECT count(*) FROM enc) AS TotalRows, 3::BIGINT AS Rules
UNION ALL SELECT 'LabResults', (SELECT count(*) FROM lab), 1""")
def c07_two(spark, sf):
    """Two entities under one run id: both stay in the run log and in the rule log."""
    base = scratch_path(spark, "silver")
    for entity, rows, rules in (
        ("Encounters", b.encounters(spark, sf), quality.encounter_rules()), ("LabResults", b.labs(spark, sf), [quality.not_null("LabResultID")]),
    ):
        loads.load_silver(rows, rules, f"{base}/{entity}", f"silver.{entity}", entity, "run1", f"{base}/run_log", f"{base}/rule_log")
    runs = spark.read.schema(contracts.RUN_LOG).parquet(f"{base}/run_log")
    rules = spark.read.schema(contracts.RULE_LOG).parquet(f"{base}/rule_log").groupBy("ExecutionID").agg(F.count(F.lit(1)).alias("Rules"))
    return runs.join(rules, "ExecutionID").select(
        "SourceEntity", (F.col("RecordsIngested") + F.col("RecordsQuarantined")).alias("TotalRows"), "Rules"
    )


@query("c06_failed_silver_load", "SELECT 'Encounters' AS SourceEntity, 'FAILED' AS Status, TRUE AS explained, count(*) > 0 AS any_rows FROM enc")
def c06_failed(spark, sf):
    """A load that breaks off leaves its failure in the run log."""
    base = scratch_path(spark, "silver")
    broken = b.encounters(spark, sf).withColumn("EncounterID", F.raise_error(F.lit("source broke off")).cast("string"))
    try:
        loads.load_silver(broken, quality.encounter_rules(), f"{base}/t", "silver.t", "Encounters", "run1", f"{base}/run_log", f"{base}/rule_log")
    except Exception:  # what failed is asserted on the log
        pass
    rows = spark.read.schema(contracts.RUN_LOG).parquet(f"{base}/run_log")
    return rows.select("SourceEntity", "Status", F.col("ErrorMessage").contains("source broke off").alias("explained"), F.lit(True).alias("any_rows"))


@query("c08_rule_log_without_run", "SELECT ExecutionID FROM runs WHERE Status = 'FAILED'")
def c08(spark, sf):
    """Rule log rows whose run is unknown; the failed runs are left out of the run log here."""
    rule_log = b.labs(spark, sf).select(F.col("LabResultID").alias("ExecutionID"))
    runs = b.run_log(spark, sf).where(F.col("Status") != control.FAILED)
    return joins.orphans(rule_log, runs, "ExecutionID")


@query("c09_reset_control", "SELECT SourceID, EntityName, IngestionType FROM ctl")
def c09(spark, sf):
    """The control table replaced as a whole and read back."""
    path = scratch_path(spark, "control")
    tables.overwrite(control.seed_control(spark), path)
    tables.overwrite(tables.conform(b.control(spark, sf), contracts.INGESTION_CONTROL), path)
    return jdbc.read_control(spark, path).select("SourceID", "EntityName", "IngestionType")


@query("l01_clustered_encounters", f"SELECT {_FENC_TEXT} FROM fenc")
def l01(spark, sf):
    path = scratch_path(spark, "clustered")
    layout.cluster_by(b.fact_encounters(spark, sf), ["EncounterType", "AdmitTimestamp"], 4, "EncounterID").write.parquet(path)
    return plain(spark.read.parquet(path))


@query("l01_zordered_encounters", f"SELECT {_ENC_TEXT} FROM enc")
def l01_z(spark, sf):
    path, rows = scratch_path(spark, "zordered"), b.encounters(spark, sf)
    layout.zorder_by(rows, ["EncounterType", "AdmitTimestamp"], 4, "EncounterID").write.parquet(path)
    return plain(spark.read.parquet(path))


@query("l02_zordered_vitals", f"SELECT {_FVIT_TEXT} FROM fvit")
def l02(spark, sf):
    path, rows = scratch_path(spark, "zordered"), b.fact_vitals(spark, sf)
    layout.zorder_by(rows, ["IsCriticalAlert", "EventTimestamp"], 4, "TelemetryID").write.parquet(path)
    return plain(spark.read.parquet(path))


@query("l02_zordered_devices", """
SELECT event_type || '_MONITOR_' || lpad(CAST(user_id AS VARCHAR), 9, '0') AS DeviceID, CAST(event_id AS VARCHAR) AS TelemetryID, TRUE AS spread FROM events""")
def l02_devices(spark, sf):
    """Long device names that differ at their end only: they fill many ranks of the Z-order key."""
    rows = b.table(spark, sf, "events").select(
        F.concat("event_type", F.lit("_MONITOR_"), F.lpad(F.col("user_id").cast("string"), 9, "0")).alias("DeviceID"),
        F.col("event_id").cast("string").alias("TelemetryID"), "ts",
    )
    path = scratch_path(spark, "zordered")
    ranked = rows.withColumn("z", layout.zorder_key(rows, ["DeviceID"]))
    layout.zorder_by(rows, ["DeviceID", "ts"], 4, "TelemetryID").write.parquet(path)
    spread = ranked.agg(F.approx_count_distinct("z") > 30).scalar()
    return spark.read.parquet(path).select("DeviceID", "TelemetryID").withColumn("spread", spread)


@query("l03_replicated_dimensions", f"SELECT {_FENC_TEXT} FROM fenc")
def l03(spark, sf):
    fact = star.fact_encounters(
        b.encounters(spark, sf), b.dim_patient(spark, sf), joins.replicated(b.dim_provider(spark, sf)),
        joins.replicated(b.dim_department(spark, sf)),
    )
    return plain(fact)


@query("l04_bucketed_by_patient", """
SELECT PatientSK, count(DISTINCT EncounterID) AS Encounters, CAST(sum(n) AS BIGINT) AS Readings
FROM fenc JOIN (SELECT PatientSK, count(*) AS n FROM fvit GROUP BY 1) USING (PatientSK) GROUP BY 1""")
def l04(spark, sf):
    """Both facts bucketed by patient: the join and the groupings need no shuffle."""
    names = {"strataflow_enc_bucketed": b.fact_encounters(spark, sf, ["PatientSK"]), "strataflow_vit_bucketed": b.fact_vitals(spark, sf)}
    for name, df in names.items():
        spark.sql(f"DROP TABLE IF EXISTS {name}")
        layout.write_bucketed(df, name, scratch_path(spark, name), "PatientSK", 8)
    encounters, vitals = (spark.table(name) for name in names)
    readings = vitals.groupBy("PatientSK").agg(F.count(F.lit(1)).alias("n"))
    return encounters.join(readings, "PatientSK").groupBy("PatientSK").agg(
        F.countDistinct("EncounterID").alias("Encounters"), F.sum("n").alias("Readings")
    )
