"""Ingestion control and audit logs as tables.

Logs are append-only events. The present state of a run is its latest event, so nothing is updated in
place and a rerun of a writer can be recognised by its run id.
"""

from __future__ import annotations

import datetime as dt
import uuid

from pyspark.sql import DataFrame, Row, SparkSession, functions as F

from ..contracts import INGESTION_CONTROL, RULE_LOG, RUN_LOG

FULL_RELOAD, INCREMENTAL, STREAMING = "FULL_RELOAD", "INCREMENTAL_WATERMARK", "STREAMING"
STARTED, SUCCESS, FAILED, QUARANTINED = "STARTED", "SUCCESS", "FAILED", "QUARANTINED"

_EPOCH = dt.datetime(1970, 1, 1)

# The seven entities the platform ingests.
SEED = (
    ("EPIC_EHR", "Patients", "CSV", "landing/ehr/patients/", "bronze/ehr/patients/",
     "silver.dim_patient_scd2", INCREMENTAL, "UpdatedTimestamp", _EPOCH),
    ("EPIC_EHR", "Providers", "CSV", "landing/ehr/providers/", "bronze/ehr/providers/",
     "silver.dim_provider", FULL_RELOAD, None, None),
    ("FACILITY_PM", "Departments", "CSV", "landing/pm/departments/", "bronze/pm/departments/",
     "silver.dim_department", FULL_RELOAD, None, None),
    ("EPIC_EHR", "Encounters", "CSV", "landing/ehr/encounters/", "bronze/ehr/encounters/",
     "silver.fact_encounters", INCREMENTAL, "AdmitTimestamp", _EPOCH),
    ("CERNER_LABS", "LabResults", "JSON", "landing/labs/lab_results/", "bronze/labs/lab_results/",
     "silver.fact_lab_results", INCREMENTAL, "ResultTimestamp", _EPOCH),
    ("CLAIMS_ENGINE", "BillingClaims", "CSV", "landing/claims/billing_claims/",
     "bronze/claims/billing_claims/", "silver.fact_billing_claims", INCREMENTAL, "ClaimDate", _EPOCH),
    ("BEDSIDE_IOT", "PatientVitals", "STREAMING", "eventhub/vitals-telemetry-hub",
     "bronze/telemetry/vitals_streaming/", "silver.fact_vitals_telemetry", STREAMING,
     "EventTimestamp", None),
)


def seed_control(spark: SparkSession, now: dt.datetime | None = None) -> DataFrame:
    now = now or dt.datetime.now(dt.timezone.utc).replace(tzinfo=None)
    rows = [(i, *row, True, now, now) for i, row in enumerate(SEED, start=1)]
    return spark.createDataFrame(rows, INGESTION_CONTROL)


def active_entities(control: DataFrame) -> DataFrame:
    """Active entities loaded in batches."""
    return control.where(F.col("IsActive") & (F.col("IngestionType") != STREAMING))


def set_watermarks(control: DataFrame, new_values: DataFrame) -> DataFrame:
    """The control table with the watermark of every entity named in ``new_values``.

    ``new_values`` has SourceSystem, EntityName, NewWatermarkValue, unique by the first two. ``_updated``
    marks the rows that were set.
    """
    keys = ["SourceSystem", "EntityName"]
    named = new_values.select(*keys, "NewWatermarkValue").withColumn("_named", F.lit(True))
    joined = control.join(named, keys, "left")
    hit = F.coalesce("_named", F.lit(False))
    return joined.withColumns(
        {
            "_updated": hit,
            "WatermarkValue": F.when(hit, F.col("NewWatermarkValue")).otherwise(F.col("WatermarkValue")),
            "UpdatedDate": F.when(hit, F.current_timestamp()).otherwise(F.col("UpdatedDate")),
        }
    ).select(*control.columns, "_updated")


def advance_watermark(control: DataFrame, system: str, entity: str, value) -> tuple[DataFrame, int]:
    """Set one entity's watermark; returns the new control table and the number of rows set."""
    hit = (F.col("SourceSystem") == system) & (F.col("EntityName") == entity)
    updated = control.withColumns(
        {
            "WatermarkValue": F.when(hit, F.lit(value).cast("timestamp")).otherwise(F.col("WatermarkValue")),
            "UpdatedDate": F.when(hit, F.current_timestamp()).otherwise(F.col("UpdatedDate")),
        }
    )
    return updated, control.where(hit).count()


def incremental(df: DataFrame, column: str, watermark) -> DataFrame:
    """Rows above the stored watermark. The comparison is with a literal, so it reaches the scan."""
    if watermark is None:
        return df
    kind = df.schema[column].dataType
    return df.where(F.col(column) > F.lit(watermark).cast(kind))


def run_event(
    spark: SparkSession, run_id: str, entity: str, layer: str, status: str, pipeline: str,
    ingested: int = 0, quarantined: int = 0, error: str | None = None,
    started: dt.datetime | None = None, ended: dt.datetime | None = None, execution_id: str | None = None,
) -> DataFrame:
    """One row of the run log. Row counts are rows, not files; messages travel as values, unescaped."""
    now = dt.datetime.now(dt.timezone.utc).replace(tzinfo=None)
    row = (
        execution_id or str(uuid.uuid4()), pipeline, run_id, entity, layer, status, ingested, quarantined,
        started or now, ended if ended or status == STARTED else now, error, None,
    )
    return spark.createDataFrame([row], RUN_LOG).withColumn("ExecutedBy", F.current_user())


def final_status(quarantined: int) -> str:
    return QUARANTINED if quarantined else SUCCESS


def rule_log(spark: SparkSession, execution_id: str, table: str, rules, counts: dict, location: str | None) -> DataFrame:
    """Rule log rows from the counts observed while the rows were written."""
    now = dt.datetime.now(dt.timezone.utc).replace(tzinfo=None)
    rows = [
        Row(execution_id, table, r.name, r.kind, counts["total"], counts[r.name], location, now)
        for r in rules
    ]
    return spark.createDataFrame(rows, RULE_LOG)


def current_status(run_log: DataFrame, keys=("RunID", "SourceEntity")) -> DataFrame:
    """Latest event per run and entity."""
    return run_log.groupBy(*keys).agg(
        F.max_by("Status", F.struct("ExecutionStartTime", "ExecutionID")).alias("Status"),
        F.min("ExecutionStartTime").alias("StartedAt"),
        F.max("ExecutionStartTime").alias("LastEventAt"),
    )
