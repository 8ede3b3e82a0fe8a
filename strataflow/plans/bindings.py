"""The platform's entities, built from the driver's tables; the same in SQL for the oracles.

orders/lineitem -> encounters and claims, customer -> patients, supplier/nation/region -> providers,
departments and facilities, events -> telemetry, labs and change log.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from ..functions.clinical import LAB_TESTS, critical_alert, stay_hours
from ..functions.parsing import TIMESTAMP_FORMAT
from ..operators import scd2, star
from ..session import pin_utc
from ..sources.tables import store

S, I, L, D, TS = T.StringType(), T.IntegerType(), T.LongType(), T.DoubleType(), T.TimestampType()


def _schema(**cols) -> T.StructType:
    return T.StructType([T.StructField(n, k, True) for n, k in cols.items()])


TABLES = {
    "region": _schema(r_regionkey=I, r_name=S),
    "nation": _schema(n_nationkey=I, n_name=S, n_regionkey=I),
    "customer": _schema(c_custkey=L, c_name=S, c_nationkey=I, c_acctbal=D, c_mktsegment=S),
    "supplier": _schema(s_suppkey=L, s_name=S, s_nationkey=I, s_acctbal=D),
    "orders": _schema(
        o_orderkey=L, o_custkey=L, o_orderstatus=S, o_totalprice=D, o_orderdate=TS, o_orderpriority=S
    ),
    "lineitem": _schema(
        l_orderkey=L, l_partkey=L, l_suppkey=L, l_linenumber=I, l_quantity=D, l_extendedprice=D,
        l_discount=D, l_tax=D, l_returnflag=S, l_linestatus=S, l_shipdate=TS,
    ),
    "events": _schema(event_id=L, ts=TS, user_id=L, event_type=S, value=D, props=S),
}

FIRST_LOAD = "1995-01-01 00:00:00"
SECOND_LOAD = "1998-01-01 12:00:00"


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return pin_utc(spark).read.schema(TABLES[name]).parquet(f"{sf}/{name}.parquet")


def _id(col: str) -> F.Column:
    return F.col(col).cast("string")


def encounters(spark: SparkSession, sf: str) -> DataFrame:
    stays = table(spark, sf, "lineitem").groupBy("l_orderkey").agg(
        F.max("l_shipdate").alias("DischargeTimestamp"), F.min("l_suppkey").alias("s_suppkey"),
        F.min("l_returnflag").alias("AdmitReason"),
    )
    homes = table(spark, sf, "supplier").select("s_suppkey", "s_nationkey")
    orders = table(spark, sf, "orders").withColumnRenamed("o_orderdate", "AdmitTimestamp")
    joined = orders.join(stays, F.col("o_orderkey") == F.col("l_orderkey"), "left").join(
        homes, "s_suppkey", "left"
    )
    return joined.select(
        _id("o_orderkey").alias("EncounterID"),
        _id("o_custkey").alias("PatientID"),
        _id("s_suppkey").alias("ProviderID"),
        _id("s_nationkey").alias("DepartmentID"),
        F.col("o_orderpriority").alias("EncounterType"),
        "AdmitTimestamp",
        "DischargeTimestamp",
        stay_hours().alias("LengthOfStayHours"),
        "AdmitReason",
        F.col("o_orderstatus").alias("DischargeStatus"),
        F.col("o_totalprice").cast("decimal(12,2)").alias("TotalBilledAmount"),
    )


def as_text(df: DataFrame) -> DataFrame:
    """Every column as the text a source file would hold."""
    cols = []
    for f in df.schema:
        col = F.col(f.name)
        text = F.date_format(col, TIMESTAMP_FORMAT) if isinstance(f.dataType, T.TimestampType) else col.cast("string")
        cols.append(text.alias(f.name))
    return df.select(*cols)


def patients(spark: SparkSession, sf: str) -> DataFrame:
    home = table(spark, sf, "nation").select(F.col("n_nationkey").alias("c_nationkey"), "n_name")
    key = F.col("c_custkey")
    return table(spark, sf, "customer").join(home, "c_nationkey", "left").select(
        _id("c_custkey").alias("PatientID"),
        F.concat(F.lit("MRN_"), key.cast("string")).alias("MedicalRecordNumber"),
        F.split_part("c_name", F.lit("#"), F.lit(1)).alias("FirstName"),
        F.split_part("c_name", F.lit("#"), F.lit(2)).alias("LastName"),
        F.date_add(F.lit("1940-01-01").cast("date"), (key % 20000).cast("int")).alias("DateOfBirth"),
        F.when(key % 2 == 0, " f").otherwise("M ").alias("Gender"),
        F.when(key % 3 == 0, "Spanish").otherwise("English").alias("PrimaryLanguage"),
        F.concat(key.cast("string"), F.lit(" Main St")).alias("AddressLine"),
        F.col("n_name").alias("City"),
        F.lpad(F.col("c_nationkey").cast("string"), 2, "0").alias("State"),
        F.lpad((key % 100000).cast("string"), 5, "0").alias("ZipCode"),
        F.col("c_mktsegment").alias("PrimaryInsurancePayer"),
        F.lit(FIRST_LOAD).cast("timestamp").alias("UpdatedTimestamp"),
    )


def patients_second_load(spark: SparkSession, sf: str) -> DataFrame:
    """The next snapshot: a seventh of the payers change, half of those to NULL; some patients are new."""
    first = patients(spark, sf)
    key = F.col("PatientID").try_cast("long")
    payer = F.col("PrimaryInsurancePayer")
    again = first.withColumns(
        {
            "PrimaryInsurancePayer": F.when(key % 14 == 0, F.lit(None))
            .when(key % 7 == 0, F.concat(F.lit("NEW_"), payer)).otherwise(payer),
            "UpdatedTimestamp": F.lit(SECOND_LOAD).cast("timestamp"),
        }
    )
    new = again.where(F.col("State") == "07").withColumn("PatientID", F.concat(F.lit("NEW_"), "PatientID"))
    return again.unionByName(new)


def first_versions(spark: SparkSession, sf: str) -> DataFrame:
    return scd2.initial_load(patients(spark, sf))


def stored_first_versions(spark: SparkSession, sf: str) -> DataFrame:
    """The version table as a load finds it: written by the load before."""
    return store(first_versions(spark, sf), "versions")


def versions(spark: SparkSession, sf: str) -> DataFrame:
    """Patient versions after both loads."""
    return scd2.apply_scd2(stored_first_versions(spark, sf), patients_second_load(spark, sf))


def providers(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "supplier").select(
        _id("s_suppkey").alias("ProviderID"),
        F.lpad(_id("s_suppkey"), 10, "0").alias("NPI_Number"),
        F.col("s_name").alias("ProviderName"),
        F.concat(F.lit("SPEC_"), (F.col("s_suppkey") % 9).cast("string")).alias("Specialty"),
        _id("s_nationkey").alias("DepartmentID"),
    )


def departments(spark: SparkSession, sf: str) -> DataFrame:
    facility = table(spark, sf, "region").withColumnRenamed("r_regionkey", "n_regionkey")
    return table(spark, sf, "nation").join(facility, "n_regionkey", "left").select(
        _id("n_nationkey").alias("DepartmentID"), F.col("n_name").alias("DepartmentName"),
        F.col("r_name").alias("FacilityName"),
    )


def vitals_of(events: DataFrame) -> DataFrame:
    """Telemetry columns of event rows; also used on streams."""
    reading = F.get_json_object("props", "$.k").cast("int")
    oxygen = (F.col("value").cast("decimal(10,2)") % 12 + 88).cast("double")
    rows = events.select(
        _id("event_id").alias("TelemetryID"),
        _id("user_id").alias("PatientID"),
        F.expr("cast(event_id div 4 as string)").alias("EncounterID"),
        F.col("event_type").alias("DeviceID"),
        (reading % 91 + 50).cast("int").alias("HeartRate"),
        (F.col("event_id") % 91 + 85).cast("int").alias("BloodPressureSystolic"),
        (F.col("event_id") % 56 + 55).cast("int").alias("BloodPressureDiastolic"),
        oxygen.alias("OxygenSaturation"),
        ((F.col("event_id") % 66 + 970) / 10).alias("BodyTemperature"),
        F.col("ts").alias("EventTimestamp"),
    )
    return rows.withColumn("IsCriticalAlert", critical_alert())


def vitals(spark: SparkSession, sf: str) -> DataFrame:
    return vitals_of(table(spark, sf, "events"))


def claims(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "lineitem").select(
        F.concat_ws("-", "l_orderkey", "l_linenumber").alias("ClaimID"),
        _id("l_orderkey").alias("EncounterID"),
        _id("l_partkey").alias("PatientID"),
        F.col("l_extendedprice").cast("decimal(12,2)").alias("ClaimAmount"),
        F.concat(F.lit("PAYER_"), "l_linestatus").alias("InsurancePayer"),
        F.col("l_returnflag").alias("ClaimStatus"),
        F.to_date("l_shipdate").alias("ClaimDate"),
    )


# Event type -> laboratory test; "error" has no normal range.
LAB_OF_EVENT = dict(zip(("click", "purchase", "signup", "view"), LAB_TESTS))


def labs(spark: SparkSession, sf: str) -> DataFrame:
    def pick(i):
        expr = F.when(F.lit(False), F.lit(None).cast("string"))
        for kind, test in LAB_OF_EVENT.items():
            expr = expr.when(F.col("event_type") == kind, test[i])
        return expr

    return table(spark, sf, "events").select(
        _id("event_id").alias("LabResultID"),
        F.expr("cast(event_id div 4 as string)").alias("EncounterID"),
        _id("user_id").alias("PatientID"),
        F.coalesce(pick(0), F.lit("UNKNOWN")).alias("TestCode"),
        pick(1).alias("TestName"),
        F.col("value").alias("TestValue"),
        pick(2).alias("Unit"),
        (F.col("value") > 100).alias("IsAbnormal"),
        F.col("ts").alias("ResultTimestamp"),
    )


def changelog(spark: SparkSession, sf: str) -> DataFrame:
    """One row per event: the user's state from that time on."""
    return table(spark, sf, "events").select(
        "user_id", "event_type", F.col("ts").alias(scd2.START)
    )


def run_log(spark: SparkSession, sf: str) -> DataFrame:
    """Run events derived from the events table, in the columns of the run log."""
    status = (
        F.when(F.col("event_type") == "signup", "STARTED").when(F.col("event_type") == "error", "FAILED")
        .when(F.col("event_type") == "view", "QUARANTINED").otherwise("SUCCESS")
    )
    return table(spark, sf, "events").select(
        _id("event_id").alias("ExecutionID"),
        F.concat(F.lit("PL_"), (F.col("user_id") % 10).cast("string")).alias("PipelineName"),
        _id("user_id").alias("RunID"),
        F.col("event_type").alias("SourceEntity"),
        F.when(F.col("event_id") % 3 == 0, "BRONZE").otherwise("SILVER").alias("Layer"),
        status.alias("Status"),
        F.floor("value").cast("long").alias("RecordsIngested"),
        (F.col("event_id") % 7).cast("long").alias("RecordsQuarantined"),
        F.col("ts").alias("ExecutionStartTime"),
        (F.col("ts") + F.expr("interval 90 seconds")).alias("ExecutionEndTime"),
    )


def control(spark: SparkSession, sf: str) -> DataFrame:
    """A control table with one entity per customer."""
    key = F.col("c_custkey")
    kind = F.when(key % 3 == 0, "FULL_RELOAD").when(key % 3 == 1, "INCREMENTAL_WATERMARK").otherwise("STREAMING")
    first = F.lit("1970-01-01").cast("timestamp")
    return table(spark, sf, "customer").select(
        key.alias("SourceID"),
        F.col("c_mktsegment").alias("SourceSystem"),
        F.col("c_name").alias("EntityName"),
        F.lit("CSV").alias("SourceFormat"),
        F.concat(F.lit("landing/"), "c_name").alias("SourceFolderPath"),
        F.concat(F.lit("bronze/"), "c_name").alias("TargetBronzePath"),
        F.concat(F.lit("silver."), "c_name").alias("TargetSilverTable"),
        kind.alias("IngestionType"),
        F.lit("AdmitTimestamp").alias("WatermarkColumn"),
        F.when(key % 3 == 1, first).alias("WatermarkValue"),
        (F.col("c_acctbal") >= 0).alias("IsActive"),
        first.alias("CreatedDate"),
        first.alias("UpdatedDate"),
    )


# --- Gold, derived from the above ---------------------------------------------------------------

def dim_patient(spark: SparkSession, sf: str) -> DataFrame:
    """Patients as of the first load."""
    return star.dim_patient(scd2.stage(patients(spark, sf)))


def dim_patient_current(spark: SparkSession, sf: str) -> DataFrame:
    """Current patients after both loads."""
    return star.dim_patient(versions(spark, sf))


def dim_provider(spark: SparkSession, sf: str) -> DataFrame:
    return star.dim_provider(providers(spark, sf))


def dim_department(spark: SparkSession, sf: str) -> DataFrame:
    return star.dim_department(departments(spark, sf))


def fact_encounters(
    spark: SparkSession, sf: str, keys=("PatientSK", "ProviderSK", "DepartmentSK")
) -> DataFrame:
    """The encounter fact, resolving only the named keys."""
    return star.fact_encounters(
        encounters(spark, sf),
        dim_patient(spark, sf) if "PatientSK" in keys else None,
        dim_provider(spark, sf) if "ProviderSK" in keys else None,
        dim_department(spark, sf) if "DepartmentSK" in keys else None,
    )


def fact_vitals(spark: SparkSession, sf: str) -> DataFrame:
    return star.fact_vitals(vitals(spark, sf), dim_patient(spark, sf))


_LAB_ROWS = ", ".join(
    f"('{kind}', '{code}', '{name}', '{unit}', {low}, {high})"
    for kind, (code, name, unit, low, high) in LAB_OF_EVENT.items()
)

ORACLE_TABLES = f"""
stays AS (
  SELECT l_orderkey AS k, max(l_shipdate) AS discharged, min(l_suppkey) AS supp, min(l_returnflag) AS flag
  FROM lineitem GROUP BY l_orderkey),
enc AS (
  SELECT CAST(o_orderkey AS VARCHAR) AS EncounterID, CAST(o_custkey AS VARCHAR) AS PatientID,
    CAST(supp AS VARCHAR) AS ProviderID, CAST(s_nationkey AS VARCHAR) AS DepartmentID,
    o_orderpriority AS EncounterType, o_orderdate AS AdmitTimestamp, discharged AS DischargeTimestamp,
    CAST((epoch_us(discharged) - epoch_us(o_orderdate)) / 3600000000.0 AS DECIMAL(10,2)) AS LengthOfStayHours,
    flag AS AdmitReason, o_orderstatus AS DischargeStatus,
    CAST(o_totalprice AS DECIMAL(12,2)) AS TotalBilledAmount
  FROM orders LEFT JOIN stays ON k = o_orderkey LEFT JOIN supplier ON s_suppkey = supp),
pat AS (
  SELECT CAST(c_custkey AS VARCHAR) AS PatientID, 'MRN_' || c_custkey AS MedicalRecordNumber,
    split_part(c_name, '#', 1) AS FirstName, split_part(c_name, '#', 2) AS LastName,
    DATE '1940-01-01' + CAST(c_custkey % 20000 AS INTEGER) AS DateOfBirth,
    CASE WHEN c_custkey % 2 = 0 THEN ' f' ELSE 'M ' END AS Gender,
    CASE WHEN c_custkey % 3 = 0 THEN 'Spanish' ELSE 'English' END AS PrimaryLanguage,
    c_custkey || ' Main St' AS AddressLine, n_name AS City,
    lpad(CAST(c_nationkey AS VARCHAR), 2, '0') AS State,
    lpad(CAST(c_custkey % 100000 AS VARCHAR), 5, '0') AS ZipCode,
    c_mktsegment AS PrimaryInsurancePayer, TIMESTAMP '{FIRST_LOAD}' AS UpdatedTimestamp
  FROM customer LEFT JOIN nation ON n_nationkey = c_nationkey),
pat_again AS (
  SELECT * REPLACE (
    CASE WHEN CAST(PatientID AS BIGINT) % 14 = 0 THEN NULL
         WHEN CAST(PatientID AS BIGINT) % 7 = 0 THEN 'NEW_' || PrimaryInsurancePayer
         ELSE PrimaryInsurancePayer END AS PrimaryInsurancePayer,
    TIMESTAMP '{SECOND_LOAD}' AS UpdatedTimestamp) FROM pat),
pat2 AS (
  SELECT * FROM pat_again UNION ALL
  SELECT * REPLACE ('NEW_' || PatientID AS PatientID) FROM pat_again WHERE State = '07'),
ver1 AS (
  SELECT *, md5(PatientID || '||{FIRST_LOAD}') AS PatientSK, TRUE AS IsCurrent,
    UpdatedTimestamp AS EffectiveStartDate, TIMESTAMP '9999-12-31 23:59:59' AS EffectiveEndDate FROM pat),
ver AS (
  SELECT * REPLACE (CAST(PatientID AS BIGINT) % 7 <> 0 AS IsCurrent,
    CASE WHEN CAST(PatientID AS BIGINT) % 7 = 0 THEN TIMESTAMP '{SECOND_LOAD}' ELSE EffectiveEndDate END AS EffectiveEndDate)
  FROM ver1 UNION ALL
  SELECT *, md5(PatientID || '||{SECOND_LOAD}'), TRUE, UpdatedTimestamp, TIMESTAMP '9999-12-31 23:59:59' FROM pat2
  WHERE PatientID LIKE 'NEW_%' OR CAST(replace(PatientID, 'NEW_', '') AS BIGINT) % 7 = 0),
dimpat AS (SELECT * EXCLUDE (UpdatedTimestamp, IsCurrent, EffectiveEndDate) FROM ver1),
dimpatcur AS (SELECT * EXCLUDE (UpdatedTimestamp, IsCurrent, EffectiveEndDate) FROM ver WHERE IsCurrent),
prov AS (
  SELECT CAST(s_suppkey AS VARCHAR) AS ProviderID, lpad(CAST(s_suppkey AS VARCHAR), 10, '0') AS NPI_Number,
    s_name AS ProviderName, 'SPEC_' || (s_suppkey % 9) AS Specialty, CAST(s_nationkey AS VARCHAR) AS DepartmentID
  FROM supplier),
dimprov AS (SELECT md5(ProviderID) AS ProviderSK, * FROM prov),
dept AS (
  SELECT CAST(n_nationkey AS VARCHAR) AS DepartmentID, n_name AS DepartmentName, r_name AS FacilityName
  FROM nation LEFT JOIN region ON r_regionkey = n_regionkey),
dimdept AS (SELECT md5(DepartmentID) AS DepartmentSK, * FROM dept),
vit0 AS (
  SELECT CAST(event_id AS VARCHAR) AS TelemetryID, CAST(user_id AS VARCHAR) AS PatientID,
    CAST(event_id // 4 AS VARCHAR) AS EncounterID, event_type AS DeviceID,
    CAST(regexp_extract(props, '([0-9]+)', 1) AS INTEGER) % 91 + 50 AS HeartRate,
    CAST(event_id % 91 + 85 AS INTEGER) AS BloodPressureSystolic,
    CAST(event_id % 56 + 55 AS INTEGER) AS BloodPressureDiastolic,
    CAST(CAST(value AS DECIMAL(10,2)) % 12 + 88 AS DOUBLE) AS OxygenSaturation,
    (event_id % 66 + 970) / 10.0 AS BodyTemperature, ts AS EventTimestamp FROM events),
vit AS (
  SELECT *, (HeartRate > 120 OR HeartRate < 55 OR OxygenSaturation < 90 OR BloodPressureSystolic > 160)
    AS IsCriticalAlert FROM vit0),
clm AS (
  SELECT l_orderkey || '-' || l_linenumber AS ClaimID, CAST(l_orderkey AS VARCHAR) AS EncounterID,
    CAST(l_partkey AS VARCHAR) AS PatientID, CAST(l_extendedprice AS DECIMAL(12,2)) AS ClaimAmount,
    'PAYER_' || l_linestatus AS InsurancePayer, l_returnflag AS ClaimStatus, CAST(l_shipdate AS DATE) AS ClaimDate
  FROM lineitem),
labtest(kind, code, test, unit, low, high) AS (VALUES {_LAB_ROWS}),
lab AS (
  SELECT CAST(event_id AS VARCHAR) AS LabResultID, CAST(event_id // 4 AS VARCHAR) AS EncounterID,
    CAST(user_id AS VARCHAR) AS PatientID, coalesce(code, 'UNKNOWN') AS TestCode, test AS TestName,
    value AS TestValue, unit AS Unit, value > 100 AS IsAbnormal, ts AS ResultTimestamp
  FROM events LEFT JOIN labtest ON kind = event_type),
runs AS (
  SELECT CAST(event_id AS VARCHAR) AS ExecutionID, 'PL_' || (user_id % 10) AS PipelineName,
    CAST(user_id AS VARCHAR) AS RunID, event_type AS SourceEntity,
    CASE WHEN event_id % 3 = 0 THEN 'BRONZE' ELSE 'SILVER' END AS Layer,
    CASE event_type WHEN 'signup' THEN 'STARTED' WHEN 'error' THEN 'FAILED' WHEN 'view' THEN 'QUARANTINED'
      ELSE 'SUCCESS' END AS Status,
    CAST(floor(value) AS BIGINT) AS RecordsIngested, event_id % 7 AS RecordsQuarantined,
    ts AS ExecutionStartTime, ts + INTERVAL 90 SECOND AS ExecutionEndTime FROM events),
ctl AS (
  SELECT c_custkey AS SourceID, c_mktsegment AS SourceSystem, c_name AS EntityName, 'CSV' AS SourceFormat,
    'landing/' || c_name AS SourceFolderPath, 'bronze/' || c_name AS TargetBronzePath,
    'silver.' || c_name AS TargetSilverTable,
    CASE c_custkey % 3 WHEN 0 THEN 'FULL_RELOAD' WHEN 1 THEN 'INCREMENTAL_WATERMARK' ELSE 'STREAMING' END AS IngestionType,
    'AdmitTimestamp' AS WatermarkColumn,
    CASE WHEN c_custkey % 3 = 1 THEN TIMESTAMP '1970-01-01' END AS WatermarkValue, c_acctbal >= 0 AS IsActive
  FROM customer),
fenc AS (
  SELECT e.EncounterID, p.PatientSK, pr.ProviderSK, d.DepartmentSK, e.EncounterType, e.AdmitTimestamp,
    e.DischargeTimestamp, e.LengthOfStayHours, e.AdmitReason, e.DischargeStatus, e.TotalBilledAmount
  FROM enc e LEFT JOIN dimpat p ON e.PatientID = p.PatientID LEFT JOIN dimprov pr ON e.ProviderID = pr.ProviderID
  LEFT JOIN dimdept d ON e.DepartmentID = d.DepartmentID),
fvit AS (
  SELECT TelemetryID, PatientSK, EncounterID, DeviceID, HeartRate, BloodPressureSystolic, BloodPressureDiastolic,
    CAST(OxygenSaturation AS DECIMAL(5,2)) AS OxygenSaturation, CAST(BodyTemperature AS DECIMAL(4,1)) AS BodyTemperature,
    IsCriticalAlert, EventTimestamp
  FROM vit v LEFT JOIN dimpat p ON v.PatientID = p.PatientID)
""".strip()
