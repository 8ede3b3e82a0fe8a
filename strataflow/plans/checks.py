"""Q-*, X-*, K-12: data quality and Silver transforms."""

from __future__ import annotations

from pyspark.sql import functions as F

from .. import contracts
from ..functions.clinical import lab_reference
from ..operators import control, dedup, quality, references, scd2, silver, star
from ..sources import tables
from ..session import scratch_path
from ..streaming import vitals as stream
from . import bindings as b
from .registry import day, num, plain, query, ts

_FAILED = """concat_ws(',', CASE WHEN EncounterID IS NULL OR PatientID IS NULL THEN 'RULE_01_NOT_NULL_KEYS' END,
  CASE WHEN NOT LengthOfStayHours BETWEEN 0 AND 8760 THEN 'RULE_02_VALID_LENGTH_OF_STAY' END,
  CASE WHEN NOT coalesce(TotalBilledAmount >= 0, FALSE) THEN 'RULE_03_VALID_BILLED_AMOUNT' END)"""


@query("q01_single_rule", "SELECT c_custkey, c_acctbal FROM customer WHERE c_acctbal >= 0")
def q01(spark, sf):
    """Rows that pass one rule, after the others were quarantined with reason and time."""
    rule = quality.in_range("c_acctbal", 0, name="BALANCE_NOT_NEGATIVE")
    root, rows = scratch_path(spark, "customer"), b.table(spark, sf, "customer")
    tables.gate(rows, [rule], root, "r1")
    return tables.read_valid(spark, root, rows.schema).select("c_custkey", "c_acctbal")


@query("q02_encounter_gate", f"SELECT EncounterID, {_FAILED} AS failed FROM enc")
def q02(spark, sf):
    tagged = quality.tag(b.encounters(spark, sf), quality.encounter_rules())
    return tagged.select("EncounterID", F.col(quality.FAILED).alias("failed"))


@query("q02_gate_written_once", f"""
SELECT CASE WHEN {_FAILED} = '' THEN 'valid' ELSE 'quarantine' END AS side, nullif({_FAILED}, '') AS reason,
  count(*) AS n, CAST(sum(TotalBilledAmount) AS DOUBLE) AS billed FROM enc GROUP BY 1, 2""")
def q02_written(spark, sf):
    """Both sides and all counts from one write, read back by side."""
    root = scratch_path(spark, "gate")
    tables.gate(b.encounters(spark, sf), quality.encounter_rules(), root, "r1")
    valid = tables.read_valid(spark, root, contracts.ENCOUNTERS).select(
        F.lit("valid").alias("side"), F.lit(None).cast("string").alias("reason"), "TotalBilledAmount"
    )
    bad = tables.read_quarantine(spark, root, contracts.ENCOUNTERS).select(
        F.lit("quarantine").alias("side"), F.col("_quarantine_reason").alias("reason"), "TotalBilledAmount"
    )
    return valid.unionByName(bad).groupBy("side", "reason").agg(
        F.count(F.lit(1)).alias("n"), F.sum("TotalBilledAmount").cast("double").alias("billed")
    )


@query("q02_gate_losing_nulls", """
SELECT EncounterID, CASE WHEN LengthOfStayHours BETWEEN 0 AND 8760 THEN 'valid' ELSE 'invalid' END AS side
FROM enc WHERE LengthOfStayHours IS NOT NULL""")
def q02_drop(spark, sf):
    """The two-filter split that loses rows with a NULL verdict, for comparison."""
    rules = quality.encounter_rules(los_null="drop", other_null="drop")
    return quality.sides(b.encounters(spark, sf), rules).where("side IS NOT NULL").select("EncounterID", "side")


_RULE_SQL = """
SELECT 'silver.fact_encounters' AS TableName, 'RULE_01_NOT_NULL_KEYS' AS RuleName, 'NOT_NULL' AS RuleType, count(*) AS TotalRecordsChecked,
  count(*) FILTER (WHERE PatientID IS NULL) AS FailedRecordCount FROM enc
UNION ALL SELECT 'silver.fact_encounters', 'RULE_02_VALID_LENGTH_OF_STAY', 'RANGE_CHECK', count(*),
  count(*) FILTER (WHERE NOT LengthOfStayHours BETWEEN 0 AND 8760) FROM enc
UNION ALL SELECT 'silver.fact_encounters', 'RULE_03_VALID_BILLED_AMOUNT', 'RANGE_CHECK', count(*),
  count(*) FILTER (WHERE NOT TotalBilledAmount >= 0) FROM enc"""


@query("q03_rule_log", _RULE_SQL)
def q03(spark, sf):
    """Rule log rows from the counts observed during the write."""
    root, rules = scratch_path(spark, "gate"), quality.encounter_rules()
    counts = tables.gate(b.encounters(spark, sf), rules, root, "r1")
    log = control.rule_log(spark, "r1", "silver.fact_encounters", rules, counts, root)
    return log.select("TableName", "RuleName", "RuleType", "TotalRecordsChecked", "FailedRecordCount")


@query("q04_failures_per_rule_type", f"""
SELECT RuleType, CAST(sum(FailedRecordCount) AS BIGINT) AS Failed FROM ({_RULE_SQL}) GROUP BY 1""")
def q04(spark, sf):
    counts = quality.rule_counts(b.encounters(spark, sf), quality.encounter_rules())
    return counts.groupBy("RuleType").agg(F.sum("FailedRecordCount").alias("Failed"))


_CLAIMS = """
, latest AS (SELECT * FROM clm QUALIFY row_number() OVER (PARTITION BY ClaimID ORDER BY ClaimDate DESC, EncounterID, PatientID, ClaimAmount, InsurancePayer, ClaimStatus) = 1),
checked AS (SELECT c.*, e.EncounterID IS NOT NULL AS known,
    coalesce(date_diff('day', CAST(AdmitTimestamp AS DATE), ClaimDate) BETWEEN 1 AND 15, TRUE) AS in_window,
    coalesce(ClaimAmount BETWEEN TotalBilledAmount * 0.8 AND TotalBilledAmount * 1.2, TRUE) AS in_ratio
  FROM latest c LEFT JOIN enc e ON c.EncounterID = e.EncounterID)""".lstrip()


@query("q05_all_rule_types", _CLAIMS + """
SELECT 'NOT_NULL_CLAIM_KEYS' AS RuleName, 'NOT_NULL' AS RuleType, count(*) AS TotalRecordsChecked,
  count(*) FILTER (WHERE EncounterID IS NULL OR PatientID IS NULL) AS FailedRecordCount FROM checked
UNION ALL SELECT 'CLAIM_ENCOUNTER_EXISTS', 'REFERENTIAL_INTEGRITY', count(*), count(*) FILTER (WHERE NOT known) FROM checked
UNION ALL SELECT 'CLAIM_DATE_AFTER_ADMIT', 'BUSINESS_RULE', count(*), count(*) FILTER (WHERE NOT in_window) FROM checked
UNION ALL SELECT 'CLAIM_AMOUNT_NEAR_BILLED', 'BUSINESS_RULE', count(*), count(*) FILTER (WHERE NOT in_ratio) FROM checked""")
def q05(spark, sf):
    rows = silver.claims(b.claims(spark, sf), b.encounters(spark, sf))
    return quality.rule_counts(rows, silver.claim_rules())


@query("q06_named_vitals_rules", """
SELECT TelemetryID, concat_ws(',', CASE WHEN HeartRate NOT BETWEEN 60 AND 130 THEN 'VALID_HEART_RATE_RANGE' END,
  CASE WHEN OxygenSaturation NOT BETWEEN 90 AND 100 THEN 'VALID_OXYGEN_RANGE' END) AS failed FROM vit""")
def q06(spark, sf):
    tagged = quality.tag(b.vitals(spark, sf), quality.vitals_rules((60, 130), (90, 100)))
    return tagged.select("TelemetryID", F.col(quality.FAILED).alias("failed"))


@query("q07_schema_drift", """
SELECT 'AdmitReason' AS ColumnName, 'missing' AS Issue, 'string' AS Expected, CAST(NULL AS VARCHAR) AS Found, 0::BIGINT AS RowsWithValue
UNION ALL SELECT 'TotalBilledAmount', 'type', 'decimal(12,2)', 'double', count(o_totalprice) FROM orders
UNION ALL SELECT 'ProviderID', 'type', 'string', 'bigint', count(supp) FROM orders LEFT JOIN stays ON k = o_orderkey
UNION ALL SELECT 'Ward', 'extra', NULL, 'string', count(*) FILTER (WHERE o_orderkey % 3 = 0) FROM orders""")
def q07(spark, sf):
    """Differences from the contract, with the number of rows each one concerns."""
    drifted = b.encounters(spark, sf).drop("AdmitReason").withColumns(
        {
            "TotalBilledAmount": F.col("TotalBilledAmount").cast("double"),
            "ProviderID": F.col("ProviderID").cast("long"),
            "Ward": F.when(F.col("EncounterID").cast("long") % 3 == 0, "A"),
        }
    )
    return quality.drift_profile(drifted, contracts.ENCOUNTERS)


@query("q08_duplicate_keys", "SELECT ClaimID, count(*) AS copies FROM clm GROUP BY 1 HAVING count(*) > 1")
def q08(spark, sf):
    return dedup.duplicates(b.claims(spark, sf), ["ClaimID"])


@query("q09_timestamp_rules", """
SELECT EncounterID, concat_ws(',', CASE WHEN CAST(EncounterID AS BIGINT) % 10 = 0 THEN 'PARSES_ALL_COLUMNS' END,
  CASE WHEN CAST(EncounterID AS BIGINT) % 10 <> 0 AND DischargeTimestamp < AdmitTimestamp
    THEN 'DISCHARGETIMESTAMP_NOT_BEFORE_ADMITTIMESTAMP' END) AS failed FROM enc""")
def q09(spark, sf):
    """Texts that do not parse, and discharges before admission."""
    raw = b.as_text(b.encounters(spark, sf)).withColumn(
        "AdmitTimestamp", F.when(F.col("EncounterID").cast("long") % 10 == 0, "31/12/2024").otherwise(F.col("AdmitTimestamp"))
    )
    rules = [quality.fully_parsed(), quality.ordered_times("AdmitTimestamp", "DischargeTimestamp")]
    return quality.tag(silver.encounters(raw), rules).select("EncounterID", F.col(quality.FAILED).alias("failed"))


@query("k12_warehouse_contract", """
SELECT PatientID, concat_ws(',', CASE WHEN CAST(PatientID AS BIGINT) % 11 = 0 THEN 'TYPES_FIT' END,
  CASE WHEN CAST(PatientID AS BIGINT) % 11 = 0 THEN 'REQUIRED_DateOfBirth' END,
  CASE WHEN CAST(PatientID AS BIGINT) % 5 = 0 THEN 'LENGTH_State' END) AS failed FROM pat""")
def k12(spark, sf):
    """Types, NOT NULL and lengths of the patient dimension, on rows with planted faults."""
    key = F.col("PatientID").cast("long")
    faulty = star.dim_patient(scd2.stage(b.patients(spark, sf))).withColumns(
        {
            "DateOfBirth": F.when(key % 11 == 0, "unknown").otherwise(F.col("DateOfBirth").cast("string")),
            "State": F.when(key % 5 == 0, F.concat(F.lit("US-"), "State")).otherwise(F.col("State")),
        }
    )
    rules = [quality.misfit_rule(), *quality.contract_rules(contracts.DIM_PATIENT)]
    tagged = quality.tag(quality.enforce(faulty, contracts.DIM_PATIENT), rules)
    return tagged.select("PatientID", F.col(quality.FAILED).alias("failed"))


@query("k12_gold_vitals_contract", "SELECT count(*) AS total, count(*) AS passed, 0::BIGINT AS quarantined FROM fvit")
def k12_vitals(spark, sf):
    rules = [quality.misfit_rule(), *quality.contract_rules(contracts.FACT_VITALS)]
    rows = quality.enforce(b.fact_vitals(spark, sf), contracts.FACT_VITALS)
    return quality.tag(rows, rules).agg(*quality.count_columns(rules)[:3])


@query("x01_silver_provider", "SELECT ProviderID, NPI_Number, ProviderName, Specialty, DepartmentID, ProviderSK FROM dimprov")
def x01(spark, sf):
    return silver.providers(b.as_text(b.providers(spark, sf)))


@query("x01_silver_department", "SELECT DepartmentID, DepartmentName, FacilityName, DepartmentSK FROM dimdept")
def x01_department(spark, sf):
    return silver.departments(b.as_text(b.departments(spark, sf)))


@query("x02_silver_labs", f"""
SELECT LabResultID, l.EncounterID, l.PatientID, l.TestCode, TestValue, IsAbnormal, {ts('ResultTimestamp')},
  concat_ws(',', CASE WHEN low IS NOT NULL AND IsAbnormal <> (TestValue < low OR TestValue > high) THEN 'ABNORMAL_FLAG_MATCHES_RANGE' END,
    CASE WHEN e.EncounterID IS NULL THEN 'LAB_ENCOUNTER_EXISTS' END) AS failed
FROM lab l LEFT JOIN labtest ON code = TestCode LEFT JOIN enc e ON e.EncounterID = l.EncounterID""")
def x02(spark, sf):
    rows = silver.labs(b.labs(spark, sf), lab_reference(spark), b.encounters(spark, sf).select("EncounterID"))
    tagged = quality.tag(rows, silver.lab_rules())
    return plain(
        tagged.select(
            "LabResultID", "EncounterID", "PatientID", "TestCode", "TestValue", "IsAbnormal", "ResultTimestamp",
            F.col(quality.FAILED).alias("failed"),
        )
    )


@query("x03_silver_claims", _CLAIMS + f"""
SELECT ClaimID, EncounterID, PatientID, {num('ClaimAmount')}, InsurancePayer, ClaimStatus, {day('ClaimDate')},
  concat_ws(',', CASE WHEN NOT known THEN 'CLAIM_ENCOUNTER_EXISTS' END, CASE WHEN NOT in_window THEN 'CLAIM_DATE_AFTER_ADMIT' END,
    CASE WHEN NOT in_ratio THEN 'CLAIM_AMOUNT_NEAR_BILLED' END) AS failed FROM checked""")
def x03(spark, sf):
    rows = quality.tag(silver.claims(b.claims(spark, sf), b.encounters(spark, sf)), silver.claim_rules())
    return plain(rows.select(*contracts.CLAIMS.names, F.col(quality.FAILED).alias("failed")))


@query("x04_silver_vitals", f"""
SELECT TelemetryID, PatientID, DeviceID, HeartRate, {ts('EventTimestamp')}, '' AS failed FROM vit""")
def x04(spark, sf):
    """Batch form: every reading delivered twice, kept once, validated."""
    twice = b.vitals(spark, sf).withColumn("_copy", F.explode(F.array(F.lit(0), F.lit(1)))).drop("_copy")
    tagged = quality.tag(stream.silver(twice), quality.vitals_rules())
    return plain(
        tagged.select("TelemetryID", "PatientID", "DeviceID", "HeartRate", "EventTimestamp", F.col(quality.FAILED).alias("failed"))
    )


@query("x05_silver_patients", """
SELECT PatientID, upper(trim(Gender)) AS Gender, ZipCode, strftime(DateOfBirth, '%Y-%m-%d') AS DateOfBirth,
  CASE WHEN State = '03' THEN 'KNOWN_GENDER' ELSE '' END AS failed
FROM (SELECT * REPLACE (CASE WHEN State = '03' THEN 'x' ELSE Gender END AS Gender) FROM pat)""")
def x05(spark, sf):
    """Patients typed, gender standardised, and an unknown code caught."""
    raw = b.as_text(b.patients(spark, sf)).withColumn(
        "Gender", F.when(F.col("State") == "03", "x").otherwise(F.col("Gender"))
    )
    tagged = quality.tag(silver.patients(raw), silver.patient_rules())
    return plain(tagged.select("PatientID", "Gender", "ZipCode", "DateOfBirth", F.col(quality.FAILED).alias("failed")))


@query("j11_orphans_in_parts", "SELECT ClaimID, EncounterID FROM clm WHERE EncounterID NOT IN (SELECT EncounterID FROM enc WHERE EncounterType <> '1-URGENT')")
def j11_parts(spark, sf):
    """Claims against a published table of encounters that lacks some: filters first, then the parts that may hold the rest."""
    root = scratch_path(spark, "encounters")
    tables.publish_parts(b.encounters(spark, sf).where("EncounterType <> '1-URGENT'"), root, "r1", "EncounterID", 16)
    return references.orphans_in_parts(b.claims(spark, sf), root, "EncounterID").select("ClaimID", "EncounterID")


@query("q08_keys_seen_before", """
SELECT EncounterID, 1::BIGINT + CAST(twice AS BIGINT) AS rows, known AS in_table FROM (
  SELECT EncounterID, CAST(EncounterID AS BIGINT) % 100 = 7 AS twice, EncounterType = '1-URGENT' AS known FROM enc) WHERE known OR twice""")
def q08_seen(spark, sf):
    """An increment that repeats urgent encounters of the published table and has some encounters twice itself."""
    root, rows = scratch_path(spark, "encounters"), b.encounters(spark, sf)
    tables.publish_parts(rows.where("EncounterType = '1-URGENT'"), root, "r1", "EncounterID", 16)
    again = rows.where(F.col("EncounterID").cast("long") % 100 == 7)
    return references.repeated_keys(rows.unionByName(again), root, "EncounterID")
