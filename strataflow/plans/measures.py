"""A-*: serving aggregates."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import marts, quality, silver, slices, star
from ..sources.tables import store
from . import bindings as b
from .registry import plain, query, ts

_ENC_AVG = "CAST(sum(LengthOfStayHours) AS DOUBLE) / count(LengthOfStayHours)"
_REV = "CAST(sum(TotalBilledAmount) AS DOUBLE)"
_REV_AVG = f"{_REV} / count(TotalBilledAmount)"
_HR = "CAST(sum(HeartRate) AS DOUBLE) / count(HeartRate) AS AvgHeartRate"
_OX = "CAST(sum(OxygenSaturation) AS DOUBLE) / count(OxygenSaturation) AS AvgOxygenSaturation"
_ALERTS = "count(*) FILTER (WHERE IsCriticalAlert) AS CriticalAlerts"


@query("a01_critical_vitals", f"""
SELECT DeviceID, EncounterID, count(*) AS TotalReadings, {_ALERTS}, {_HR}, {_OX},
  {ts('min(EventTimestamp)', 'FirstReading')}, {ts('max(EventTimestamp)', 'LastReading')}
FROM fvit GROUP BY DeviceID, EncounterID""")
def a01(spark, sf):
    return plain(marts.critical_vitals(b.fact_vitals(spark, sf)))


@query("a02_encounter_summary", f"""
SELECT DepartmentName, FacilityName, EncounterType, count(EncounterID) AS TotalEncounters,
  {_ENC_AVG} AS AvgLengthOfStayHours, {_REV} AS TotalRevenue, {_REV_AVG} AS AvgBilledAmount
FROM fenc LEFT JOIN dimdept USING (DepartmentSK) GROUP BY ALL""")
def a02(spark, sf):
    fact = b.fact_encounters(spark, sf, ["DepartmentSK"])
    return marts.encounter_summary(fact, b.dim_department(spark, sf))


@query("a02_from_raw_text", f"""
, ok AS (SELECT * FROM enc WHERE PatientID IS NOT NULL AND (LengthOfStayHours IS NULL OR LengthOfStayHours BETWEEN 0 AND 8760)
  AND TotalBilledAmount >= 0 AND (DischargeTimestamp IS NULL OR DischargeTimestamp >= AdmitTimestamp))
SELECT DepartmentName, FacilityName, EncounterType, count(EncounterID) AS TotalEncounters,
  {_ENC_AVG} AS AvgLengthOfStayHours, {_REV} AS TotalRevenue, {_REV_AVG} AS AvgBilledAmount
FROM ok LEFT JOIN dimdept USING (DepartmentID) GROUP BY ALL""".lstrip())
def a02_raw(spark, sf):
    """Raw text as landed in Bronze, typing, de-duplication, quality gate, key resolution, summary."""
    raw = store(b.as_text(b.encounters(spark, sf)), "bronze")
    valid, _ = quality.split(silver.encounters(raw), silver.all_encounter_rules())
    departments = b.dim_department(spark, sf)
    return marts.encounter_summary(star.fact_encounters(valid, departments=departments), departments)


@query("a03_revenue_by_payer", f"""
SELECT PrimaryInsurancePayer, State, EncounterType, count(EncounterID) AS TotalEncounters,
  {_REV} AS TotalRevenue, {_ENC_AVG} AS AvgLOS
FROM fenc LEFT JOIN dimpat USING (PatientSK) GROUP BY ALL""")
def a03(spark, sf):
    return marts.revenue_by_payer(b.fact_encounters(spark, sf, ["PatientSK"]), b.dim_patient(spark, sf))


@query("a04_facility_summary", f"""
SELECT FacilityName, EncounterType, count(EncounterID) AS TotalEncounters,
  round({_ENC_AVG}, 1) AS AvgLengthOfStayHours, round({_REV}, 2) AS TotalBilledAmount
FROM fenc LEFT JOIN dimdept USING (DepartmentSK) GROUP BY ALL
ORDER BY TotalBilledAmount DESC, FacilityName, EncounterType""")
def a04(spark, sf):
    fact = b.fact_encounters(spark, sf, ["DepartmentSK"])
    return marts.facility_summary(fact, b.dim_department(spark, sf))


@query("a05_row_counts", "SELECT count(*) AS total, count(*) AS passed, 0::BIGINT AS quarantined FROM vit")
def a05(spark, sf):
    """Total, passed and quarantined rows from one aggregation."""
    rules = quality.vitals_rules()
    return quality.tag(b.vitals(spark, sf), rules).agg(*quality.count_columns(rules)[:3])


@query("a06_failures_per_rule", """
SELECT 'RULE_01_NOT_NULL_KEYS' AS RuleName, 'NOT_NULL' AS RuleType, count(*) AS TotalRecordsChecked,
  count(*) FILTER (WHERE EncounterID IS NULL OR PatientID IS NULL) AS FailedRecordCount FROM enc
UNION ALL SELECT 'RULE_02_VALID_LENGTH_OF_STAY', 'RANGE_CHECK', count(*),
  count(*) FILTER (WHERE NOT LengthOfStayHours BETWEEN 0 AND 8760) FROM enc
UNION ALL SELECT 'RULE_03_VALID_BILLED_AMOUNT', 'RANGE_CHECK', count(*),
  count(*) FILTER (WHERE NOT coalesce(TotalBilledAmount >= 0, FALSE)) FROM enc""")
def a06(spark, sf):
    return quality.rule_counts(b.encounters(spark, sf), quality.encounter_rules())


@query("a07_executive_kpis", f"""
SELECT count(DISTINCT PatientSK) AS PatientsSeen, count(EncounterID) AS TotalEncounters, {_REV} AS TotalRevenue,
  {_REV_AVG} AS AvgRevenuePerEncounter, {_ENC_AVG} AS AvgLengthOfStayHours,
  (SELECT count(*) FROM dimpat) AS TotalPatients FROM fenc""")
def a07(spark, sf):
    return marts.executive_kpis(b.fact_encounters(spark, sf, ["PatientSK"]), b.dim_patient(spark, sf))


@query("a07_by_facility", f"""
SELECT count(DISTINCT o_custkey) FILTER (WHERE o_custkey IN (SELECT c_custkey FROM customer)) AS PatientsSeen, count(*) AS TotalEncounters,
  CAST(sum(CAST(o_totalprice AS DECIMAL(12,2))) AS DOUBLE) AS TotalRevenue,
  CAST(sum(CAST(o_totalprice AS DECIMAL(12,2))) AS DOUBLE) / count(o_totalprice) AS AvgRevenuePerEncounter,
  CAST(sum(LengthOfStayHours) AS DOUBLE) / count(LengthOfStayHours) AS AvgLengthOfStayHours, (SELECT count(*) FROM customer) AS TotalPatients
FROM orders JOIN enc ON EncounterID = CAST(o_orderkey AS VARCHAR) JOIN nation ON CAST(n_nationkey AS VARCHAR) = DepartmentID
JOIN region ON r_regionkey = n_regionkey WHERE r_name = 'ASIA'""")
def a07_by_facility(spark, sf):
    """The KPI strip with the facility slicer set."""
    fact = b.fact_encounters(spark, sf, ["PatientSK", "DepartmentSK"])
    return marts.executive_kpis(fact, b.dim_patient(spark, sf), {"FacilityName": ["ASIA"]}, b.dim_department(spark, sf))


@query("a08_monthly_admissions", """
SELECT strftime(AdmitTimestamp, '%Y-%m') AS Month, count(EncounterID) AS Admissions FROM fenc GROUP BY 1""")
def a08(spark, sf):
    return marts.monthly_admissions(b.fact_encounters(spark, sf, []))


@query("a09_volume_by_type", "SELECT EncounterType, count(EncounterID) AS TotalEncounters FROM fenc GROUP BY 1")
def a09(spark, sf):
    return marts.volume_by_type(b.fact_encounters(spark, sf, []))


@query("a10_revenue_by_department", f"""
SELECT DepartmentName, {_REV} AS TotalRevenue FROM fenc LEFT JOIN dimdept USING (DepartmentSK) GROUP BY 1""")
def a10(spark, sf):
    fact = b.fact_encounters(spark, sf, ["DepartmentSK"])
    return marts.revenue_by_department(fact, b.dim_department(spark, sf))


@query("a11_alert_rate", f"""
SELECT count(*) AS TotalReadings, {_ALERTS},
  CAST(count(*) FILTER (WHERE IsCriticalAlert) AS DOUBLE) / count(IsCriticalAlert) AS AlertRate FROM fvit""")
def a11(spark, sf):
    return marts.alert_rate(b.vitals(spark, sf))


@query("a11_by_gender", f"""
SELECT count(*) AS TotalReadings, {_ALERTS}, CAST(count(*) FILTER (WHERE IsCriticalAlert) AS DOUBLE) / count(IsCriticalAlert) AS AlertRate
FROM fvit WHERE PatientSK IN (SELECT md5(CAST(c_custkey AS VARCHAR) || '||{b.FIRST_LOAD}') FROM customer WHERE c_custkey % 2 = 0)""")
def a11_by_gender(spark, sf):
    """Alert rate with the gender slicer set."""
    return marts.alert_rate(b.fact_vitals(spark, sf), {"Gender": [" f"]}, b.dim_patient(spark, sf))


@query("a11_empty_slice", "SELECT 0::BIGINT AS TotalReadings, 0::BIGINT AS CriticalAlerts, NULL::DOUBLE AS AlertRate FROM (SELECT count(*) FROM events)")
def a11_empty(spark, sf):
    """A slicer without rows: the rate is unknown, not an error."""
    return marts.alert_rate(b.vitals(spark, sf), {"DeviceID": ["no such device"]})


@query("a12_average_vitals", f"SELECT {_HR}, {_OX} FROM fvit")
def a12(spark, sf):
    return marts.average_vitals(b.fact_vitals(spark, sf))


@query("a12_average_vitals_by_gender", f"""
SELECT Gender, {_HR}, {_OX} FROM fvit LEFT JOIN dimpat USING (PatientSK) WHERE IsCriticalAlert GROUP BY 1""")
def a12_gender(spark, sf):
    patients = b.dim_patient(spark, sf)
    rows = marts.with_patient(b.fact_vitals(spark, sf), patients, ["Gender"])
    return marts.average_vitals(rows, ["Gender"], {"IsCriticalAlert": [True]})


@query("a13_alerts_by_device", f"SELECT DeviceID, {_ALERTS} FROM fvit GROUP BY 1")
def a13(spark, sf):
    return marts.alerts_by_device(b.vitals(spark, sf))


@query("a14_heart_oxygen_relation", f"""
SELECT DeviceID, {_HR}, {_OX},
  round(corr(CAST(HeartRate AS DOUBLE), CAST(OxygenSaturation AS DOUBLE)), 6) AS Correlation
FROM fvit GROUP BY 1""")
def a14(spark, sf):
    return marts.heart_oxygen_relation(b.fact_vitals(spark, sf))


@query("a15_high_risk_patients", f"""
SELECT PatientSK, PatientID, Gender, Readings, CriticalAlerts, CriticalAlerts::DOUBLE / Readings AS AlertRate,
  {ts('LastAlert')}
FROM (SELECT PatientSK, count(*) AS Readings, {_ALERTS},
        max(EventTimestamp) FILTER (WHERE IsCriticalAlert) AS LastAlert
      FROM fvit WHERE PatientSK IS NOT NULL GROUP BY 1) JOIN dimpat USING (PatientSK)
WHERE CriticalAlerts::DOUBLE / Readings >= 0.5""")
def a15(spark, sf):
    return plain(marts.high_risk_patients(b.fact_vitals(spark, sf), b.dim_patient(spark, sf)))


@query("a16_payer_mix", f"""
SELECT PrimaryInsurancePayer, count(EncounterID) AS TotalEncounters, {_REV} AS TotalRevenue,
  {_REV} / (SELECT {_REV} FROM fenc) AS RevenueShare
FROM fenc LEFT JOIN dimpat USING (PatientSK) GROUP BY 1""")
def a16(spark, sf):
    return marts.payer_mix(b.fact_encounters(spark, sf, ["PatientSK"]), b.dim_patient(spark, sf))


@query("a17_revenue_by_state", f"""
SELECT State, {_REV} AS TotalRevenue, {_ENC_AVG} AS AvgLOS
FROM fenc LEFT JOIN dimpat USING (PatientSK) GROUP BY 1""")
def a17(spark, sf):
    return marts.revenue_by_state(b.fact_encounters(spark, sf, ["PatientSK"]), b.dim_patient(spark, sf))


@query("a18_pass_rate", """
, logs AS (SELECT strftime(AdmitTimestamp, '%Y-%m') AS ExecutionID, count(*) AS n,
    count(*) FILTER (WHERE EncounterID IS NULL OR PatientID IS NULL) AS r1,
    count(*) FILTER (WHERE NOT LengthOfStayHours BETWEEN 0 AND 8760) AS r2,
    count(*) FILTER (WHERE NOT coalesce(TotalBilledAmount >= 0, FALSE)) AS r3 FROM enc GROUP BY 1)
SELECT 'silver.fact_encounters' AS TableName, RuleName, ExecutionID, n AS Checked, f AS Failed,
  1 - f::DOUBLE / n AS PassRate
FROM (SELECT 'RULE_01_NOT_NULL_KEYS' AS RuleName, ExecutionID, n, r1 AS f FROM logs
  UNION ALL SELECT 'RULE_02_VALID_LENGTH_OF_STAY', ExecutionID, n, r2 FROM logs
  UNION ALL SELECT 'RULE_03_VALID_BILLED_AMOUNT', ExecutionID, n, r3 FROM logs)""".lstrip())
def a18(spark, sf):
    """Each month of admissions counts as one run."""
    monthly = b.encounters(spark, sf).withColumn("ExecutionID", F.date_format("AdmitTimestamp", "yyyy-MM"))
    log = quality.rule_counts(monthly, quality.encounter_rules(), by=["ExecutionID"])
    return marts.pass_rate(log.withColumn("TableName", F.lit("silver.fact_encounters")))


@query("a18_empty_run", "SELECT 't' AS TableName, 'r' AS RuleName, o_orderstatus AS ExecutionID, 0::BIGINT AS Checked, 0::BIGINT AS Failed, NULL::DOUBLE AS PassRate FROM orders GROUP BY 3")
def a18_empty(spark, sf):
    """Runs that checked no row have no pass rate."""
    zero = F.lit(0).cast("long")
    log = b.table(spark, sf, "orders").groupBy(F.col("o_orderstatus").alias("ExecutionID")).agg(zero.alias("TotalRecordsChecked"))
    return marts.pass_rate(log.withColumns({"TableName": F.lit("t"), "RuleName": F.lit("r"), "FailedRecordCount": zero}))


@query("a19_run_summary", """
SELECT PipelineName, Layer, count(DISTINCT RunID) AS Runs, count(*) FILTER (WHERE Status = 'SUCCESS') AS Succeeded,
  count(*) FILTER (WHERE Status = 'FAILED') AS Failed, count(*) FILTER (WHERE Status = 'QUARANTINED') AS Quarantined,
  CAST(sum(RecordsIngested) AS BIGINT) AS RecordsIngested,
  CAST(sum(RecordsQuarantined) AS BIGINT) AS RecordsQuarantined,
  CAST(sum(epoch_us(ExecutionEndTime) // 1000000 - epoch_us(ExecutionStartTime) // 1000000) AS BIGINT) AS Seconds,
  arg_max(Status, (ExecutionStartTime, ExecutionID)) AS LastStatus
FROM runs GROUP BY 1, 2""")
def a19(spark, sf):
    return marts.run_summary(b.run_log(spark, sf))


@query("a20_claims_summary", """
SELECT c.ClaimStatus, c.InsurancePayer, Claims, ClaimedAmount, BilledAmount
FROM (SELECT ClaimStatus, InsurancePayer, count(ClaimID) AS Claims, CAST(sum(ClaimAmount) AS DOUBLE) AS ClaimedAmount FROM clm GROUP BY 1, 2) c
JOIN (SELECT ClaimStatus, InsurancePayer, CAST(sum(TotalBilledAmount) AS DOUBLE) AS BilledAmount FROM
  (SELECT DISTINCT ClaimStatus, InsurancePayer, EncounterID FROM clm) LEFT JOIN enc USING (EncounterID) GROUP BY 1, 2) e
USING (ClaimStatus, InsurancePayer)""")
def a20(spark, sf):
    return marts.claims_summary(b.claims(spark, sf), b.encounters(spark, sf))


@query("a20_two_claims_per_encounter", """
SELECT 'OPEN' AS ClaimStatus, 'P' AS InsurancePayer, 2 * count(*) AS Claims, 2 * CAST(sum(CAST(o_totalprice AS DECIMAL(12,2))) AS DOUBLE) AS ClaimedAmount,
  CAST(sum(CAST(o_totalprice AS DECIMAL(12,2))) AS DOUBLE) AS BilledAmount FROM orders""")
def a20_twice(spark, sf):
    """Two claims over the whole bill for every encounter: claimed twice, billed once."""
    encounters = b.encounters(spark, sf)
    claims = encounters.select(
        "EncounterID", F.explode(F.array(F.lit("a"), F.lit("b"))).alias("part"), F.col("TotalBilledAmount").alias("ClaimAmount")
    ).select(F.concat("EncounterID", "part").alias("ClaimID"), "EncounterID", "ClaimAmount", F.lit("OPEN").alias("ClaimStatus"), F.lit("P").alias("InsurancePayer"))
    return marts.claims_summary(claims, encounters)


@query("a21_no_flag", "SELECT coalesce(code, 'UNKNOWN') AS TestCode, count(*) AS Results, 0::BIGINT AS Abnormal, NULL::DOUBLE AS AbnormalRate FROM events LEFT JOIN labtest ON kind = event_type GROUP BY 1")
def a21_no_flag(spark, sf):
    """Results that nobody flagged have no rate."""
    return marts.lab_abnormality(b.labs(spark, sf).withColumn("IsAbnormal", F.lit(None).cast("boolean")))


@query("a21_lab_abnormality", """
SELECT TestCode, count(*) AS Results, count(*) FILTER (WHERE IsAbnormal) AS Abnormal,
  CAST(count(*) FILTER (WHERE IsAbnormal) AS DOUBLE) / count(IsAbnormal) AS AbnormalRate
FROM lab GROUP BY 1""")
def a21(spark, sf):
    return marts.lab_abnormality(b.labs(spark, sf))


_SLICERS = ["FacilityName", "DepartmentName", "EncounterType"]


def _patient_slices(spark, sf):
    """The slice table of the encounter fact, written and read back, so that slices come from it alone."""
    fact = marts.with_department(b.fact_encounters(spark, sf, ["PatientSK", "DepartmentSK"]), b.dim_department(spark, sf))
    numbers = slices.numbered(b.dim_patient(spark, sf), "PatientSK")
    sums = {"Encounters": F.count("EncounterID"), "Revenue": F.sum("TotalBilledAmount").cast("decimal(38,2)")}
    return store(slices.slice_table(fact, numbers, "PatientSK", _SLICERS, sums))


@query("a07_patients_of_every_slice", """
SELECT FacilityName, DepartmentName, EncounterType, CAST(GROUPING(FacilityName, DepartmentName, EncounterType) AS BIGINT) AS level,
  count(DISTINCT PatientSK) AS Patients, count(EncounterID) AS Encounters, CAST(sum(TotalBilledAmount) AS DOUBLE) AS Revenue
FROM fenc LEFT JOIN dimdept USING (DepartmentSK) GROUP BY CUBE (FacilityName, DepartmentName, EncounterType)""")
def a07_every_slice(spark, sf):
    """Patients seen, encounters and revenue for all eight combinations of slicers, from one table of bitmaps."""
    return plain(slices.every_slice(_patient_slices(spark, sf), _SLICERS, ["Encounters", "Revenue"], "Patients"))


@query("p13_patients_of_a_filtered_slice", """
SELECT EncounterType, count(DISTINCT PatientSK) AS Patients, count(EncounterID) AS Encounters
FROM fenc LEFT JOIN dimdept USING (DepartmentSK) WHERE FacilityName IN ('ASIA', 'EUROPE') AND DepartmentName <> 'CHINA' GROUP BY 1""")
def p13_filtered(spark, sf):
    """Two slicers set, a third one shown; patients of several departments count once."""
    table = _patient_slices(spark, sf).where("DepartmentName <> 'CHINA'")
    return slices.by_slice(table, ["EncounterType"], ["Encounters"], "Patients", {"FacilityName": ["ASIA", "EUROPE"]})
