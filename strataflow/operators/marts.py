"""Serving aggregates over the star schema.

Averages are exact sums divided once, so they do not depend on the order of rows. ``filters`` maps a
column to the values to keep and is applied before aggregating, where it can reach the scan.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F


def sliced(df: DataFrame, filters: dict | None) -> DataFrame:
    for col, values in (filters or {}).items():
        df = df.where(F.col(col).isin(*values))
    return df


def total(col: str, decimals: str = "decimal(38,2)") -> Column:
    return F.sum(F.col(col)).cast(decimals).cast("double")


def mean(col: str) -> Column:
    return F.try_divide(F.sum(F.col(col)).cast("double"), F.count(F.col(col)))


def alert_count() -> Column:
    return F.count_if(F.col("IsCriticalAlert"))


# --- encounter views ---------------------------------------------------------------------------

def with_department(fact: DataFrame, departments: DataFrame) -> DataFrame:
    dim = departments.select("DepartmentSK", "DepartmentName", "FacilityName")
    return fact.join(dim, "DepartmentSK", "left")


def with_patient(fact: DataFrame, patients: DataFrame, cols=("PrimaryInsurancePayer", "State")) -> DataFrame:
    return fact.join(patients.select("PatientSK", *cols), "PatientSK", "left")


def _by_department(fact: DataFrame, departments: DataFrame | None) -> DataFrame:
    """The fact with facility and department to slice by, if departments are given."""
    return fact if departments is None else with_department(fact, departments)


def _by_patient(vitals: DataFrame, patients: DataFrame | None) -> DataFrame:
    """The telemetry with the patient's gender to slice by, if patients are given."""
    return vitals if patients is None else with_patient(vitals, patients, ["Gender"])


def encounter_summary(fact: DataFrame, departments: DataFrame, filters=None) -> DataFrame:
    rows = sliced(with_department(fact, departments), filters)
    return rows.groupBy("DepartmentName", "FacilityName", "EncounterType").agg(
        F.count("EncounterID").alias("TotalEncounters"),
        mean("LengthOfStayHours").alias("AvgLengthOfStayHours"),
        total("TotalBilledAmount").alias("TotalRevenue"),
        mean("TotalBilledAmount").alias("AvgBilledAmount"),
    )


def _per_patient(fact: DataFrame, patients: DataFrame, by, filters) -> DataFrame:
    """Encounters summed per patient and the fact's columns ``by``, then joined: a patient's many encounters meet the dimension
    once. Filters on the fact apply before, those on the patient after. Sums are exact decimals, so parts add up."""
    own = {c: v for c, v in (filters or {}).items() if c in fact.columns}
    sums = sliced(fact, own).groupBy("PatientSK", *by).agg(
        F.count("EncounterID").alias("_encounters"), F.sum("TotalBilledAmount").alias("_revenue"),
        F.sum("LengthOfStayHours").alias("_hours"), F.count("LengthOfStayHours").alias("_stays"),
    )
    return sliced(with_patient(sums, patients), {c: v for c, v in (filters or {}).items() if c not in own})


def _encounters() -> Column:
    return F.coalesce(F.sum("_encounters"), F.lit(0))


def _mean_stay() -> Column:
    return F.try_divide(F.sum("_hours").cast("double"), F.sum("_stays"))


def revenue_by_payer(fact: DataFrame, patients: DataFrame, filters=None) -> DataFrame:
    rows = _per_patient(fact, patients, ["EncounterType"], filters)
    return rows.groupBy("PrimaryInsurancePayer", "State", "EncounterType").agg(
        _encounters().alias("TotalEncounters"), total("_revenue").alias("TotalRevenue"), _mean_stay().alias("AvgLOS"),
    )


def facility_summary(fact: DataFrame, departments: DataFrame, filters=None) -> DataFrame:
    rows = sliced(with_department(fact, departments), filters)
    return (
        rows.groupBy("FacilityName", "EncounterType")
        .agg(
            F.count("EncounterID").alias("TotalEncounters"),
            F.round(mean("LengthOfStayHours"), 1).alias("AvgLengthOfStayHours"),
            F.round(total("TotalBilledAmount"), 2).alias("TotalBilledAmount"),
        )
        .orderBy(F.desc("TotalBilledAmount"), "FacilityName", "EncounterType")
    )


def executive_kpis(fact: DataFrame, patients: DataFrame, filters=None, departments: DataFrame | None = None) -> DataFrame:
    """Patients on file, patients seen, encounters, revenue, revenue per encounter, mean stay."""
    return sliced(_by_department(fact, departments), filters).agg(
        F.countDistinct("PatientSK").alias("PatientsSeen"),
        F.count("EncounterID").alias("TotalEncounters"),
        total("TotalBilledAmount").alias("TotalRevenue"),
        mean("TotalBilledAmount").alias("AvgRevenuePerEncounter"),
        mean("LengthOfStayHours").alias("AvgLengthOfStayHours"),
    ).withColumn("TotalPatients", patients.agg(F.count(F.lit(1))).scalar())


def monthly_admissions(fact: DataFrame, filters=None, departments: DataFrame | None = None) -> DataFrame:
    month = F.date_format("AdmitTimestamp", "yyyy-MM").alias("Month")
    return sliced(_by_department(fact, departments), filters).groupBy(month).agg(F.count("EncounterID").alias("Admissions"))


def volume_by_type(fact: DataFrame, filters=None, departments: DataFrame | None = None) -> DataFrame:
    return sliced(_by_department(fact, departments), filters).groupBy("EncounterType").agg(
        F.count("EncounterID").alias("TotalEncounters")
    )


def revenue_by_department(fact: DataFrame, departments: DataFrame, filters=None) -> DataFrame:
    rows = sliced(with_department(fact, departments), filters)
    return rows.groupBy("DepartmentName").agg(total("TotalBilledAmount").alias("TotalRevenue"))


def payer_mix(fact: DataFrame, patients: DataFrame, filters=None) -> DataFrame:
    """Encounters, revenue and share of revenue by payer."""
    by_payer = _per_patient(fact, patients, [], filters).groupBy("PrimaryInsurancePayer").agg(
        _encounters().alias("TotalEncounters"), F.sum("_revenue").alias("_revenue")
    )
    return (
        with_share(by_payer, "_revenue", "RevenueShare")
        .withColumn("TotalRevenue", F.col("_revenue").cast("double"))
        .drop("_revenue")
    )


def with_share(df: DataFrame, measure: str, out: str) -> DataFrame:
    """Share of each row's measure in the total, from a scalar subquery rather than one-task window."""
    whole = df.agg(F.sum(measure).cast("double")).scalar()
    return df.withColumn(out, F.try_divide(F.col(measure).cast("double"), whole))


def revenue_by_state(fact: DataFrame, patients: DataFrame, filters=None) -> DataFrame:
    return _per_patient(fact, patients, [], filters).groupBy("State").agg(
        total("_revenue").alias("TotalRevenue"), _mean_stay().alias("AvgLOS")
    )


# --- telemetry views ---------------------------------------------------------------------------

def critical_vitals(vitals: DataFrame, filters=None, patients: DataFrame | None = None) -> DataFrame:
    return sliced(_by_patient(vitals, patients), filters).groupBy("DeviceID", "EncounterID").agg(
        F.count(F.lit(1)).alias("TotalReadings"),
        alert_count().alias("CriticalAlerts"),
        mean("HeartRate").alias("AvgHeartRate"),
        mean("OxygenSaturation").alias("AvgOxygenSaturation"),
        F.min("EventTimestamp").alias("FirstReading"),
        F.max("EventTimestamp").alias("LastReading"),
    )


def alert_rate(vitals: DataFrame, filters=None, patients: DataFrame | None = None) -> DataFrame:
    return sliced(_by_patient(vitals, patients), filters).agg(
        F.count(F.lit(1)).alias("TotalReadings"),
        alert_count().alias("CriticalAlerts"),
        F.try_divide(alert_count(), F.count("IsCriticalAlert")).alias("AlertRate"),
    )


def average_vitals(vitals: DataFrame, by=(), filters=None) -> DataFrame:
    return sliced(vitals, filters).groupBy(*by).agg(
        mean("HeartRate").alias("AvgHeartRate"), mean("OxygenSaturation").alias("AvgOxygenSaturation")
    )


def alerts_by_device(vitals: DataFrame, filters=None, patients: DataFrame | None = None) -> DataFrame:
    return sliced(_by_patient(vitals, patients), filters).groupBy("DeviceID").agg(alert_count().alias("CriticalAlerts"))


def heart_oxygen_relation(vitals: DataFrame, by=("DeviceID",), filters=None) -> DataFrame:
    pair = (F.col("HeartRate").cast("double"), F.col("OxygenSaturation").cast("double"))
    return sliced(vitals, filters).groupBy(*by).agg(
        mean("HeartRate").alias("AvgHeartRate"),
        mean("OxygenSaturation").alias("AvgOxygenSaturation"),
        F.round(F.corr(*pair), 6).alias("Correlation"),
    )


def high_risk_patients(
    vitals: DataFrame, patients: DataFrame, min_rate: float = 0.5, min_readings: int = 1, filters=None
) -> DataFrame:
    """Patients whose share of alerting readings reaches ``min_rate``."""
    per_patient = sliced(vitals, filters).where(F.col("PatientSK").isNotNull()).groupBy("PatientSK").agg(
        F.count(F.lit(1)).alias("Readings"),
        alert_count().alias("CriticalAlerts"),
        F.max(F.when(F.col("IsCriticalAlert"), F.col("EventTimestamp"))).alias("LastAlert"),
    )
    risky = per_patient.withColumn("AlertRate", F.col("CriticalAlerts") / F.col("Readings")).where(
        (F.col("AlertRate") >= min_rate) & (F.col("Readings") >= min_readings)
    )
    return risky.join(patients.select("PatientSK", "PatientID", "Gender"), "PatientSK", "left")


def encounter_telemetry(encounters: DataFrame, vitals: DataFrame) -> DataFrame:
    """Readings and alerts per encounter, with readings that name another patient counted apart.

    Readings are pre-aggregated by (encounter, patient) before the join, so a hot encounter shuffles
    a few partial rows.
    """
    readings = vitals.groupBy("EncounterID", F.col("PatientID").alias("_patient")).agg(
        F.count(F.lit(1)).alias("_n"), alert_count().alias("_alerts")
    )
    joined = encounters.select("EncounterID", "PatientID").join(readings, "EncounterID", "inner")
    other = ~F.col("PatientID").eqNullSafe(F.col("_patient"))
    return joined.groupBy("EncounterID").agg(
        F.sum("_n").alias("Readings"), F.sum("_alerts").alias("CriticalAlerts"),
        F.coalesce(F.sum(F.when(other, F.col("_n"))), F.lit(0)).alias("OtherPatientReadings"),
    )


# --- claims, labs, audit -----------------------------------------------------------------------

def claims_summary(claims: DataFrame, encounters: DataFrame) -> DataFrame:
    """Claims by status and payer, against what their encounters billed.

    Within a group an encounter's bill counts once, however many claims it has. Claims are summed per group
    and encounter before the join, on the encounter's key.
    """
    by = ["ClaimStatus", "InsurancePayer"]
    per_encounter = claims.groupBy("EncounterID", *by).agg(
        F.count("ClaimID").alias("_claims"), F.sum("ClaimAmount").alias("_claimed")
    )
    billed = encounters.where(F.col("EncounterID").isNotNull()).groupBy("EncounterID").agg(
        F.max("TotalBilledAmount").alias("TotalBilledAmount")
    )
    return per_encounter.join(billed, "EncounterID", "left").groupBy(*by).agg(
        F.sum("_claims").alias("Claims"),
        total("_claimed").alias("ClaimedAmount"),
        total("TotalBilledAmount").alias("BilledAmount"),
    )


def lab_abnormality(labs: DataFrame) -> DataFrame:
    return labs.groupBy("TestCode").agg(
        F.count(F.lit(1)).alias("Results"),
        F.count_if("IsAbnormal").alias("Abnormal"),
        F.try_divide(F.count_if("IsAbnormal"), F.count("IsAbnormal")).alias("AbnormalRate"),
    )


def pass_rate(rule_log: DataFrame, by=("TableName", "RuleName", "ExecutionID")) -> DataFrame:
    return rule_log.groupBy(*by).agg(
        F.sum("TotalRecordsChecked").alias("Checked"),
        F.sum("FailedRecordCount").alias("Failed"),
        (1 - F.try_divide(F.sum("FailedRecordCount"), F.sum("TotalRecordsChecked"))).alias("PassRate"),
    )


def run_summary(run_log: DataFrame) -> DataFrame:
    """Per pipeline and layer: runs by outcome, rows, and time spent."""
    seconds = F.unix_seconds("ExecutionEndTime") - F.unix_seconds("ExecutionStartTime")
    return run_log.groupBy("PipelineName", "Layer").agg(
        F.countDistinct("RunID").alias("Runs"),
        F.count_if(F.col("Status") == "SUCCESS").alias("Succeeded"),
        F.count_if(F.col("Status") == "FAILED").alias("Failed"),
        F.count_if(F.col("Status") == "QUARANTINED").alias("Quarantined"),
        F.sum("RecordsIngested").alias("RecordsIngested"),
        F.sum("RecordsQuarantined").alias("RecordsQuarantined"),
        F.sum(seconds).alias("Seconds"),
        F.max_by("Status", F.struct("ExecutionStartTime", "ExecutionID")).alias("LastStatus"),
    )
