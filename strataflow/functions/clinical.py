"""Derived clinical columns."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

# Alert bounds of the bedside monitors.
HEART_RATE_HIGH = 120
HEART_RATE_LOW = 55
OXYGEN_LOW = 90.0
SYSTOLIC_HIGH = 160

# Laboratory tests with their normal range.
LAB_TESTS = (
    ("LOINC_8480-6", "Systolic Blood Pressure", "mmHg", 90.0, 140.0),
    ("LOINC_15074-8", "Glucose", "mg/dL", 70.0, 180.0),
    ("LOINC_2823-3", "Potassium", "mmol/L", 3.5, 5.2),
    ("LOINC_5792-7", "Troponin I", "ng/mL", 0.0, 0.04),
)

# Claims follow admission by 1 to 15 days and are 0.8 to 1.2 of the billed amount.
CLAIM_DAYS = (1, 15)
CLAIM_RATIO = (0.8, 1.2)

OPEN_STAY = "ADMITTED"


def critical_alert(
    heart_rate: str = "HeartRate", oxygen: str = "OxygenSaturation",
    systolic: str = "BloodPressureSystolic",
) -> Column:
    """True when any reading is out of bounds; a missing reading alone raises no alert."""
    outside = [
        ~F.col(heart_rate).between(HEART_RATE_LOW, HEART_RATE_HIGH),
        F.col(oxygen) < OXYGEN_LOW,
        F.col(systolic) > SYSTOLIC_HIGH,
    ]
    hit = F.coalesce(outside[0], F.lit(False))
    for test in outside[1:]:
        hit = hit | F.coalesce(test, F.lit(False))
    return hit


def stay_hours(admit: str = "AdmitTimestamp", discharge: str = "DischargeTimestamp") -> Column:
    micros = F.unix_micros(F.col(discharge)) - F.unix_micros(F.col(admit))
    return (micros / F.lit(3_600_000_000)).try_cast("decimal(10,2)")


def open_stay_consistent(
    status: str = "DischargeStatus", discharge: str = "DischargeTimestamp",
    hours: str = "LengthOfStayHours", open_value: str = OPEN_STAY,
) -> Column:
    """Open stays carry neither discharge time nor length of stay; closed ones carry both."""
    is_open = F.coalesce(F.col(status) == open_value, F.lit(False))
    return F.when(is_open, F.col(discharge).isNull() & F.col(hours).isNull()).otherwise(
        F.col(discharge).isNotNull() & F.col(hours).isNotNull()
    )


def age_years(birth: Column, on: Column) -> Column:
    return F.floor(F.months_between(on, birth) / 12)


def standard_code(col: Column) -> Column:
    """A coded value in its standard spelling."""
    return F.upper(F.trim(col))


def lab_reference(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(
        LAB_TESTS, "TestCode string, TestName string, Unit string, MinNormal double, MaxNormal double"
    )


def claim_in_window(claim_date: str = "ClaimDate", admit: str = "AdmitTimestamp") -> Column:
    return F.datediff(F.col(claim_date), F.to_date(F.col(admit))).between(*CLAIM_DAYS)


def claim_in_ratio(claim: str = "ClaimAmount", billed: str = "TotalBilledAmount") -> Column:
    """Claim within the allowed share of the billed amount, compared in exact decimals."""
    low, high = (F.lit(str(r)).cast("decimal(3,1)") for r in CLAIM_RATIO)
    return F.col(claim).between(F.col(billed) * low, F.col(billed) * high)
