"""Silver transforms: typed, de-duplicated, tagged rows of every entity.

Each returns all rows with their failed rules; quality.split or sources.tables.gate takes them apart.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..contracts import CLAIMS, DEPARTMENTS, ENCOUNTERS, LABS, PATIENTS, PROVIDERS
from ..functions.clinical import claim_in_ratio, claim_in_window, standard_code
from ..functions.keys import business_key
from ..functions.parsing import parse_text
from .dedup import keep_latest, keep_latest_with_nulls, require_unique
from .joins import replicated
from .quality import (
    BUSINESS_RULE, REFERENTIAL_INTEGRITY, Rule, encounter_rules, fully_parsed, in_values, not_null, ordered_times,
)


def with_parent_flag(child: DataFrame, parent: DataFrame, key: str, flag: str) -> DataFrame:
    """``flag`` is TRUE where the key is known to the parent, FALSE where not, NULL without a key."""
    known = parent.select(key).where(F.col(key).isNotNull()).distinct().withColumn("_known", F.lit(True))
    joined = child.join(known, key, "left")
    return joined.withColumn(
        flag, F.when(F.col(key).isNotNull(), F.coalesce("_known", F.lit(False)))
    ).drop("_known")


def known_parent(flag: str, name: str) -> Rule:
    """Referential integrity of a with_parent_flag column; an absent key is the key rule's business."""
    return Rule(name, REFERENTIAL_INTEGRITY, F.col(flag), on_null="pass")


def encounters(raw_text: DataFrame) -> DataFrame:
    typed = parse_text(raw_text, ENCOUNTERS, keep_text=True)
    return keep_latest_with_nulls(typed, ["EncounterID"], ["AdmitTimestamp"])


def all_encounter_rules() -> list[Rule]:
    return [*encounter_rules(), fully_parsed(), ordered_times("AdmitTimestamp", "DischargeTimestamp")]


def patients(raw_text: DataFrame) -> DataFrame:
    typed = parse_text(raw_text, PATIENTS, keep_text=True)
    return typed.withColumn("Gender", standard_code(F.col("Gender")))


def patient_rules() -> list[Rule]:
    return [
        not_null("PatientID", "UpdatedTimestamp", name="NOT_NULL_PATIENT_ID"),
        in_values("Gender", ["M", "F"], on_null="pass"),
        fully_parsed(),
    ]


def providers(raw_text: DataFrame) -> DataFrame:
    """All-text provider rows with their surrogate key; fails when a ProviderID repeats."""
    rows = require_unique(raw_text.select(*PROVIDERS.names), ["ProviderID"])
    return rows.withColumn("ProviderSK", business_key("ProviderID"))


def departments(raw_text: DataFrame) -> DataFrame:
    rows = require_unique(raw_text.select(*DEPARTMENTS.names), ["DepartmentID"])
    return rows.withColumn("DepartmentSK", business_key("DepartmentID"))


def flag_abnormal(rows: DataFrame, reference: DataFrame) -> DataFrame:
    """Recompute the abnormal flag from the reference ranges; NULL for a test without a range."""
    ranges = replicated(reference.select("TestCode", "MinNormal", "MaxNormal"))
    return rows.join(ranges, "TestCode", "left").withColumn(
        "IsAbnormalDerived", ~F.col("TestValue").between(F.col("MinNormal"), F.col("MaxNormal"))
    )


def labs(rows: DataFrame, reference: DataFrame, encounter_keys: DataFrame) -> DataFrame:
    latest = keep_latest_with_nulls(rows.select(*LABS.names), ["LabResultID"], ["ResultTimestamp"])
    return with_parent_flag(flag_abnormal(latest, reference), encounter_keys, "EncounterID", "_encounter_known")


def lab_rules() -> list[Rule]:
    return [
        not_null("LabResultID", "EncounterID", "PatientID", name="NOT_NULL_LAB_KEYS"),
        Rule("ABNORMAL_FLAG_MATCHES_RANGE", BUSINESS_RULE,
             F.col("IsAbnormal") == F.col("IsAbnormalDerived"), on_null="pass"),
        known_parent("_encounter_known", "LAB_ENCOUNTER_EXISTS"),
    ]


def claims(rows: DataFrame, encounter_rows: DataFrame) -> DataFrame:
    """Latest row per claim, beside the admission and billed amount of its encounter's latest row."""
    latest = keep_latest_with_nulls(rows.select(*CLAIMS.names), ["ClaimID"], ["ClaimDate"])
    known = encounter_rows.where(F.col("EncounterID").isNotNull()).select("EncounterID", "AdmitTimestamp", "TotalBilledAmount")
    billed = keep_latest(known, ["EncounterID"], ["AdmitTimestamp"]).withColumn("_known", F.lit(True))
    joined = latest.join(billed, "EncounterID", "left")
    return joined.withColumn(
        "_encounter_known", F.when(F.col("EncounterID").isNotNull(), F.coalesce("_known", F.lit(False)))
    ).drop("_known")


def claim_rules() -> list[Rule]:
    return [
        not_null("ClaimID", "EncounterID", "PatientID", name="NOT_NULL_CLAIM_KEYS"),
        known_parent("_encounter_known", "CLAIM_ENCOUNTER_EXISTS"),
        Rule("CLAIM_DATE_AFTER_ADMIT", BUSINESS_RULE, claim_in_window(), on_null="pass"),
        Rule("CLAIM_AMOUNT_NEAR_BILLED", BUSINESS_RULE, claim_in_ratio(), on_null="pass"),
    ]
