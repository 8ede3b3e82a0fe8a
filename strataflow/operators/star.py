"""The Gold star schema: three dimensions and two facts."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..contracts import DIM_DEPARTMENT, DIM_PATIENT, DIM_PROVIDER, FACT_ENCOUNTERS, FACT_VITALS
from ..functions.keys import business_key
from .joins import as_of, lookup
from .scd2 import END, START, as_current


def _names(contract) -> list[str]:
    return [c.name for c in contract]


def dim_patient(versions: DataFrame) -> DataFrame:
    """The current version of every patient."""
    return as_current(versions).select(*_names(DIM_PATIENT))


def dim_provider(providers: DataFrame) -> DataFrame:
    return providers.withColumn("ProviderSK", business_key("ProviderID")).select(*_names(DIM_PROVIDER))


def dim_department(departments: DataFrame) -> DataFrame:
    return departments.withColumn("DepartmentSK", business_key("DepartmentID")).select(
        *_names(DIM_DEPARTMENT)
    )


def _resolve(encounters: DataFrame, providers: DataFrame | None, departments: DataFrame | None) -> DataFrame:
    for dim, key, surrogate in (
        (providers, "ProviderID", "ProviderSK"), (departments, "DepartmentID", "DepartmentSK"),
    ):
        if dim is not None:
            encounters = lookup(encounters, dim, key, [surrogate])
    have = set(encounters.columns)
    return encounters.select(
        *[c if c in have else F.lit(None).cast("string").alias(c) for c in _names(FACT_ENCOUNTERS)]
    )


def fact_encounters(
    encounters: DataFrame, patients: DataFrame | None = None, providers: DataFrame | None = None,
    departments: DataFrame | None = None,
) -> DataFrame:
    """Encounters with the surrogate keys of the current dimension rows.

    A dimension that is left out costs no join and leaves its key NULL.
    """
    if patients is not None:
        encounters = lookup(encounters, patients, "PatientID", ["PatientSK"])
    return _resolve(encounters, providers, departments)


def fact_encounters_as_of(
    encounters: DataFrame, versions: DataFrame, providers: DataFrame | None = None,
    departments: DataFrame | None = None, **opts,
) -> DataFrame:
    """Encounters with the patient version that was valid at admission."""
    keyed = as_of(encounters, versions, "PatientID", "AdmitTimestamp", START, END, ["PatientSK"], **opts)
    return _resolve(keyed, providers, departments)


def fact_vitals(vitals: DataFrame, patients: DataFrame, also=()) -> DataFrame:
    """Telemetry with the current patient key, in warehouse types, and the columns ``also``. Works on batch and stream."""
    keyed = lookup(vitals, patients, "PatientID", ["PatientSK"])
    return keyed.select(*[F.col(c.name).try_cast(c.kind).alias(c.name) for c in FACT_VITALS], *also)
