"""Declared schemas of the source entities, Gold tables and control tables.

Every reader takes its schema from here; nothing is inferred. Text formats (CSV) are read with
``text_contract`` so that a value that does not parse can be reported with its original text.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T

S, I, L, D, B = T.StringType(), T.IntegerType(), T.LongType(), T.DoubleType(), T.BooleanType()
TS, DATE = T.TimestampType(), T.DateType()
AMOUNT, HOURS = T.DecimalType(12, 2), T.DecimalType(10, 2)


def _schema(**cols: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind, True) for name, kind in cols.items()])


# Column names and types below are fixed values of the data model.
DEPARTMENTS = _schema(DepartmentID=S, DepartmentName=S, FacilityName=S)

PROVIDERS = _schema(ProviderID=S, NPI_Number=S, ProviderName=S, Specialty=S, DepartmentID=S)

PATIENTS = _schema(
    PatientID=S, MedicalRecordNumber=S, FirstName=S, LastName=S, DateOfBirth=DATE, Gender=S,
    PrimaryLanguage=S, AddressLine=S, City=S, State=S, ZipCode=S, PrimaryInsurancePayer=S,
    UpdatedTimestamp=TS,
)

ENCOUNTERS = _schema(
    EncounterID=S, PatientID=S, ProviderID=S, DepartmentID=S, EncounterType=S, AdmitTimestamp=TS,
    DischargeTimestamp=TS, LengthOfStayHours=HOURS, AdmitReason=S, DischargeStatus=S,
    TotalBilledAmount=AMOUNT,
)

CLAIMS = _schema(
    ClaimID=S, EncounterID=S, PatientID=S, ClaimAmount=AMOUNT, InsurancePayer=S, ClaimStatus=S,
    ClaimDate=DATE,
)

LABS = _schema(
    LabResultID=S, EncounterID=S, PatientID=S, TestCode=S, TestName=S, TestValue=D, Unit=S,
    IsAbnormal=B, ResultTimestamp=TS,
)

# The payload keeps the event time as text; it is parsed after decoding.
VITALS_PAYLOAD = _schema(
    TelemetryID=S, PatientID=S, EncounterID=S, DeviceID=S, HeartRate=I, BloodPressureSystolic=I,
    BloodPressureDiastolic=I, OxygenSaturation=D, BodyTemperature=D, IsCriticalAlert=B,
    EventTimestamp=S,
)

VITALS = T.StructType(
    [f if f.name != "EventTimestamp" else T.StructField(f.name, TS) for f in VITALS_PAYLOAD]
)

INGESTION_CONTROL = _schema(
    SourceID=L, SourceSystem=S, EntityName=S, SourceFormat=S, SourceFolderPath=S,
    TargetBronzePath=S, TargetSilverTable=S, IngestionType=S, WatermarkColumn=S, WatermarkValue=TS,
    IsActive=B, CreatedDate=TS, UpdatedDate=TS,
)

RUN_LOG = _schema(
    ExecutionID=S, PipelineName=S, RunID=S, SourceEntity=S, Layer=S, Status=S, RecordsIngested=L,
    RecordsQuarantined=L, ExecutionStartTime=TS, ExecutionEndTime=TS, ErrorMessage=S, ExecutedBy=S,
)

RULE_LOG = _schema(
    ExecutionID=S, TableName=S, RuleName=S, RuleType=S, TotalRecordsChecked=L, FailedRecordCount=L,
    QuarantineLocation=S, LogTimestamp=TS,
)

ENTITIES = {
    "Departments": DEPARTMENTS, "Providers": PROVIDERS, "Patients": PATIENTS,
    "Encounters": ENCOUNTERS, "BillingClaims": CLAIMS, "LabResults": LABS, "PatientVitals": VITALS,
}


def text_contract(contract: T.StructType) -> T.StructType:
    """The same columns, all as text."""
    return T.StructType([T.StructField(f.name, S, True) for f in contract])


@dataclass(frozen=True)
class GoldColumn:
    name: str
    kind: T.DataType
    required: bool = True
    length: int | None = None


def _text(name: str, length: int, required: bool = True) -> GoldColumn:
    return GoldColumn(name, S, required, length)


# Types, nullability and lengths of the warehouse tables are fixed values.
DIM_PATIENT = (
    _text("PatientSK", 32), _text("PatientID", 50), _text("MedicalRecordNumber", 50),
    _text("FirstName", 100), _text("LastName", 100), GoldColumn("DateOfBirth", DATE),
    _text("Gender", 20), _text("PrimaryLanguage", 50, False), _text("AddressLine", 255, False),
    _text("City", 100, False), _text("State", 2, False), _text("ZipCode", 10, False),
    _text("PrimaryInsurancePayer", 100, False), GoldColumn("EffectiveStartDate", TS),
)

DIM_PROVIDER = (
    _text("ProviderSK", 32), _text("ProviderID", 50), _text("NPI_Number", 10),
    _text("ProviderName", 150), _text("Specialty", 100), _text("DepartmentID", 50),
)

DIM_DEPARTMENT = (
    _text("DepartmentSK", 32), _text("DepartmentID", 50), _text("DepartmentName", 100),
    _text("FacilityName", 150),
)

FACT_ENCOUNTERS = (
    _text("EncounterID", 50), _text("PatientSK", 32, False), _text("ProviderSK", 32, False),
    _text("DepartmentSK", 32, False), _text("EncounterType", 50), GoldColumn("AdmitTimestamp", TS),
    GoldColumn("DischargeTimestamp", TS, False), GoldColumn("LengthOfStayHours", HOURS, False),
    _text("AdmitReason", 255, False), _text("DischargeStatus", 50, False),
    GoldColumn("TotalBilledAmount", AMOUNT),
)

FACT_VITALS = (
    _text("TelemetryID", 100), _text("PatientSK", 32, False), _text("EncounterID", 50),
    _text("DeviceID", 50), GoldColumn("HeartRate", I), GoldColumn("BloodPressureSystolic", I),
    GoldColumn("BloodPressureDiastolic", I), GoldColumn("OxygenSaturation", T.DecimalType(5, 2)),
    GoldColumn("BodyTemperature", T.DecimalType(4, 1)), GoldColumn("IsCriticalAlert", B),
    GoldColumn("EventTimestamp", TS),
)

GOLD = {
    "dim_patient": DIM_PATIENT, "dim_provider": DIM_PROVIDER, "dim_department": DIM_DEPARTMENT,
    "fact_patient_encounters": FACT_ENCOUNTERS, "fact_vitals_telemetry": FACT_VITALS,
}


def gold_schema(table: str) -> T.StructType:
    return T.StructType([T.StructField(c.name, c.kind, not c.required) for c in GOLD[table]])
