"""P-*, J-*, W-*, O-*, U-*: projections, joins, windows, sorts and set operations."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.clinical import standard_code
from ..functions.masking import mask_columns, pads
from ..functions.parsing import decode_json
from ..contracts import VITALS_PAYLOAD
from ..operators import control, dedup, joins, marts, quality, scd2, star
from ..operators.ordered import in_order
from ..sources.files import serve
from ..sources.tables import store
from . import bindings as b
from .registry import day, num, plain, query, ts

_ENC_TEXT = f"""EncounterID, PatientID, ProviderID, DepartmentID, EncounterType, {ts('AdmitTimestamp')},
  {ts('DischargeTimestamp')}, {num('LengthOfStayHours')}, AdmitReason, DischargeStatus, {num('TotalBilledAmount')}"""
_FENC_TEXT = _ENC_TEXT.replace("PatientID, ProviderID, DepartmentID", "PatientSK, ProviderSK, DepartmentSK")
_CLM_TEXT = f"ClaimID, EncounterID, PatientID, {num('ClaimAmount')}, InsurancePayer, ClaimStatus, {day('ClaimDate')}"
_VIT_TEXT = f"""TelemetryID, PatientID, EncounterID, DeviceID, HeartRate, BloodPressureSystolic,
  BloodPressureDiastolic, OxygenSaturation, {num('BodyTemperature')}, {ts('EventTimestamp')}, IsCriticalAlert"""
_FVIT_TEXT = _VIT_TEXT.replace("PatientID", "PatientSK").replace(
    "OxygenSaturation", num("OxygenSaturation")
)


@query("p01_projection", "SELECT ProviderSK, ProviderID, NPI_Number, ProviderName, Specialty, DepartmentID FROM dimprov")
def p01(spark, sf):
    return b.dim_provider(spark, sf)


@query("p02_struct_expansion", f"SELECT {_VIT_TEXT} FROM vit")
def p02(spark, sf):
    """Telemetry packed to JSON and expanded again."""
    vitals = b.vitals(spark, sf)
    payload = F.to_json(F.struct(*vitals.columns), {"timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX"})
    data = vitals.select(decode_json(payload, VITALS_PAYLOAD).alias("data")).select("data.*")
    typed = data.withColumn("EventTimestamp", F.col("EventTimestamp").try_cast("timestamp"))
    return plain(typed.drop("_corrupt_record"))


@query("p03_derived_columns", f"SELECT {_ENC_TEXT}, 'EPIC_EHR' AS _source_system FROM enc")
def p03(spark, sf):
    return plain(b.encounters(spark, sf).withColumn("_source_system", F.lit("EPIC_EHR")))


@query("p04_drop_columns", "SELECT EncounterID, EncounterType, DischargeStatus FROM enc")
def p04(spark, sf):
    return b.encounters(spark, sf).drop(
        "PatientID", "ProviderID", "DepartmentID", "AdmitTimestamp", "DischargeTimestamp",
        "LengthOfStayHours", "AdmitReason", "TotalBilledAmount",
    )


@query("p05_alias", "SELECT p.ProviderName AS Provider, d.DepartmentName AS Department FROM prov p LEFT JOIN dept d USING (DepartmentID)")
def p05(spark, sf):
    provider, department = b.providers(spark, sf).alias("p"), b.departments(spark, sf).alias("d")
    joined = provider.join(department, F.col("p.DepartmentID") == F.col("d.DepartmentID"), "left")
    return joined.select(F.col("p.ProviderName").alias("Provider"), F.col("d.DepartmentName").alias("Department"))


_DIMPAT_TEXT = f"""PatientSK, PatientID, MedicalRecordNumber, FirstName, LastName, {day('DateOfBirth')}, Gender,
  PrimaryLanguage, AddressLine, City, State, ZipCode, PrimaryInsurancePayer, {ts('EffectiveStartDate')}"""


@query("p06_current_versions", f"SELECT {_DIMPAT_TEXT} FROM dimpatcur")
def p06(spark, sf):
    return plain(b.dim_patient_current(spark, sf))


@query("p07_not_null_keys", "SELECT EncounterID, ProviderID FROM enc WHERE EncounterID IS NOT NULL AND ProviderID IS NOT NULL")
def p07(spark, sf):
    rows = b.encounters(spark, sf)
    return rows.where(quality.not_null("EncounterID", "ProviderID").check).select("EncounterID", "ProviderID")


@query("p08_closed_range", f"SELECT EncounterID, {num('LengthOfStayHours')} FROM enc WHERE LengthOfStayHours BETWEEN 0 AND 8760")
def p08(spark, sf):
    rows = b.encounters(spark, sf).where(quality.in_range("LengthOfStayHours", 0, 8760).check)
    return plain(rows.select("EncounterID", "LengthOfStayHours"))


@query("p09_lower_bound", "SELECT c_custkey, c_acctbal FROM customer WHERE c_acctbal >= 0")
def p09(spark, sf):
    rows = b.table(spark, sf, "customer").where(quality.in_range("c_acctbal", 0).check)
    return rows.select("c_custkey", "c_acctbal")


@query("p10_negated_conjunction", """
SELECT EncounterID FROM enc WHERE NOT (EncounterID IS NOT NULL AND PatientID IS NOT NULL
  AND (LengthOfStayHours IS NULL OR LengthOfStayHours BETWEEN 0 AND 8760) AND TotalBilledAmount >= 0)""")
def p10(spark, sf):
    _, invalid = quality.split(b.encounters(spark, sf), quality.encounter_rules())
    return invalid.select("EncounterID")


@query("p11_any_column_changed", """
SELECT v.PatientID FROM ver1 v JOIN pat2 n USING (PatientID)
WHERE v.AddressLine IS DISTINCT FROM n.AddressLine OR v.City IS DISTINCT FROM n.City
  OR v.PrimaryInsurancePayer IS DISTINCT FROM n.PrimaryInsurancePayer""")
def p11(spark, sf):
    old, new = b.patients(spark, sf).alias("old"), b.patients_second_load(spark, sf).alias("new")
    both = old.join(new, F.col("old.PatientID") == F.col("new.PatientID"))
    return both.where(scd2.any_changed("old", "new", scd2.PATIENT_TRACKED)).select("old.PatientID")


@query("p12_active_batch_entities", "SELECT SourceID, EntityName FROM ctl WHERE IsActive AND IngestionType <> 'STREAMING'")
def p12(spark, sf):
    return control.active_entities(b.control(spark, sf)).select("SourceID", "EntityName")


@query("p13_slicers", """
SELECT DepartmentName, FacilityName, EncounterType, count(EncounterID) AS TotalEncounters,
  CAST(sum(LengthOfStayHours) AS DOUBLE) / count(LengthOfStayHours) AS AvgLengthOfStayHours,
  CAST(sum(TotalBilledAmount) AS DOUBLE) AS TotalRevenue,
  CAST(sum(TotalBilledAmount) AS DOUBLE) / count(TotalBilledAmount) AS AvgBilledAmount
FROM fenc LEFT JOIN dimdept USING (DepartmentSK)
WHERE FacilityName IN ('ASIA', 'EUROPE') AND EncounterType = '1-URGENT' GROUP BY ALL""")
def p13(spark, sf):
    fact = b.fact_encounters(spark, sf, ["DepartmentSK"])
    chosen = {"FacilityName": ["ASIA", "EUROPE"], "EncounterType": ["1-URGENT"]}
    return marts.encounter_summary(fact, b.dim_department(spark, sf), chosen)


@query("p14_masked_patients", """
SELECT PatientID, regexp_replace(regexp_replace(regexp_replace(FirstName, '[a-z]', 'x', 'g'), '[A-Z]', 'X', 'g'), '[0-9]', 'n', 'g') AS FirstName,
  regexp_replace(LastName, '[0-9]', 'n', 'g') AS LastName,
  regexp_replace(regexp_replace(regexp_replace(AddressLine, '[a-z]', 'x', 'g'), '[A-Z]', 'X', 'g'), '[0-9]', 'n', 'g') AS AddressLine FROM pat""")
def p14(spark, sf):
    """A serving view masks personal columns unless told otherwise."""
    serve(b.patients(spark, sf), "vw_patients_masked")
    return spark.table("vw_patients_masked").select("PatientID", "FirstName", "LastName", "AddressLine")


@query("p14_hashed_patients", "SELECT PatientID, sha256(FirstName) AS FirstName, sha256(LastName) AS LastName FROM pat")
def p14_hash(spark, sf):
    hashed = mask_columns(b.patients(spark, sf), policy="hash")
    return hashed.select("PatientID", "FirstName", "LastName")


_SECRET = b"a secret of the site"
_INNER, _OUTER = (f"unhex('{p.hex()}')" for p in pads(_SECRET))


@query("p14_keyed_hash", f"""
SELECT PatientID, sha256({_OUTER} || unhex(sha256({_INNER} || encode(FirstName)))) AS FirstName,
  sha256({_OUTER} || unhex(sha256({_INNER} || encode(LastName)))) AS LastName FROM pat""")
def p14_keyed(spark, sf):
    """Names as keyed hashes: equal names stay equal, and a list of names does not give them away."""
    serve(b.patients(spark, sf), "vw_patients_keyed", "keyed", _SECRET)
    return spark.table("vw_patients_keyed").select("PatientID", "FirstName", "LastName")


@query("p15_standard_code", "SELECT PatientID, upper(trim(Gender)) AS Gender, upper(trim(Gender)) IN ('M', 'F') AS Known FROM pat")
def p15(spark, sf):
    rows = b.patients(spark, sf).withColumn("Gender", standard_code(F.col("Gender")))
    return rows.select("PatientID", "Gender", quality.in_values("Gender", ["M", "F"]).check.alias("Known"))


@query("j01_encounter_patient", "SELECT EncounterID, PatientSK FROM enc LEFT JOIN dimpatcur USING (PatientID)")
def j01(spark, sf):
    rows = joins.lookup(b.encounters(spark, sf), b.dim_patient_current(spark, sf), "PatientID", ["PatientSK"])
    return rows.select("EncounterID", "PatientSK")


@query("j02_encounter_provider", "SELECT EncounterID, ProviderSK FROM enc LEFT JOIN dimprov USING (ProviderID)")
def j02(spark, sf):
    rows = joins.lookup(b.encounters(spark, sf), b.dim_provider(spark, sf), "ProviderID", ["ProviderSK"])
    return rows.select("EncounterID", "ProviderSK")


@query("j03_encounter_department", "SELECT EncounterID, DepartmentSK FROM enc LEFT JOIN dimdept USING (DepartmentID)")
def j03(spark, sf):
    rows = joins.lookup(b.encounters(spark, sf), b.dim_department(spark, sf), "DepartmentID", ["DepartmentSK"])
    return rows.select("EncounterID", "DepartmentSK")


@query("j03_fact_patient_encounters", f"SELECT {_FENC_TEXT} FROM fenc")
def j03_fact(spark, sf):
    """The encounter fact with all three keys."""
    return plain(b.fact_encounters(spark, sf))


@query("j04_vitals_patient", f"SELECT {_FVIT_TEXT} FROM fvit")
def j04(spark, sf):
    return plain(b.fact_vitals(spark, sf))


@query("j05_fact_department", "SELECT EncounterID, DepartmentName, FacilityName FROM fenc LEFT JOIN dimdept USING (DepartmentSK)")
def j05(spark, sf):
    fact = b.fact_encounters(spark, sf, ["DepartmentSK"])
    return marts.with_department(fact, b.dim_department(spark, sf)).select("EncounterID", "DepartmentName", "FacilityName")


@query("j06_fact_patient", "SELECT EncounterID, PrimaryInsurancePayer, State FROM fenc LEFT JOIN dimpat USING (PatientSK)")
def j06(spark, sf):
    fact = b.fact_encounters(spark, sf, ["PatientSK"])
    return marts.with_patient(fact, b.dim_patient(spark, sf)).select("EncounterID", "PrimaryInsurancePayer", "State")


@query("j07_merge_match", """
SELECT PatientID, v.PatientID IS NOT NULL AS Matched
FROM pat2 LEFT JOIN (SELECT * FROM ver1 WHERE IsCurrent) v USING (PatientID)""")
def j07(spark, sf):
    current = scd2.as_current(b.first_versions(spark, sf)).select("PatientID", F.lit(True).alias("hit"))
    matched = b.patients_second_load(spark, sf).join(current, "PatientID", "left")
    return matched.select("PatientID", F.coalesce("hit", F.lit(False)).alias("Matched"))


@query("j08_encounter_telemetry", """
SELECT EncounterID, count(*) AS Readings, count(*) FILTER (WHERE v.IsCriticalAlert) AS CriticalAlerts,
  count(*) FILTER (WHERE v.PatientID IS DISTINCT FROM e.PatientID) AS OtherPatientReadings
FROM enc e JOIN vit v USING (EncounterID) GROUP BY 1""")
def j08(spark, sf):
    return marts.encounter_telemetry(b.encounters(spark, sf), b.vitals(spark, sf))


@query("j09_provider_department", "SELECT ProviderID, ProviderName, DepartmentName, FacilityName FROM prov LEFT JOIN dept USING (DepartmentID)")
def j09(spark, sf):
    rows = joins.lookup(b.providers(spark, sf), b.departments(spark, sf), "DepartmentID", ["DepartmentName", "FacilityName"])
    return rows.select("ProviderID", "ProviderName", "DepartmentName", "FacilityName")


_AS_OF = """
SELECT EncounterID, PatientSK FROM enc e LEFT JOIN ver v
  ON e.PatientID = v.PatientID AND AdmitTimestamp >= EffectiveStartDate AND AdmitTimestamp < EffectiveEndDate"""


@query("j10_as_of_patient_version", _AS_OF)
def j10(spark, sf):
    fact = star.fact_encounters_as_of(b.encounters(spark, sf), store(b.versions(spark, sf)))
    return fact.select("EncounterID", "PatientSK")


@query("j10_as_of_merged", _AS_OF)
def j10_merged(spark, sf):
    """The same where the versions are too many to broadcast: one ordered pass over both."""
    admissions = b.table(spark, sf, "orders").select(F.col("o_custkey").cast("string").alias("PatientID"))
    fact = star.fact_encounters_as_of(
        b.encounters(spark, sf), store(b.versions(spark, sf)), broadcast_bytes=0, sizes_from=admissions
    )
    return fact.select("EncounterID", "PatientSK")


@query("j10_as_of_changelog", f"""
, log AS (SELECT user_id, event_type, ts AS t0, lead(ts) OVER (PARTITION BY user_id ORDER BY ts) AS t1 FROM events)
SELECT o_orderkey, {ts('placed_at')}, log.event_type AS event_type
FROM (SELECT o_orderkey, o_custkey, TIMESTAMP '2024-01-01' + INTERVAL 1 HOUR * (o_orderkey % 720) AS placed_at FROM orders) o
LEFT JOIN log ON user_id = o_custkey AND placed_at >= t0 AND (t1 IS NULL OR placed_at < t1)""".lstrip())
def j10_log(spark, sf):
    """Orders placed in the time range of the change log, against its many versions per user."""
    facts = b.table(spark, sf, "orders").select(
        "o_orderkey", F.col("o_custkey").alias("user_id"),
        F.expr("timestamp'2024-01-01' + make_interval(0, 0, 0, 0, cast(o_orderkey % 720 as int))").alias("placed_at"),
    )
    log = store(scd2.history_from_changelog(b.changelog(spark, sf), ["user_id"], ["event_type"]))
    return plain(
        joins.as_of(facts, log, "user_id", "placed_at", scd2.START, scd2.END, ["event_type"]).drop("user_id")
    )


def _spans(spark, sf):
    """Spans of customers in days: long ones, and for every third a short one inside that is in the middle of it."""
    day = lambda n: F.expr(f"timestamp'1992-01-01' + make_interval(0, 0, 0, {n})")
    base = b.table(spark, sf, "customer").select(F.col("c_custkey").alias("k"))
    every = [("A", 0, 1000), ("B", 1000, 9000)]
    spans = [base.select("k", F.lit(n).alias("v"), day(lo).alias("t0"), day(hi).alias("t1")) for n, lo, hi in every]
    third = base.where("k % 3 = 0")
    return spans[0].unionByName(spans[1]), third, day


_ORDERS_AT = "(SELECT o_orderkey, o_custkey, o_orderdate FROM orders)"


def _both_ways(spark, sf, versions):
    """The answer of the broadcast, which has to be that of the merge too: rows of either are marked."""
    facts = b.table(spark, sf, "orders").select("o_orderkey", F.col("o_custkey").alias("k"), F.col("o_orderdate").alias("at"))
    args = (facts, store(versions), "k", "at", "t0", "t1", ["v"])
    ways = [joins.as_of(*args).withColumn("way", F.lit("broadcast")), joins.as_of(*args, broadcast_bytes=0).withColumn("way", F.lit("merged"))]
    return ways[0].unionByName(ways[1]).select("o_orderkey", "v", "way")


@query("j10_as_of_overlapping", f"""
, answers AS (SELECT o_orderkey, CASE
    WHEN o_custkey % 3 = 0 AND o_orderdate >= TIMESTAMP '1992-01-01' + INTERVAL 1500 DAY
      THEN CASE WHEN o_orderdate < TIMESTAMP '1992-01-01' + INTERVAL 2000 DAY THEN 'INNER' END
    WHEN o_orderdate < TIMESTAMP '1992-01-01' THEN NULL
    WHEN o_orderdate < TIMESTAMP '1992-01-01' + INTERVAL 1000 DAY THEN 'A'
    WHEN o_orderdate < TIMESTAMP '1992-01-01' + INTERVAL 9000 DAY THEN 'B' END AS v FROM {_ORDERS_AT})
SELECT o_orderkey, CASE WHEN EXISTS (SELECT 1 FROM customer WHERE c_custkey = o_custkey) THEN v END AS v, way
FROM answers JOIN {_ORDERS_AT} USING (o_orderkey), (VALUES ('broadcast'), ('merged')) w(way)""".lstrip())
def j10_overlapping(spark, sf):
    """A version that starts inside another ends it, by the broadcast and by the merge alike."""
    plain_spans, third, day = _spans(spark, sf)
    inner = third.select("k", F.lit("INNER").alias("v"), day(1500).alias("t0"), day(2000).alias("t1"))
    return _both_ways(spark, sf, plain_spans.unionByName(inner))


@query("j10_as_of_empty_version", f"""
SELECT o_orderkey, CASE WHEN NOT EXISTS (SELECT 1 FROM customer WHERE c_custkey = o_custkey) THEN NULL
    WHEN o_orderdate < TIMESTAMP '1992-01-01' THEN NULL WHEN o_orderdate < TIMESTAMP '1992-01-01' + INTERVAL 1000 DAY THEN 'A'
    WHEN o_orderdate < TIMESTAMP '1992-01-01' + INTERVAL 9000 DAY THEN 'B' END AS v, way
FROM orders, (VALUES ('broadcast'), ('merged')) w(way)""")
def j10_empty(spark, sf):
    """Versions that end where they start, or before it, hide nothing."""
    plain_spans, third, day = _spans(spark, sf)
    empty = [third.select("k", F.lit(n).alias("v"), day(lo).alias("t0"), day(hi).alias("t1")) for n, lo, hi in (("E", 1000, 1000), ("F", 1200, 1100))]
    return _both_ways(spark, sf, plain_spans.unionByName(empty[0]).unionByName(empty[1]))


@query("j11_orphan_claims", f"SELECT {_CLM_TEXT} FROM clm WHERE PatientID IS NOT NULL AND PatientID NOT IN (SELECT PatientID FROM pat)")
def j11(spark, sf):
    return plain(joins.orphans(b.claims(spark, sf), b.patients(spark, sf), "PatientID"))


@query("j11_orphan_counts", """
SELECT 'claims.PatientID' AS Reference, count(*) AS Orphans FROM clm WHERE PatientID NOT IN (SELECT PatientID FROM pat)
UNION ALL SELECT 'claims.EncounterID', count(*) FROM clm WHERE EncounterID NOT IN (SELECT EncounterID FROM enc)
UNION ALL SELECT 'labs.EncounterID', count(*) FROM lab WHERE EncounterID NOT IN (SELECT EncounterID FROM enc)
UNION ALL SELECT 'vitals.PatientID', count(*) FROM vit WHERE PatientID NOT IN (SELECT PatientID FROM pat)
UNION ALL SELECT 'encounters.ProviderID', count(*) FROM enc WHERE ProviderID NOT IN (SELECT ProviderID FROM prov)""")
def j11_counts(spark, sf):
    """Each child is read once and aggregated by key before it meets its parents; encounters are derived once."""
    encounters = store(b.encounters(spark, sf).select("EncounterID", "ProviderID"))

    def unknown(name, child, parent, key):
        return joins.orphan_counts(child, parent.select(key), key).select(F.lit(name).alias("Reference"), "Orphans")

    patients = b.patients(spark, sf)
    claims, labs, vitals = b.claims(spark, sf), b.labs(spark, sf), b.vitals(spark, sf)
    checks = [
        unknown("claims.PatientID", claims, patients, "PatientID"),
        unknown("claims.EncounterID", claims, encounters, "EncounterID"),
        unknown("labs.EncounterID", labs, encounters, "EncounterID"),
        unknown("vitals.PatientID", vitals, patients, "PatientID"),
        unknown("encounters.ProviderID", encounters, b.providers(spark, sf), "ProviderID"),
    ]
    result = checks[0]
    for more in checks[1:]:
        result = result.unionByName(more)
    return result


@query("w01_keep_latest", """
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, strftime(l_shipdate, '%Y-%m-%d') AS l_shipdate FROM lineitem
QUALIFY row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY l_shipdate DESC, l_partkey, l_suppkey) = 1""")
def w01(spark, sf):
    items = b.table(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", F.to_date("l_shipdate").alias("l_shipdate")
    )
    return plain(dedup.keep_latest(items, ["l_orderkey", "l_linenumber"], ["l_shipdate"]))


@query("w01_latest_claims", f"""
SELECT {_CLM_TEXT} FROM (SELECT * FROM clm
QUALIFY row_number() OVER (PARTITION BY ClaimID ORDER BY ClaimDate DESC, EncounterID, PatientID, ClaimAmount, InsurancePayer, ClaimStatus) = 1)""")
def w01_claims(spark, sf):
    return plain(dedup.keep_latest(b.claims(spark, sf), ["ClaimID"], ["ClaimDate"]))


@query("w02_previous_and_next", """
SELECT event_id, lag(event_type) OVER w AS previous_type, lead(event_type) OVER w AS next_type
FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)""")
def w02(spark, sf):
    events = b.table(spark, sf, "events").select("event_id", "user_id", "ts", "event_type")

    def both(order, rows):
        rows = order.previous(rows, ["event_type"], "before")
        return order.following(rows, ["event_type"], "after")

    rows = in_order(events, ["user_id"], ["ts", "event_id"], both)
    return rows.select(
        "event_id", F.col("before.event_type").alias("previous_type"), F.col("after.event_type").alias("next_type")
    )


@query("w03_share_of_total", """
SELECT l_suppkey, CAST(sum(CAST(l_quantity AS DECIMAL(12,2))) AS DOUBLE)
  / (SELECT CAST(sum(CAST(l_quantity AS DECIMAL(12,2))) AS DOUBLE) FROM lineitem) AS share FROM lineitem GROUP BY 1""")
def w03(spark, sf):
    quantity = F.sum(F.col("l_quantity").cast("decimal(12,2)")).alias("quantity")
    by_supplier = b.table(spark, sf, "lineitem").groupBy("l_suppkey").agg(quantity)
    return marts.with_share(by_supplier, "quantity", "share").drop("quantity")


@query("w03_zero_total", "SELECT l_suppkey, CAST(NULL AS DOUBLE) AS share FROM lineitem GROUP BY 1")
def w03_zero(spark, sf):
    """Shares of a total of zero are unknown."""
    nothing = b.table(spark, sf, "lineitem").groupBy("l_suppkey").agg(F.sum(F.col("l_quantity") * 0).alias("quantity"))
    return marts.with_share(nothing, "quantity", "share").drop("quantity")


@query("o01_order_by_aggregate", """
SELECT PatientID, CAST(sum(TotalBilledAmount) AS DOUBLE) AS Revenue FROM enc GROUP BY 1 ORDER BY 2 DESC, 1""")
def o01(spark, sf):
    revenue = marts.total("TotalBilledAmount").alias("Revenue")
    return b.encounters(spark, sf).groupBy("PatientID").agg(revenue).orderBy(F.desc("Revenue"), "PatientID")


@query("o02_top_patients", """
SELECT PatientID, CAST(sum(TotalBilledAmount) AS DOUBLE) AS Revenue FROM enc GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 10""")
def o02(spark, sf):
    """The ten patients with the highest revenue."""
    return o01(spark, sf).limit(10)


@query("u01_disjoint_split", """
SELECT CASE WHEN (LengthOfStayHours IS NULL OR LengthOfStayHours BETWEEN 0 AND 8760) AND TotalBilledAmount >= 0
  AND PatientID IS NOT NULL THEN 'valid' ELSE 'invalid' END AS side, EncounterID FROM enc""")
def u01(spark, sf):
    return quality.sides(b.encounters(spark, sf), quality.encounter_rules()).select("side", "EncounterID")


@query("u02_union_all", """
SELECT EncounterID, 'claim' AS origin FROM clm UNION ALL SELECT EncounterID, 'lab' FROM lab
UNION ALL SELECT EncounterID, 'vitals' FROM vit""")
def u02(spark, sf):
    parts = [("claim", b.claims), ("lab", b.labs), ("vitals", b.vitals)]
    rows = [make(spark, sf).select("EncounterID", F.lit(name).alias("origin")) for name, make in parts]
    return rows[0].unionByName(rows[1]).unionByName(rows[2])
