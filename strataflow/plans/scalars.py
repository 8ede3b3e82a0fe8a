"""F-*, G-*: scalar functions and derived columns."""

from __future__ import annotations

from pyspark.sql import functions as F, types as T

from ..functions import clinical
from ..functions.parsing import decode_json, parse, timestamp_text
from ..operators import control, marts, quality, silver
from . import bindings as b
from .registry import num, plain, query, ts


def _events(spark, sf):
    return b.table(spark, sf, "events")


@query("f01_timestamp_from_text", f"""
SELECT event_id, {ts("CASE WHEN event_id % 10 <> 0 THEN date_trunc('second', ts) END", 'parsed')} FROM events""")
def f01(spark, sf):
    """Every tenth text is not a time and becomes NULL."""
    text = F.when(F.col("event_id") % 10 == 0, "not a time").otherwise(F.date_format("ts", "yyyy-MM-dd HH:mm:ss"))
    return plain(_events(spark, sf).select("event_id", timestamp_text(text).alias("parsed")))


@query("f02_timestamp_from_iso", f"SELECT event_id, {ts('ts - INTERVAL 2 HOUR', 'parsed')} FROM events")
def f02(spark, sf):
    iso = F.concat(F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"), F.lit("+02:00"))
    return plain(_events(spark, sf).select("event_id", iso.try_cast("timestamp").alias("parsed")))


@query("f03_decimal_from_text", """
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey,
  CAST(CASE WHEN l_linenumber <> 7 THEN CAST(l_extendedprice AS DECIMAL(10,2)) END AS DOUBLE) AS amount
FROM lineitem""")
def f03(spark, sf):
    """A value too large for the type becomes NULL instead of an error."""
    text = F.when(F.col("l_linenumber") == 7, "123456789012.5").otherwise(F.col("l_extendedprice").cast("string"))
    rows = b.table(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", parse(text, T.DecimalType(10, 2)).alias("amount")
    )
    return plain(rows)


@query("f04_binary_to_text", "SELECT event_id, props AS payload FROM events")
def f04(spark, sf):
    return _events(spark, sf).select("event_id", F.encode("props", "UTF-8").cast("string").alias("payload"))


@query("f05_flag_and_number_casts", "SELECT TelemetryID, CAST(IsCriticalAlert AS INTEGER) AS alert, CAST(HeartRate AS DOUBLE) AS rate FROM vit")
def f05(spark, sf):
    return b.vitals(spark, sf).select(
        "TelemetryID", F.col("IsCriticalAlert").cast("int").alias("alert"), F.col("HeartRate").cast("double").alias("rate")
    )


@query("f06_from_json", """
SELECT event_id, CASE WHEN event_id % 5 <> 0 THEN CAST(regexp_extract(props, '([0-9]+)', 1) AS INTEGER) END AS k,
  CASE WHEN event_id % 5 = 0 THEN substr(props, 1, 4) END AS corrupt FROM events""")
def f06(spark, sf):
    """Every fifth document is cut short; its text is kept."""
    text = F.when(F.col("event_id") % 5 == 0, F.substring("props", 1, 4)).otherwise(F.col("props"))
    data = decode_json(text, T.StructType([T.StructField("k", T.IntegerType())]))
    rows = _events(spark, sf).select("event_id", data.alias("data"))
    return rows.select("event_id", "data.k", F.col("data._corrupt_record").alias("corrupt"))


@query("f07_md5", "SELECT o_orderkey, md5(o_orderstatus || o_orderpriority) AS hash FROM orders")
def f07(spark, sf):
    return b.table(spark, sf, "orders").select("o_orderkey", F.md5(F.concat("o_orderstatus", "o_orderpriority")).alias("hash"))


@query("f08_concat_ws", "SELECT EncounterID, concat_ws('||', PatientID, ProviderID, EncounterType) AS key FROM enc")
def f08(spark, sf):
    """NULL parts are skipped."""
    return b.encounters(spark, sf).select(
        "EncounterID", F.concat_ws("||", "PatientID", "ProviderID", "EncounterType").alias("key")
    )


@query("f09_current_timestamp", "SELECT count(*) AS n, count(*) AS present, TRUE AS after_events FROM events")
def f09(spark, sf):
    now = F.current_timestamp()
    return _events(spark, sf).withColumn("now", now).agg(
        F.count(F.lit(1)).alias("n"), F.count("now").alias("present"), F.bool_and(F.col("now") > F.col("ts")).alias("after_events")
    )


@query("f10_literals", "SELECT event_id, TRUE AS flag, 'BEDSIDE' AS source, 7 AS n FROM events")
def f10(spark, sf):
    return _events(spark, sf).select("event_id", F.lit(True).alias("flag"), F.lit("BEDSIDE").alias("source"), F.lit(7).alias("n"))


@query("f11_round", """
SELECT o_orderkey, CAST(round(CAST(o_totalprice AS DECIMAL(12,2)), 1) AS DOUBLE) AS one,
  CAST(round(CAST(o_totalprice AS DECIMAL(12,2)), 0) AS DOUBLE) AS whole FROM orders""")
def f11(spark, sf):
    amount = F.col("o_totalprice").cast("decimal(12,2)")
    return b.table(spark, sf, "orders").select(
        "o_orderkey", F.round(amount, 1).cast("double").alias("one"), F.round(amount, 0).cast("double").alias("whole")
    )


@query("f12_predicates", """
SELECT EncounterID, ProviderID IS NOT NULL AS has_provider, TotalBilledAmount >= 1000 AND TotalBilledAmount <= 200000 AS in_band,
  NOT (DischargeStatus = 'O') AS not_open, EncounterType <> '5-LOW' OR DischargeStatus = 'F' AS either FROM enc""")
def f12(spark, sf):
    c = F.col
    return b.encounters(spark, sf).select(
        "EncounterID", c("ProviderID").isNotNull().alias("has_provider"),
        ((c("TotalBilledAmount") >= 1000) & (c("TotalBilledAmount") <= 200000)).alias("in_band"),
        (~(c("DischargeStatus") == "O")).alias("not_open"),
        ((c("EncounterType") != "5-LOW") | (c("DischargeStatus") == "F")).alias("either"),
    )


@query("f13_aggregates", """
SELECT DischargeStatus, count(LengthOfStayHours) AS n, CAST(sum(TotalBilledAmount) AS DOUBLE) AS total,
  CAST(sum(LengthOfStayHours) AS DOUBLE) / count(LengthOfStayHours) AS mean,
  CAST(min(TotalBilledAmount) AS DOUBLE) AS lowest, CAST(max(TotalBilledAmount) AS DOUBLE) AS highest
FROM enc GROUP BY 1""")
def f13(spark, sf):
    return b.encounters(spark, sf).groupBy("DischargeStatus").agg(
        F.count("LengthOfStayHours").alias("n"), marts.total("TotalBilledAmount").alias("total"),
        marts.mean("LengthOfStayHours").alias("mean"),
        F.min("TotalBilledAmount").cast("double").alias("lowest"),
        F.max("TotalBilledAmount").cast("double").alias("highest"),
    )


@query("f14_uuid", "SELECT count(*) AS n, count(*) AS different, 36 AS length FROM events")
def f14(spark, sf):
    return _events(spark, sf).select(F.expr("uuid()").alias("id")).agg(
        F.count("id").alias("n"), F.countDistinct("id").alias("different"), F.max(F.length("id")).alias("length")
    )


@query("f15_substring", "SELECT o_orderkey, 'RUN_' || substr(md5(CAST(o_orderkey AS VARCHAR)), 1, 8) AS run FROM orders")
def f15(spark, sf):
    short = F.substring(F.md5(F.col("o_orderkey").cast("string")), 1, 8)
    return b.table(spark, sf, "orders").select("o_orderkey", F.concat(F.lit("RUN_"), short).alias("run"))


@query("f16_messages_as_values", "SELECT event_id, 'can''t read \"' || event_type || '\"' AS message FROM events")
def f16(spark, sf):
    """Quotes in a message travel as data and need no escaping."""
    return _events(spark, sf).select(
        "event_id", F.concat(F.lit("can't read \""), "event_type", F.lit('"')).alias("message")
    )


@query("f17_current_user", "SELECT count(*) AS n, 1 AS users FROM events")
def f17(spark, sf):
    return _events(spark, sf).select(F.current_user().alias("who")).agg(
        F.count("who").alias("n"), F.countDistinct("who").cast("int").alias("users")
    )


@query("f18_conditional_status", """
SELECT EncounterType, CASE WHEN count(*) FILTER (WHERE NOT LengthOfStayHours BETWEEN 0 AND 8760) = 0 THEN 'SUCCESS'
  ELSE 'QUARANTINED' END AS Status FROM enc GROUP BY 1""")
def f18(spark, sf):
    bad = F.count_if(quality.is_invalid())
    tagged = quality.tag(b.encounters(spark, sf), quality.encounter_rules())
    return tagged.groupBy("EncounterType").agg(
        F.when(bad == 0, control.SUCCESS).otherwise(control.QUARANTINED).alias("Status")
    )


@query("f19_age", "SELECT PatientID, date_sub('year', DateOfBirth, DATE '2025-01-01') AS Age FROM pat")
def f19(spark, sf):
    on = F.lit("2025-01-01").cast("date")
    return b.patients(spark, sf).select("PatientID", clinical.age_years(F.col("DateOfBirth"), on).alias("Age"))


@query("f20_when", "SELECT TelemetryID, CASE WHEN HeartRate > 120 THEN 'high' WHEN HeartRate < 55 THEN 'low' ELSE 'normal' END AS band FROM vit")
def f20(spark, sf):
    rate = F.col("HeartRate")
    band = F.when(rate > clinical.HEART_RATE_HIGH, "high").when(rate < clinical.HEART_RATE_LOW, "low").otherwise("normal")
    return b.vitals(spark, sf).select("TelemetryID", band.alias("band"))


@query("g01_critical_alert", "SELECT TelemetryID, IsCriticalAlert FROM vit")
def g01(spark, sf):
    return b.vitals(spark, sf).select("TelemetryID", "IsCriticalAlert")


@query("g01_alert_consistency", """
SELECT count(*) AS checked, count(*) FILTER (WHERE IsCriticalAlert <> (HeartRate > 120)) AS inconsistent FROM vit""")
def g01_rule(spark, sf):
    """A delivered flag that only looks at the heart rate, against the full rule."""
    delivered = b.vitals(spark, sf).withColumn("IsCriticalAlert", F.col("HeartRate") > clinical.HEART_RATE_HIGH)
    rule = quality.Rule(
        "ALERT_FLAG_MATCHES_READINGS", quality.BUSINESS_RULE, F.col("IsCriticalAlert") == clinical.critical_alert()
    )
    return quality.rule_counts(delivered, [rule]).select(
        F.col("TotalRecordsChecked").alias("checked"), F.col("FailedRecordCount").alias("inconsistent")
    )


@query("g02_lab_abnormal", """
SELECT LabResultID, TestCode, TestValue, CASE WHEN low IS NOT NULL THEN TestValue < low OR TestValue > high END AS Abnormal
FROM lab LEFT JOIN labtest ON code = TestCode""")
def g02(spark, sf):
    rows = silver.flag_abnormal(b.labs(spark, sf), clinical.lab_reference(spark))
    return rows.select("LabResultID", "TestCode", "TestValue", F.col("IsAbnormalDerived").alias("Abnormal"))


@query("g03_stay_hours", f"SELECT EncounterID, {num('LengthOfStayHours')} FROM enc")
def g03(spark, sf):
    rows = b.encounters(spark, sf).withColumn("LengthOfStayHours", clinical.stay_hours())
    return plain(rows.select("EncounterID", "LengthOfStayHours"))


@query("g04_open_stay", """
SELECT EncounterID, CASE WHEN DischargeStatus = 'O' THEN DischargeTimestamp IS NULL AND LengthOfStayHours IS NULL
  ELSE DischargeTimestamp IS NOT NULL AND LengthOfStayHours IS NOT NULL END AS Consistent FROM enc""")
def g04(spark, sf):
    return b.encounters(spark, sf).select(
        "EncounterID", clinical.open_stay_consistent(open_value="O").alias("Consistent")
    )


@query("g05_claim_plausibility", """
SELECT EncounterID, ClaimID, PatientID, date_diff('day', CAST(AdmitTimestamp AS DATE), ClaimDate) BETWEEN 1 AND 15 AS InWindow,
  ClaimAmount BETWEEN TotalBilledAmount * 0.8 AND TotalBilledAmount * 1.2 AS InRatio
FROM (SELECT * FROM clm) LEFT JOIN (SELECT EncounterID, AdmitTimestamp, TotalBilledAmount FROM enc) USING (EncounterID)""")
def g05(spark, sf):
    billed = b.encounters(spark, sf).select("EncounterID", "AdmitTimestamp", "TotalBilledAmount")
    rows = b.claims(spark, sf).join(billed, "EncounterID", "left")
    return rows.select(
        "EncounterID", "ClaimID", "PatientID", clinical.claim_in_window().alias("InWindow"),
        clinical.claim_in_ratio().alias("InRatio"),
    )
