"""M-*: versioned history."""

from __future__ import annotations

from pyspark.sql import functions as F

from .. import loads
from ..functions.keys import business_key, version_key
from ..operators import scd2
from ..session import scratch_path
from ..sources import tables
from ..sources.tables import store
from . import bindings as b
from .registry import plain, query, ts

_COLS = ["PatientSK", "PatientID", "PrimaryInsurancePayer", scd2.CURRENT, scd2.START, scd2.END]
_VER = f"PatientSK, PatientID, PrimaryInsurancePayer, IsCurrent, {ts(scd2.START)}, {ts(scd2.END)}"


def _show(df):
    return plain(df.select(*_COLS))


@query("m01_initial_load", f"SELECT {_VER} FROM ver1")
def m01(spark, sf):
    return _show(b.first_versions(spark, sf))


@query("m02_closed_versions", f"SELECT {_VER} FROM ver WHERE NOT IsCurrent")
def m02(spark, sf):
    return _show(b.versions(spark, sf).where(~F.col(scd2.CURRENT)))


@query("m03_inserted_keys", f"SELECT {_VER} FROM ver WHERE PatientID NOT IN (SELECT PatientID FROM ver1)")
def m03(spark, sf):
    known = b.patients(spark, sf).select("PatientID")
    return _show(b.versions(spark, sf).join(known, "PatientID", "left_anti"))


@query("m04_opened_versions", f"SELECT {_VER} FROM ver WHERE IsCurrent AND EffectiveStartDate > TIMESTAMP '{b.FIRST_LOAD}'")
def m04(spark, sf):
    opened = b.versions(spark, sf).where(
        F.col(scd2.CURRENT) & (F.col(scd2.START) > F.lit(b.FIRST_LOAD).cast("timestamp"))
    )
    return _show(opened)


@query("m04_apply_scd2", f"SELECT {_VER} FROM ver")
def m04_all(spark, sf):
    return _show(b.versions(spark, sf))


@query("m04_apply_scd2_rerun", f"SELECT {_VER} FROM ver")
def m04_rerun(spark, sf):
    """The second snapshot applied twice changes nothing."""
    return _show(scd2.apply_scd2(store(b.versions(spark, sf)), b.patients_second_load(spark, sf)))


@query("m04_close_only_merge", f"""
SELECT {_VER} FROM (
  SELECT * REPLACE (CAST(PatientID AS BIGINT) % 7 <> 0 OR CAST(PatientID AS BIGINT) % 14 = 0 AS IsCurrent,
    CASE WHEN CAST(PatientID AS BIGINT) % 7 = 0 AND CAST(PatientID AS BIGINT) % 14 <> 0
      THEN TIMESTAMP '{b.SECOND_LOAD}' ELSE EffectiveEndDate END AS EffectiveEndDate) FROM ver1
  UNION ALL SELECT * FROM ver WHERE PatientID LIKE 'NEW_%')""")
def m04_close_only(spark, sf):
    """The plain merge: no successor for changed keys, NULL never a change."""
    return _show(scd2.merge_close_only(b.first_versions(spark, sf), b.patients_second_load(spark, sf)))


@query("m05_version_key", "SELECT event_id, md5(user_id || '||' || ts) AS sk FROM events")
def m05(spark, sf):
    events = b.table(spark, sf, "events").withColumn("id", F.col("user_id").cast("string"))
    return events.select("event_id", version_key("id", "ts").alias("sk"))


@query("m05_key_in_dst_gap", """
SELECT event_id, md5(user_id || '||' || strftime(TIMESTAMP '2024-03-10 00:00:00' + INTERVAL 1 MINUTE * (event_id % 600), '%Y-%m-%d %H:%M:%S')) AS sk FROM events""")
def m05_gap(spark, sf):
    """Times around the start of summer time, keyed in a session of New York: no two hours fall together."""
    events = b.table(spark, sf, "events").select(
        "event_id", F.col("user_id").cast("string").alias("id"),
        F.timestamp_seconds(F.lit(1710028800) + F.col("event_id") % 600 * 60).alias("t"),
    )
    zone = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        return store(events.select("event_id", version_key("id", "t").alias("sk")))
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)


@query("m06_business_key", "SELECT EncounterID, md5(ProviderID) AS ProviderSK FROM enc")
def m06(spark, sf):
    return b.encounters(spark, sf).select("EncounterID", business_key("ProviderID").alias("ProviderSK"))


@query("m07_version_stats", "SELECT count(*) AS total_versions, count(*) FILTER (WHERE IsCurrent) AS current_versions FROM ver")
def m07(spark, sf):
    return scd2.version_stats(b.versions(spark, sf))


_LOG = """
, seen AS (SELECT user_id, event_type, ts, lag(event_type) OVER (PARTITION BY user_id ORDER BY ts) AS before FROM {t}),
kept AS (SELECT * FROM seen WHERE before IS DISTINCT FROM event_type)
SELECT user_id, event_type, strftime(ts, '%Y-%m-%d %H:%M:%S.%f') AS EffectiveStartDate,
  strftime(coalesce(lead(ts) OVER (PARTITION BY user_id ORDER BY ts), TIMESTAMP '9999-12-31 23:59:59'),
    '%Y-%m-%d %H:%M:%S.%f') AS EffectiveEndDate,
  lead(ts) OVER (PARTITION BY user_id ORDER BY ts) IS NULL AS IsCurrent
FROM kept"""


@query("m08_history_from_changelog", _LOG.format(t="events").lstrip())
def m08(spark, sf):
    return plain(scd2.history_from_changelog(b.changelog(spark, sf), ["user_id"], ["event_type"]))


@query("m08_history_of_large_groups", """
, log AS (SELECT event_type, value > 20 AS high, ts, event_id FROM events),
seen AS (SELECT *, lag(high) OVER (PARTITION BY event_type ORDER BY ts, event_id) AS before FROM log),
kept AS (SELECT * FROM seen WHERE before IS DISTINCT FROM high)
SELECT event_type, high, strftime(ts, '%Y-%m-%d %H:%M:%S.%f') AS EffectiveStartDate,
  strftime(coalesce(lead(ts) OVER w, TIMESTAMP '9999-12-31 23:59:59'), '%Y-%m-%d %H:%M:%S.%f') AS EffectiveEndDate,
  lead(ts) OVER w IS NULL AS IsCurrent
FROM kept WINDOW w AS (PARTITION BY event_type ORDER BY ts, event_id)""".lstrip())
def m08_large(spark, sf):
    """A few devices hold all rows. The bound is set low, so each is cut into time slices."""
    log = b.table(spark, sf, "events").select(
        "event_type", (F.col("value") > 20).alias("high"), F.col("ts").alias(scd2.START)
    )
    return plain(scd2.history_from_changelog(log, ["event_type"], ["high"], max_rows=1000))


@query("m04_apply_small_batch", f"SELECT {_VER} FROM ver")
def m04_small(spark, sf):
    """The second load applied with untouched keys passed through."""
    rows = scd2.apply_scd2(
        b.stored_first_versions(spark, sf), b.patients_second_load(spark, sf), small_batch=True
    )
    return _show(rows)


@query("m04_touched_parts", f"""
SELECT {_VER}, 1::BIGINT AS rewritten FROM ver WHERE PatientID = '7' UNION ALL SELECT {_VER}, 1 FROM ver1 WHERE PatientID <> '7'""")
def m04_touched(spark, sf):
    """A batch of one patient: one part of the version table is written, the new version refers to the other parts."""
    root = scratch_path(spark, "dim_patient_scd2")
    loads.load_versions(b.patients(spark, sf), root, "r1")
    before = tables.part_folders(spark, root)
    loads.load_versions(b.patients_second_load(spark, sf).where("PatientID = '7'"), root, "r2")
    after = tables.part_folders(spark, root)
    rewritten = sum(folder != before.get(part) for part, folder in after.items())
    return _show(tables.read_current(spark, root)).withColumn("rewritten", F.lit(rewritten).cast("long"))


@query("m09_violations", """
SELECT PatientID, 'several current' AS problem, count(*) AS rows FROM (SELECT PatientID FROM ver1 UNION ALL SELECT PatientID FROM ver WHERE IsCurrent) GROUP BY 1 HAVING count(*) > 1
UNION ALL SELECT PatientID, 'overlap', 1 FROM ver1 JOIN (SELECT PatientID FROM ver GROUP BY 1) USING (PatientID)""")
def m09(spark, sf):
    """Two version tables laid over one another break the rules in known ways."""
    broken = b.first_versions(spark, sf).unionByName(scd2.as_current(b.versions(spark, sf)))
    return scd2.violations(store(broken), "PatientID")


@query("m09_no_violations", "SELECT PatientID, '' AS problem, 0::BIGINT AS rows FROM ver WHERE FALSE")
def m09_none(spark, sf):
    return scd2.violations(store(b.versions(spark, sf)), "PatientID")


@query("m09_violations_of_large_groups", """
, log AS (SELECT event_type, value > 20 AS high, ts, event_id FROM events),
seen AS (SELECT *, lag(high) OVER (PARTITION BY event_type ORDER BY ts, event_id) AS before FROM log),
kept AS (SELECT * FROM seen WHERE before IS DISTINCT FROM high)
SELECT event_type, 'overlap' AS problem, count(*) - 1 AS rows FROM kept GROUP BY 1 HAVING count(*) > 1""".lstrip())
def m09_large(spark, sf):
    """A few devices hold all versions, each of which ends a day too late; the bound is set low, so groups are cut."""
    log = b.table(spark, sf, "events").select(
        "event_type", (F.col("value") > 20).alias("high"), F.col("ts").alias(scd2.START)
    )
    versions = scd2.history_from_changelog(log, ["event_type"], ["high"], max_rows=1000)
    late = F.when(F.col(scd2.CURRENT), F.col(scd2.END)).otherwise(F.col(scd2.END) + F.expr("INTERVAL 1 DAY"))
    return scd2.violations(store(versions.withColumn(scd2.END, late)), "event_type", max_rows=500)


@query("m10_late_change", f"""
, allrows AS (SELECT PatientID, PrimaryInsurancePayer, EffectiveStartDate AS t FROM ver
  UNION ALL SELECT PatientID, 'LATE', TIMESTAMP '1996-06-01' FROM pat WHERE PrimaryLanguage = 'Spanish')
SELECT md5(PatientID || '||' || t) AS PatientSK, PatientID, PrimaryInsurancePayer, lead(t) OVER w IS NULL AS IsCurrent,
  {ts('t', scd2.START)}, {ts("coalesce(lead(t) OVER w, TIMESTAMP '9999-12-31 23:59:59')", scd2.END)}
FROM allrows WINDOW w AS (PARTITION BY PatientID ORDER BY t)""".lstrip())
def m10(spark, sf):
    """A change that arrives after a later one is put in its place in time."""
    late = b.patients(spark, sf).where(F.col("PrimaryLanguage") == "Spanish").withColumns(
        {
            "PrimaryInsurancePayer": F.lit("LATE"),
            "UpdatedTimestamp": F.lit("1996-06-01").cast("timestamp"),
        }
    )
    return _show(scd2.apply_scd2(store(b.versions(spark, sf)), late))
