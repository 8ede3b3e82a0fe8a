"""ST-*: streams, run over all available events and returned as batch results."""

from __future__ import annotations

from pyspark.sql import functions as F

from .. import contracts, loads
from ..session import pin_utc, scratch_path
from ..sources import compaction, tables
from ..streaming import offsets as continuity, vitals as stream
from . import bindings as b
from .registry import plain, query, ts
from .relational import _FVIT_TEXT
from .transport import envelope_rows, events_stream

_USABLE = "FROM vit WHERE DeviceID <> 'error'"


def _bronze(spark, sf, runs: int = 1, trigger=None):
    """Run the Bronze stream to the end; returns the table path, checkpoint and last query."""
    out, offsets = scratch_path(spark, "bronze"), scratch_path(spark, "offsets")
    for _ in range(runs):
        rows = envelope_rows(events_stream(pin_utc(spark), sf))
        running = stream.write_bronze(rows, out, offsets, trigger)
        if trigger:
            running.processAllAvailable()
            running.stop()
        else:
            running.awaitTermination()
    return out, offsets, running


def _read(spark, path):
    return spark.read.parquet(path)


@query("st01_payload_decode", f"""
SELECT TelemetryID, PatientID, EncounterID, DeviceID, HeartRate, BloodPressureSystolic, BloodPressureDiastolic,
  OxygenSaturation, CAST(BodyTemperature AS DOUBLE) AS BodyTemperature, IsCriticalAlert {_USABLE}""")
def st01(spark, sf):
    out, _, _ = _bronze(spark, sf)
    return _read(spark, out).where("status = 'ok'").select(
        "TelemetryID", "PatientID", "EncounterID", "DeviceID", "HeartRate", "BloodPressureSystolic",
        "BloodPressureDiastolic", "OxygenSaturation", "BodyTemperature", "IsCriticalAlert",
    )


@query("st02_event_time", f"SELECT TelemetryID, {ts('EventTimestamp')}, strftime(EventTimestamp, '%Y-%m-%d') AS event_date {_USABLE}")
def st02(spark, sf):
    out, _, _ = _bronze(spark, sf)
    return plain(_read(spark, out).where("status = 'ok'").select("TelemetryID", "EventTimestamp", "event_date"))


@query("st03_lineage", f"""
SELECT CAST(TelemetryID AS BIGINT) AS _kafka_offset, CAST(CAST(TelemetryID AS BIGINT) % 4 AS INTEGER) AS _kafka_partition,
  {ts('EventTimestamp', 'kafka_enqueued_time')}, 'BEDSIDE_ICU_EVENT_HUBS' AS _source_system, TRUE AS timed FROM vit""")
def st03(spark, sf):
    out, _, _ = _bronze(spark, sf)
    return plain(
        _read(spark, out).select(
            "_kafka_offset", "_kafka_partition", "kafka_enqueued_time", "_source_system",
            F.col("_ingested_at").isNotNull().alias("timed"),
        )
    )


@query("st04_restart_from_checkpoint", "SELECT CAST(TelemetryID AS BIGINT) AS _kafka_offset FROM vit")
def st04(spark, sf):
    """A second run from the same checkpoint adds nothing."""
    out, _, _ = _bronze(spark, sf, runs=2)
    return _read(spark, out).select("_kafka_offset")


@query("st05_processing_time_trigger", "SELECT CAST(TelemetryID AS BIGINT) AS _kafka_offset FROM vit")
def st05(spark, sf):
    out, _, _ = _bronze(spark, sf, trigger="1 second")
    return _read(spark, out).select("_kafka_offset")


@query("st06_stream_enrichment", f"SELECT {_FVIT_TEXT} FROM fvit")
def st06(spark, sf):
    """Stream joined with the static patient dimension."""
    out = scratch_path(spark, "gold")
    rows = stream.gold(b.vitals_of(events_stream(pin_utc(spark), sf)), b.dim_patient(spark, sf))
    stream.write_append(rows, out, scratch_path(spark, "offsets"), trigger=None).awaitTermination()
    return plain(spark.read.schema(rows.schema).parquet(out))


@query("st07_dedup_with_watermark", f"SELECT TelemetryID, DeviceID, {ts('EventTimestamp')} FROM vit")
def st07(spark, sf):
    """Every reading delivered twice, kept once."""
    out = scratch_path(spark, "silver")
    twice = b.vitals_of(events_stream(pin_utc(spark), sf)).withColumn("_copy", F.explode(F.array(F.lit(0), F.lit(1))))
    rows = stream.silver(twice.drop("_copy")).select("TelemetryID", "DeviceID", "EventTimestamp")
    stream.write_append(rows, out, scratch_path(spark, "offsets"), trigger=None).awaitTermination()
    return plain(spark.read.schema(rows.schema).parquet(out))


@query("st07_dedup_for_all_time", f"SELECT TelemetryID, DeviceID, {ts('EventTimestamp')} FROM vit")
def st07_exact(spark, sf):
    """Every reading delivered twice and the drop repeated for a restarted stream, kept once."""
    out, offsets, landed = scratch_path(spark, "silver"), scratch_path(spark, "offsets"), scratch_path(spark, "in")
    for _ in range(2):
        b.table(spark, sf, "events").write.mode("append").parquet(landed)
        rows = b.vitals_of(pin_utc(spark).readStream.schema(b.TABLES["events"]).parquet(landed))
        twice = rows.withColumn("_copy", F.explode(F.array(F.lit(0), F.lit(1)))).drop("_copy")
        _silver(spark, twice, out, offsets)
    return plain(_silver_rows(spark, out).select("TelemetryID", "DeviceID", "EventTimestamp"))


def _silver(spark, rows, out, offsets):
    stream.write_silver(rows, out, offsets, trigger=None).awaitTermination()


def _silver_rows(spark, out, side="valid"):
    return stream.read_silver(spark, out, contracts.VITALS, side)


@query("st07_validated_stream", """
SELECT TelemetryID, CASE WHEN CAST(TelemetryID AS BIGINT) % 5 = 0 THEN 'VALID_HEART_RATE_RANGE' WHEN CAST(TelemetryID AS BIGINT) % 7 = 0
  THEN 'NOT_NULL_EVENT_TIMESTAMP' ELSE '' END AS failed FROM vit""")
def st07_validated(spark, sf):
    """Impossible readings and readings without a time go to quarantine with their reason; compaction keeps both sides."""
    out, offsets, key = scratch_path(spark, "silver"), scratch_path(spark, "offsets"), F.col("TelemetryID").cast("long")
    rows = b.vitals_of(events_stream(pin_utc(spark), sf)).withColumns({
        "HeartRate": F.when(key % 5 == 0, 999).otherwise(F.col("HeartRate")),
        "EventTimestamp": F.when((key % 7 == 0) & (key % 5 != 0), F.lit(None)).otherwise(F.col("EventTimestamp")),
    })
    _silver(spark, rows, out, offsets)
    stream.compact_silver(spark, out, contracts.VITALS, "r1")
    bad = _silver_rows(spark, out, "quarantine").select("TelemetryID", F.col("_failed_rules").alias("failed"))
    return _silver_rows(spark, out).select("TelemetryID", F.lit("").alias("failed")).unionByName(bad)


@query("st07_redelivered_other_date", f"SELECT TelemetryID, {ts('EventTimestamp')} FROM vit")
def st07_other_date(spark, sf):
    """Every reading comes again with an event time of another day, by the same stream restarted: the first stays."""
    landed, out, offsets = scratch_path(spark, "in"), scratch_path(spark, "silver"), scratch_path(spark, "offsets")
    events = b.table(spark, sf, "events")
    for days in (0, 3):
        events.withColumn("ts", F.col("ts") + F.make_dt_interval(F.lit(days))).write.mode("append").parquet(landed)
        source = pin_utc(spark).readStream.schema(b.TABLES["events"]).parquet(landed)
        _silver(spark, b.vitals_of(source), out, offsets)
        stream.compact_silver(spark, out, contracts.VITALS, f"r{days}")
    return plain(_silver_rows(spark, out).select("TelemetryID", "EventTimestamp"))


@query("st06_patient_added_later", f"""
SELECT TelemetryID, CASE WHEN CAST(TelemetryID AS BIGINT) % 2 = 1 THEN (SELECT PatientSK FROM dimpat p WHERE p.PatientID = v.PatientID) END AS PatientSK FROM vit v""")
def st06_later(spark, sf):
    """Patients are published between two batches: the second batch finds them."""
    landed, out, offsets, dims = (scratch_path(spark, n) for n in ("in", "gold", "offsets", "dim"))
    events, dim = b.table(pin_utc(spark), sf, "events"), b.dim_patient(spark, sf)
    for parity, rows in ((0, dim.limit(0)), (1, dim)):
        tables.publish(rows, dims, f"r{parity}")
        events.where(F.col("event_id") % 2 == parity).write.mode("append").parquet(landed)
        source = b.vitals_of(spark.readStream.schema(b.TABLES["events"]).parquet(landed))
        stream.write_gold(source, lambda: tables.read_current(spark, dims), out, offsets, None).awaitTermination()
    return spark.read.parquet(out).select("TelemetryID", "PatientSK")


@query("st06_resolved_later", "SELECT TelemetryID, PatientSK, 1::BIGINT AS copies FROM fvit")
def st06_resolved(spark, sf):
    """Half of the readings come before any patient is known. The batch after the patients were published gives them their
    key; each reading is there once, and those of unknown patients go on waiting."""
    landed, out, offsets, dims = (scratch_path(spark, n) for n in ("in", "gold", "offsets", "dim"))
    events, dim = b.table(pin_utc(spark), sf, "events"), b.dim_patient(spark, sf)
    for parity, rows in ((0, dim.limit(0)), (1, dim)):
        tables.publish(rows, dims, f"r{parity}")
        events.where(F.col("event_id") % 2 == parity).write.mode("append").parquet(landed)
        source = b.vitals_of(spark.readStream.schema(b.TABLES["events"]).parquet(landed))
        stream.write_gold(
            source, lambda: tables.read_current(spark, dims), out, offsets, None, lambda: tables.current_version(spark, dims),
        ).awaitTermination()
    copies = F.count(F.lit(1)).alias("copies")
    return stream.read_gold(spark, out).groupBy("TelemetryID", "PatientSK").agg(copies)


@query("l01_compacts_small_files_only", f"SELECT TelemetryID, {ts('EventTimestamp')}, TRUE AS large_kept FROM vit")
def l01_small(spark, sf):
    """Readings in one large and two small drops, compacted: the largest file keeps its name, replaced ones are deleted."""
    landed, out, offsets = scratch_path(spark, "in"), scratch_path(spark, "silver"), scratch_path(spark, "offsets")
    events, key = b.table(spark, sf, "events"), F.col("event_id") % 10
    for rows in (events.where(key > 1), events.where(key == 0), events.where(key == 1)):
        rows.write.mode("append").parquet(landed)
        _silver(spark, b.vitals_of(pin_utc(spark).readStream.schema(b.TABLES["events"]).parquet(landed)), out, offsets)
    files = compaction.live_files(spark, out, "batches")
    large = files.orderBy(F.desc("length"), "uri").first()
    done = stream.compact_silver(spark, out, contracts.VITALS, "r1", 2 * large["length"])
    compaction.remove_replaced(spark, out)
    kept = done["files"] > 0 and compaction.live_files(spark, out, "batches").where(F.col("uri") == large["uri"]).count() == 1
    return plain(_silver_rows(spark, out).select("TelemetryID", "EventTimestamp")).withColumn("large_kept", F.lit(kept))


@query("st08_malformed_routing", """
SELECT CAST(TelemetryID AS BIGINT) AS _kafka_offset, CASE WHEN DeviceID = 'error' THEN 'malformed' ELSE 'ok' END AS status,
  CASE WHEN DeviceID = 'error' THEN 40 END AS kept_length FROM vit""")
def st08(spark, sf):
    out, _, _ = _bronze(spark, sf)
    return _read(spark, out).select("_kafka_offset", "status", F.length("_malformed").alias("kept_length"))


@query("st09_source_options", "SELECT event_type, count(*) AS n FROM events GROUP BY 1")
def st09(spark, sf):
    """Earliest start, bounded batches, and tolerance of files that have gone, on the file source."""
    out = scratch_path(spark, "bronze")
    events = (
        spark.readStream.schema(b.TABLES["events"]).option("pathGlobFilter", "events.parquet")
        .option("maxFilesPerTrigger", 1).option("ignoreMissingFiles", True).parquet(sf)
    )
    stream.write_append(events, out, scratch_path(spark, "offsets"), trigger=None).awaitTermination()
    return spark.read.parquet(out).groupBy("event_type").agg(F.count(F.lit(1)).alias("n"))


@query("st10_progress", "SELECT 'PatientVitals' AS SourceEntity, 'SUCCESS' AS Status, count(*) AS RecordsIngested FROM events")
def st10(spark, sf):
    """The finished stream as a row of the run log."""
    log = scratch_path(spark, "run_log")
    _, _, running = _bronze(spark, sf)
    loads.log_stream(spark, running, log)
    return spark.read.parquet(log).select("SourceEntity", "Status", "RecordsIngested")


_OFFSETS = """
, placed AS (SELECT CASE WHEN event_id % 10 < 7 THEN 0 ELSE event_id % 10 END AS p,
    CASE WHEN event_id % 10 < 7 THEN event_id // 10 * 7 + event_id % 10 ELSE event_id // 10 END AS o, event_id FROM events),
kept AS (SELECT p, o, CASE WHEN event_id % 50 = 3 THEN 2 ELSE 1 END AS n FROM placed WHERE event_id % 97 NOT IN (5, 6, 7))"""


def _offset_islands(spark, sf):
    """Offsets of two loads, each reduced to its islands: one partition has most rows, some offsets are lost, some repeat."""
    key = F.col("event_id")
    hot = key % 10 < 7
    rows = b.table(spark, sf, "events").where(~(key % 97).isin(5, 6, 7)).select(
        F.when(hot, F.lit(0).cast("long")).otherwise(key % 10).alias("_kafka_partition"),
        F.when(hot, F.expr("event_id div 10 * 7 + event_id % 10")).otherwise(F.expr("event_id div 10")).alias("_kafka_offset"),
        F.when(key % 50 == 3, 2).otherwise(1).alias("n"),
    )
    rows = rows.withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("n"))))
    # The loads divide the rows without regard to their order, so each has gaps that the other fills.
    loads_ = [rows.where((F.xxhash64("_kafka_offset", "copy") % 2 == 0) == even) for even in (True, False)]
    logs = [tables.store(continuity.islands(part, slice_size=100)) for part in loads_]
    return continuity.merged(logs[0].unionByName(logs[1]))


@query("st09_lost_offsets", _OFFSETS.lstrip() + """
SELECT p AS partition, o + 1 AS first_missing, next - 1 AS last_missing, next - o - 1 AS missing
FROM (SELECT p, o, lead(o) OVER (PARTITION BY p ORDER BY o) AS next FROM kept) WHERE next > o + 1""")
def st09_lost(spark, sf):
    return continuity.gaps(_offset_islands(spark, sf))


@query("st03_offset_summary", _OFFSETS.lstrip() + """
SELECT p AS partition, min(o) AS first, max(o) AS last, count(*) AS seen, max(o) - min(o) + 1 - count(*) AS missing,
  CAST(sum(n) - count(*) AS BIGINT) AS repeated FROM kept GROUP BY 1""")
def st03_summary(spark, sf):
    return continuity.summary(_offset_islands(spark, sf))
