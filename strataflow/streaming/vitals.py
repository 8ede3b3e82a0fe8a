"""Bedside telemetry: broker envelope, decoding, Bronze, Silver and Gold streams."""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, SparkSession, functions as F, types as T
from pyspark.sql.streaming import StreamingQuery

from ..contracts import VITALS_PAYLOAD, gold_schema
from ..functions.parsing import decode_json
from ..operators.dedup import keep_latest_with_nulls
from ..operators.quality import FAILED, UNDECIDED, Rule, is_valid, tag, vitals_rules
from ..operators.star import fact_vitals
from ..sources import compaction
from ..sources.tables import last_run, publish_together, published_folders, read_current, read_if_present, table_exists

# Name of the source in the audit columns, and the trigger interval.
SOURCE_SYSTEM = "BEDSIDE_ICU_EVENT_HUBS"
TRIGGER = "10 seconds"

ENVELOPE = T.StructType(
    [
        T.StructField("value", T.BinaryType()),
        T.StructField("timestamp", T.TimestampType()),
        T.StructField("partition", T.IntegerType()),
        T.StructField("offset", T.LongType()),
    ]
)


def kafka_options(
    servers: str, topic: str, connection_string: str | None = None, starting: str = "earliest",
    fail_on_data_loss: bool = False, login_module: str = "org.apache.kafka.common.security.plain.PlainLoginModule",
) -> dict[str, str]:
    """Options of the Kafka source. A connection string switches on SASL over TLS."""
    options = {
        "kafka.bootstrap.servers": servers,
        "subscribe": topic,
        "startingOffsets": starting,
        "failOnDataLoss": str(fail_on_data_loss).lower(),
    }
    if connection_string is not None:
        secret = connection_string.replace("\\", "\\\\").replace('"', '\\"')
        options |= {
            "kafka.security.protocol": "SASL_SSL",
            "kafka.sasl.mechanism": "PLAIN",
            "kafka.sasl.jaas.config": (
                f'{login_module} required username="$ConnectionString" password="{secret}";'
            ),
        }
    return options


def read_events(spark: SparkSession, source: str = "kafka", path: str | None = None, **options: str) -> DataFrame:
    """The event stream with the broker's columns: from Kafka, or from files of the same shape."""
    if source == "kafka":
        return spark.readStream.format("kafka").options(**options).load()
    return spark.readStream.schema(ENVELOPE).format(source).options(**options).load(path)


def envelope(stream: DataFrame) -> DataFrame:
    """Payload text and broker lineage."""
    return stream.select(
        F.col("value").cast("string").alias("json_payload"),
        F.col("timestamp").alias("kafka_enqueued_time"),
        F.col("partition").alias("_kafka_partition"),
        F.col("offset").alias("_kafka_offset"),
    )


def decode(enveloped: DataFrame, payload: T.StructType = VITALS_PAYLOAD) -> DataFrame:
    """Payload fields as columns, event time parsed from ISO-8601 text with offset.

    ``_malformed`` is the payload text of a row that cannot be used: it does not fit the contract, has
    no TelemetryID or no readable event time.
    """
    data = enveloped.withColumn("data", decode_json(F.col("json_payload"), payload))
    flat = data.select("json_payload", "data.*", "_kafka_partition", "_kafka_offset", "kafka_enqueued_time")
    timed = flat.withColumn("EventTimestamp", F.col("EventTimestamp").try_cast("timestamp"))
    unusable = (
        F.col("_corrupt_record").isNotNull() | F.col("TelemetryID").isNull() | F.col("EventTimestamp").isNull()
    )
    return timed.withColumn(
        "_malformed", F.when(unusable, F.coalesce("json_payload", F.lit("")))
    ).drop("_corrupt_record", "json_payload")


def bronze(stream: DataFrame) -> DataFrame:
    """Decoded rows with audit columns; ``status`` routes malformed payloads, none are dropped."""
    rows = decode(envelope(stream))
    return rows.withColumns(
        {
            "_ingested_at": F.current_timestamp(),
            "_source_system": F.lit(SOURCE_SYSTEM),
            "status": F.when(F.col("_malformed").isNull(), "ok").otherwise("malformed"),
            "event_date": F.to_date("EventTimestamp"),
        }
    )


def write_append(
    stream: DataFrame, path: str, checkpoint: str, trigger: str | None = TRIGGER, partition_by=(),
    fmt: str = "parquet", name: str | None = None,
) -> StreamingQuery:
    """Append with checkpointed offsets. ``trigger=None`` takes what is available and stops."""
    writer = stream.writeStream.format(fmt).outputMode("append").option("checkpointLocation", checkpoint)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    if name:
        writer = writer.queryName(name)
    writer = writer.trigger(processingTime=trigger) if trigger else writer.trigger(availableNow=True)
    return writer.start(path)


def write_bronze(stream: DataFrame, path: str, checkpoint: str, trigger: str | None = TRIGGER) -> StreamingQuery:
    """One query, one read of the broker: usable and malformed rows land in separate partitions."""
    return write_append(bronze(stream), path, checkpoint, trigger, ["status", "event_date"])


def silver(bronze_rows: DataFrame, delay: str = "1 hour") -> DataFrame:
    """One row per TelemetryID, the earliest.

    On a stream, state is kept for ``delay`` behind the latest event time. Rows older than that are not
    emitted: this form is for displays that want bounded state and show recent readings. The table of
    record is written by write_silver, which keeps late rows. On a batch all rows count, and rows
    without TelemetryID pass through to the rules.
    """
    if bronze_rows.isStreaming:
        return bronze_rows.withWatermark("EventTimestamp", delay).dropDuplicatesWithinWatermark(["TelemetryID"])
    return keep_latest_with_nulls(bronze_rows, ["TelemetryID"], [F.col("EventTimestamp").asc()])


PLACES = T.StructType(
    [
        T.StructField("side", T.StringType()), T.StructField("event_date", T.DateType()),
        T.StructField("writer", T.StringType()), T.StructField("batch_id", T.LongType()),
    ]
)
_BATCHES = "batches"


def _start(stream: DataFrame, each: Callable[[DataFrame, int], None], checkpoint: str, trigger: str | None) -> StreamingQuery:
    writer = stream.writeStream.foreachBatch(each).option("checkpointLocation", checkpoint)
    writer = writer.trigger(processingTime=trigger) if trigger else writer.trigger(availableNow=True)
    return writer.start()


def write_silver(
    bronze_stream: DataFrame, path: str, checkpoint: str, trigger: str | None = TRIGGER, rules: list[Rule] | None = None,
) -> StreamingQuery:
    """Validated readings, one row per TelemetryID for all time; nothing is dropped uncounted.

    The stream keeps the TelemetryIDs it has seen in its state store, in RocksDB and so beyond memory, and
    passes each on once, however late and under whatever event date it comes again. Rows without
    TelemetryID cannot be compared and all pass on. Every micro-batch is checked by ``rules`` and written to
    side, date, writer and batch; a batch that runs again after a failure replaces its own folders. No
    batch reads or lists the table.
    """
    rules = vitals_rules() if rules is None else rules
    writer_id = hashlib.md5(checkpoint.encode()).hexdigest()
    # A row without id takes its place in the source as id, so that it is never a copy; a source that gives none has
    # a number drawn for it.
    placed = {"_kafka_partition", "_kafka_offset"} <= set(bronze_stream.columns)
    own = F.concat_ws("-", "_kafka_partition", "_kafka_offset") if placed else F.uuid()
    alone = F.when(F.col("TelemetryID").isNull(), own)
    first = bronze_stream.withColumn("_alone", alone).dropDuplicates(["TelemetryID", "_alone"]).drop("_alone")

    def add(batch: DataFrame, batch_id: int) -> None:
        side = F.when(is_valid(), "valid").otherwise("quarantine")
        rows = tag(batch, rules).withColumns({
            "side": side, "event_date": F.to_date("EventTimestamp"), "writer": F.lit(writer_id), "batch_id": F.lit(batch_id),
        }).drop(UNDECIDED)
        # Rows come in as many tasks as the state has partitions; each would write a file for every date it sees. A date
        # is written by as many tasks as there are cores at most, so that a batch of one date is still shared by all.
        share = F.pmod(F.xxhash64("TelemetryID", "EventTimestamp"), F.lit(batch.sparkSession.sparkContext.defaultParallelism))
        rows = rows.repartition("side", "event_date", share)
        rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*PLACES.names).parquet(
            f"{path}/{_BATCHES}"
        )

    return _start(first, add, checkpoint, trigger)


def _silver_schema(schema: T.StructType) -> T.StructType:
    fields = [f for f in schema if f.name not in PLACES.names]
    return T.StructType([*fields, T.StructField(FAILED, T.StringType()), *PLACES])


def read_silver(spark: SparkSession, path: str, schema: T.StructType, side: str = "valid") -> DataFrame:
    """The readings that write_silver has added so far, compacted ones included."""
    rows = compaction.read_live(spark, path, _BATCHES, _silver_schema(schema))
    return rows.where(F.col("side") == side).select(*schema.names, *([FAILED] if side != "valid" else []))


def compact_silver(
    spark: SparkSession, path: str, schema: T.StructType, run_id: str, target_bytes: int = compaction.TARGET_BYTES,
    running: bool = False,
) -> dict[str, int]:
    """Pack the small files of each side and date into files of about ``target_bytes``; large files are left alone.

    While the stream is ``running`` the last batch of each writer is left out, since it may be written again. Files that
    were packed are deleted by compaction.remove_replaced, when no reader needs them any more.
    """
    finished = None
    if running:
        files = compaction.live_files(spark, path, _BATCHES)
        writer, batch = (compaction.value_in("path", c) for c in ("writer", "batch_id"))
        last = files.where(writer != "").groupBy(writer.alias("w")).agg(F.max(batch.cast("long")).alias("n")).collect()
        finished = F.lit(True)
        for row in last:  # one row per writer
            finished = finished & ~((writer == row.w) & (batch.cast("long") == row.n))
    return compaction.compact(
        spark, path, _BATCHES, _silver_schema(schema), ["side", "event_date"], run_id, target_bytes, finished,
    )


# What a reading without a known patient waits for, and since when.
WAITING = T.StructType([T.StructField("PatientID", T.StringType()), T.StructField("since", T.TimestampType())])
_LATE = "_late"
RESOLVED, PENDING, GIVEN_UP = "resolved", "pending", "given_up"


def _gold_schema() -> T.StructType:
    return T.StructType([*gold_schema("fact_vitals_telemetry"), T.StructField("_waiting", WAITING)])


def write_gold(
    silver_stream: DataFrame, patients: Callable[[], DataFrame], path: str, checkpoint: str, trigger: str | None = TRIGGER,
    dimension: Callable[[], object] | None = None, give_up_after: str | None = None,
) -> StreamingQuery:
    """Readings with the patient key current when their batch runs: ``patients`` is called for every batch.

    A reading whose patient is not known yet has no key and says whom it waits for. With ``dimension``, which names the
    current version of the patients, a batch that sees a new name first resolves the readings that wait
    (resolve_late, with ``give_up_after``). Read the table with read_gold.
    """
    writer_id = hashlib.md5(checkpoint.encode()).hexdigest()

    def add(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        if dimension is not None and batch_id:
            name = str(dimension())
            if last_run(spark, f"{path}/{_LATE}") != name:
                resolve_late(spark, path, patients(), name, give_up_after, {writer_id: batch_id - 1})
        rows = fact_vitals(batch, patients(), ["PatientID"])
        waits = F.col("PatientSK").isNull() & F.col("PatientID").isNotNull()
        waiting = F.when(waits, F.struct("PatientID", F.current_timestamp().alias("since")))
        placed = {"_waiting": waiting, "writer": F.lit(writer_id), "batch_id": F.lit(batch_id)}
        # Both kinds of rows share a folder, so a batch that runs again replaces both.
        rows.withColumns(placed).drop("PatientID").write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(
            "writer", "batch_id"
        ).parquet(path)

    return _start(silver_stream, add, checkpoint, trigger)


def _taken(spark: SparkSession, path: str) -> dict[str, int]:
    """The last batch of each writer whose waiting readings resolve_late has taken over; one row per writer."""
    late = f"{path}/{_LATE}"
    return {r.writer: r.upto for r in read_current(spark, late, table="upto").collect()} if table_exists(spark, late) else {}


def _beyond(upto: dict[str, int]) -> Column:
    """Batches after the given ones, as a condition on folder names that prunes them."""
    known = [(F.col("writer") == w) & (F.col("batch_id") > n) for w, n in upto.items()]
    return reduce(lambda a, b: a | b, known, ~F.col("writer").isin(list(upto)))


def _gold_batches(spark: SparkSession, path: str) -> DataFrame | None:
    places = [T.StructField("writer", T.StringType()), T.StructField("batch_id", T.LongType())]
    return read_if_present(spark, path, T.StructType([*_gold_schema(), *places]))


def _late_rows(spark: SparkSession, path: str, *kinds: str) -> DataFrame:
    """Rows that left waiting in any run, or (PENDING) those that still wait after the last one."""
    late = f"{path}/{_LATE}"
    folders = published_folders(spark, late)
    if PENDING in kinds:
        folders = folders[-1:]
    if not folders:
        return spark.createDataFrame([], _gold_schema())
    schema = T.StructType([*_gold_schema(), T.StructField("_kind", T.StringType())])
    return spark.read.schema(schema).parquet(*[f"{late}/{f}/rows" for f in folders]).where(F.col("_kind").isin(*kinds)).drop("_kind")


def resolve_late(
    spark: SparkSession, path: str, patients: DataFrame, run_id: str, give_up_after: str | None = None,
    upto: dict[str, int] | None = None,
) -> dict[str, int]:
    """Give readings whose patient has arrived their key, and stop waiting for those older than ``give_up_after``.

    Works on the waiting readings only: those that the run before left, and those of the batches since. A run's rows
    count from one log row on, so each reading counts once, resolved or not. Batches after ``upto`` (by writer) are left
    for the next run; without it call this while no batch is being written, as the last one may be written again.
    Returns the numbers of readings by outcome. Those given up stay in the table, without a key.
    """
    batches, taken = _gold_batches(spark, path), _taken(spark, path)
    waiting = _late_rows(spark, path, PENDING)
    ends = dict(taken)
    if batches is not None:
        new = batches.where(_beyond(taken))
        if upto is not None:
            new = new.where(~_beyond(upto))
        seen = new.groupBy("writer").agg(F.max("batch_id").alias("n")).collect()  # one row per writer
        ends |= {r.writer: r.n for r in seen}
        waiting = waiting.unionByName(new.where("_waiting IS NOT NULL").select(*waiting.columns))
    names = gold_schema("fact_vitals_telemetry").names
    known = patients.where("PatientID IS NOT NULL").select(F.col("PatientID").alias("_id"), F.col("PatientSK").alias("_key"))
    joined = waiting.join(known, F.col("_waiting.PatientID") == F.col("_id"), "left")
    expired = F.lit(False) if give_up_after is None else F.col("_waiting.since") < F.current_timestamp() - F.expr(f"INTERVAL {give_up_after}")
    kind = F.when(F.col("_key").isNotNull(), RESOLVED).when(expired, GIVEN_UP).otherwise(PENDING)
    rows = joined.withColumns({"PatientSK": F.col("_key"), "_kind": kind}).select(*names, "_waiting", "_kind")
    counts: dict[str, int] = {}

    def build(folder: str) -> None:
        seen = Observation(f"late-{uuid.uuid4().hex}")
        numbers = [F.count_if(F.col("_kind") == k).alias(k) for k in (RESOLVED, PENDING, GIVEN_UP)]
        rows.observe(seen, *numbers).write.parquet(f"{folder}/rows")
        counts.update(seen.get)
        spark.createDataFrame(list(ends.items()), "writer string, upto long").coalesce(1).write.parquet(f"{folder}/upto")

    publish_together(spark, f"{path}/{_LATE}", run_id, build)
    return counts


def read_gold(spark: SparkSession, path: str) -> DataFrame:
    """The readings that write_gold has added, each once, with the key it has by now."""
    names, rows = gold_schema("fact_vitals_telemetry").names, _late_rows(spark, path, PENDING)
    rows = rows.unionByName(_late_rows(spark, path, RESOLVED, GIVEN_UP))
    batches = _gold_batches(spark, path)
    if batches is not None:
        direct = batches.where(F.col("_waiting").isNull() | _beyond(_taken(spark, path)))
        rows = rows.unionByName(direct.select(*rows.columns))
    return rows.select(*names)


def gold(silver_rows: DataFrame, patients: DataFrame) -> DataFrame:
    """Stream-static left join with the current patient key, in warehouse types."""
    return fact_vitals(silver_rows, patients)


def progress(query: StreamingQuery) -> dict:
    """What the query has read so far, for the run log."""
    seen = query.recentProgress
    return {
        "name": query.name,
        "batches": len(seen),
        "input_rows": sum(p["numInputRows"] for p in seen),
        "last_batch": seen[-1]["batchId"] if seen else None,
        "active": query.isActive,
    }
