"""S-*, K-*: sources and sinks, each written below the shared scratch folder and read back."""

from __future__ import annotations

from functools import partial

import pyarrow as pa
from pyspark.sql import functions as F

from .. import contracts, loads
from ..functions.parsing import parse_text
from ..operators import quality, scd2
from ..session import at_once, scratch_path
from ..sources import evolving, files, jdbc, tables
from ..streaming import vitals as stream
from . import bindings as b
from .registry import day, num, plain, query, ts
from .relational import _ENC_TEXT, _FENC_TEXT, _VIT_TEXT

_LAB_TEXT = f"LabResultID, EncounterID, PatientID, TestCode, TestName, TestValue, Unit, IsAbnormal, {ts('ResultTimestamp')}"
_PAT_TEXT = f"""PatientID, MedicalRecordNumber, FirstName, LastName, {day('DateOfBirth')}, Gender, PrimaryLanguage,
  AddressLine, City, State, ZipCode, PrimaryInsurancePayer, {ts('UpdatedTimestamp')}"""


def _through_csv(spark, df, contract):
    path = scratch_path(spark, "csv")
    # Without these options the writer trims text and turns NULL and '' into the same field.
    df.write.options(header=True, ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False, escape='"').csv(path)
    return files.read_csv(spark, path, contract).drop(files.CORRUPT)


@query("s01_csv_encounters", f"SELECT {_ENC_TEXT} FROM enc")
def s01(spark, sf):
    rows = _through_csv(spark, b.as_text(b.encounters(spark, sf)), contracts.ENCOUNTERS)
    return plain(parse_text(rows, contracts.ENCOUNTERS))


@query("s01_quoted_text", """
SELECT CAST(o_orderkey AS VARCHAR) AS DepartmentID, 'The "big", ' || o_orderpriority || ' one' AS DepartmentName,
  'line one' || chr(10) || 'line "two"' AS FacilityName, TRUE AS sound FROM orders""")
def s01_quoted(spark, sf):
    """Text with quotes, commas and line breaks as an RFC 4180 writer quotes it, written here line by line."""
    key, kind = F.col("o_orderkey").cast("string"), F.col("o_orderpriority")
    line = F.concat(key, F.lit(',"The ""big"", '), kind, F.lit(' one","line one\nline ""two"""'))
    return _csv_lines(spark, b.table(spark, sf, "orders").select(line.alias("value")), True)


def _csv_lines(spark, lines, multi_line, **sizes):
    """Finished lines of a departments file, with its header in each file, as the reader sees them."""
    path = _text_files(spark, lines, ",".join(contracts.DEPARTMENTS.names))
    rows = files.read_csv(spark, path, contracts.DEPARTMENTS, multi_line, **sizes)
    return rows.withColumn("sound", F.col(files.CORRUPT).isNull()).drop(files.CORRUPT, "_source_file")


def _text_files(spark, lines, head, foot=None, between=""):
    """A folder with one text file per partition, its lines between ``head`` and ``foot``.

    The text writer streams each partition's lines to one file; no value holds more than a line. Lines after the first
    begin with ``between``.
    """
    path = scratch_path(spark, "text")

    def framed(batches):
        yield pa.RecordBatch.from_arrays([pa.array([head])], names=["value"])
        first = True
        for batch in batches:
            values = batch.column(0).to_pylist()
            marked = [v if first and i == 0 else between + v for i, v in enumerate(values)]
            first = first and not values
            yield pa.RecordBatch.from_arrays([pa.array(marked, pa.string())], names=["value"])
        if foot is not None:
            yield pa.RecordBatch.from_arrays([pa.array([foot])], names=["value"])

    # Python sees the batches of one partition in turn, and the writer makes one file of them.
    lines.select("value").mapInArrow(framed, "value string").write.text(path)
    return path


# So small that the test tables' files fall into many blocks and chunks.
SMALL = {"split_bytes": 32 << 10, "chunk_chars": 8 << 10}


@query("s01_multi_line_split", """
SELECT CAST(o_orderkey AS VARCHAR) AS DepartmentID, 'Ward "' || o_orderpriority || '",' || chr(10) || chr(10) || o_orderstatus AS DepartmentName,
  CASE WHEN o_orderkey % 3 = 0 THEN 'a, b' ELSE chr(10) || '"' || strftime(o_orderdate, '%Y-%m-%d') || '"' || chr(10) END AS FacilityName,
  TRUE AS sound, TRUE AS shared FROM orders""")
def s01_split(spark, sf):
    """Quoted line breaks in files that several tasks read: borders of blocks and chunks fall inside quotes."""
    orders = b.table(spark, sf, "orders")
    name = F.concat(F.lit('"Ward ""'), "o_orderpriority", F.lit('"",\n\n'), "o_orderstatus", F.lit('"'))
    dated = F.concat(F.lit('"\n""'), F.date_format("o_orderdate", "yyyy-MM-dd"), F.lit('""\n"'))
    place = F.when(F.col("o_orderkey") % 3 == 0, '"a, b"').otherwise(dated)
    lines = orders.select(F.concat_ws(",", F.col("o_orderkey").cast("string"), name, place).alias("value"))
    path = _text_files(spark, lines, ",".join(contracts.DEPARTMENTS.names))
    rows = files.read_csv(spark, path, contracts.DEPARTMENTS, True, **SMALL)
    shared = _shared(spark, path, SMALL)
    return rows.select(*contracts.DEPARTMENTS.names, F.col(files.CORRUPT).isNull().alias("sound"), F.lit(shared).alias("shared"))


def _shared(spark, path, sizes):
    """Whether the largest file is longer than a block, so that several tasks read it."""
    longest = files.read_files(spark, path).agg(F.max("length").alias("n")).first()["n"] or 0
    return longest > sizes["split_bytes"]


@query("s01_surplus_fields", """
SELECT CAST(o_orderkey AS VARCHAR) AS DepartmentID, o_orderkey % 3 = 0 AS sound FROM orders""")
def s01_surplus(spark, sf):
    """Rows with a field too many or too few are marked, not cut."""
    key = F.col("o_orderkey")
    fields = F.when(key % 3 == 0, "a,b").when(key % 3 == 1, "a,b,c").otherwise("a")
    lines = b.table(spark, sf, "orders").select(F.concat_ws(",", key.cast("string"), fields).alias("value"))
    rows = _csv_lines(spark, lines, False)
    return tables.store(rows).select("DepartmentID", "sound")


@query("s02_csv_patients", f"SELECT {_PAT_TEXT} FROM pat")
def s02(spark, sf):
    rows = _through_csv(spark, b.as_text(b.patients(spark, sf)), contracts.PATIENTS)
    return plain(parse_text(rows, contracts.PATIENTS))


@query("s03_csv_providers", "SELECT * FROM prov")
def s03(spark, sf):
    return _through_csv(spark, b.providers(spark, sf), contracts.PROVIDERS)


@query("s03_csv_departments", "SELECT * FROM dept")
def s03_departments(spark, sf):
    return _through_csv(spark, b.departments(spark, sf), contracts.DEPARTMENTS)


@query("s04_json_labs", f"SELECT {_LAB_TEXT} FROM lab")
def s04(spark, sf):
    path = scratch_path(spark, "json")
    micros = "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX"
    b.labs(spark, sf).write.option("timestampFormat", micros).json(path)
    return plain(files.read_json_lines(spark, path, contracts.LABS, timestampFormat=micros))


@query("s04_json_array", f"SELECT {_LAB_TEXT} FROM lab")
def s04_array(spark, sf):
    """Files that hold one JSON array each, a thousand results long."""
    path, micros = scratch_path(spark, "json"), "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX"
    labs = b.labs(spark, sf)
    arrays = labs.groupBy((F.col("LabResultID").cast("long") / 1000).cast("long").alias("part")).agg(
        F.to_json(F.collect_list(F.struct(*labs.columns)), {"timestampFormat": micros}).alias("value")
    )
    arrays.write.partitionBy("part").text(path)
    rows = files.read_json_array(spark, path, contracts.LABS, timestampFormat=micros)
    return plain(rows.select(*contracts.LABS.names))


@query("s04_json_array_split", f"SELECT {_LAB_TEXT}, TRUE AS shared FROM lab")
def s04_split(spark, sf):
    """Indented arrays, one per file, that several tasks read."""
    micros = "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX"
    labs = b.labs(spark, sf)
    objects = labs.select(F.to_json(F.struct(*labs.columns), {"timestampFormat": micros, "pretty": "true"}).alias("value"))
    path = _text_files(spark, objects, "[", "]", ",")
    sizes = {"split_bytes": 128 << 10, "chunk_chars": 32 << 10}
    rows = files.read_json_array(spark, path, contracts.LABS, timestampFormat=micros, **sizes)
    shared = _shared(spark, path, sizes)
    return plain(rows.select(*contracts.LABS.names)).withColumn("shared", F.lit(shared))


def envelope_rows(events):
    """Telemetry events as the broker would deliver them: JSON bytes, time, partition, offset."""
    rows = b.vitals_of(events)
    iso = F.date_format("EventTimestamp", "yyyy-MM-dd'T'HH:mm:ss.SSSSSSxxx")
    payload = F.to_json(
        F.struct(*[iso.alias(c) if c == "EventTimestamp" else F.col(c) for c in contracts.VITALS_PAYLOAD.names])
    )
    # Payloads of "error" devices are cut short.
    text = F.when(F.col("DeviceID") == "error", F.substring(payload, 1, 40)).otherwise(payload)
    key = F.col("TelemetryID").cast("long")
    return rows.select(
        F.encode(text, "UTF-8").alias("value"), F.col("EventTimestamp").alias("timestamp"),
        (key % 4).cast("int").alias("partition"), key.alias("offset"),
    )


@query("s05_event_scan", f"""
SELECT "offset", "partition", {ts('EventTimestamp', 'enqueued')} FROM (
  SELECT CAST(TelemetryID AS BIGINT) AS "offset", CAST(CAST(TelemetryID AS BIGINT) % 4 AS INTEGER) AS "partition", EventTimestamp FROM vit)""")
def s05(spark, sf):
    """The broker's columns through the file source of read_events."""
    landed, out = scratch_path(spark, "envelope"), scratch_path(spark, "events")
    envelope_rows(b.table(spark, sf, "events")).write.parquet(landed)
    events = stream.read_events(spark, "parquet", landed)
    stream.write_append(events, out, scratch_path(spark, "offsets"), trigger=None).awaitTermination()
    rows = spark.read.schema(stream.ENVELOPE).parquet(out)
    return plain(rows.select("offset", "partition", F.col("timestamp").alias("enqueued")))


@query("s06_envelope", f"""
SELECT CAST(TelemetryID AS BIGINT) AS _kafka_offset, CAST(CAST(TelemetryID AS BIGINT) % 4 AS INTEGER) AS _kafka_partition,
  {ts('EventTimestamp', 'kafka_enqueued_time')}, CASE WHEN DeviceID = 'error' THEN 40 END AS cut_length FROM vit""")
def s06(spark, sf):
    rows = stream.envelope(envelope_rows(b.table(spark, sf, "events")))
    cut = F.when(~F.col("json_payload").endswith("}"), F.length("json_payload")).alias("cut_length")
    return plain(rows.select("_kafka_offset", "_kafka_partition", "kafka_enqueued_time", cut))


@query("s07_table_scan", f"SELECT {_ENC_TEXT} FROM enc")
def s07(spark, sf):
    root = scratch_path(spark, "silver")
    tables.publish(b.encounters(spark, sf), root, "r1")
    return plain(tables.read_current(spark, root, contracts.ENCOUNTERS))


@query("s08_sql_by_path", "SELECT o_orderstatus, count(*) AS n FROM orders GROUP BY 1")
def s08(spark, sf):
    return spark.sql(f"SELECT o_orderstatus, count(*) AS n FROM parquet.`{sf}/orders.parquet` GROUP BY 1")


@query("s09_serving_views", """
SELECT 'dim_department' AS view, count(*) AS n FROM dimdept UNION ALL SELECT 'dim_patient', count(*) FROM dimpat
UNION ALL SELECT 'dim_provider', count(*) FROM dimprov UNION ALL SELECT 'fact_patient_encounters', count(*) FROM fenc
UNION ALL SELECT 'fact_vitals_telemetry', count(*) FROM fvit""")
def s09(spark, sf):
    """Gold built twice; the views show the current version only."""
    root, counts = scratch_path(spark, "gold"), []
    encounters = tables.store(b.encounters(spark, sf), "encounters")  # as a build finds them; both read the same
    for run in ("r1", "r2"):
        _gold(spark, sf, root, run, encounters=encounters)
    for name in contracts.GOLD:
        files.serve(tables.read_current(spark, root, table=name), f"vw_{name}")
        counts.append(f"SELECT '{name}' AS view, count(*) AS n FROM vw_{name}")
    return spark.sql(" UNION ALL ".join(counts))


@query("s09_view_contents", """
SELECT FacilityName, EncounterType, count(*) AS Encounters, CAST(sum(TotalBilledAmount) AS DOUBLE) AS Billed,
  count(DISTINCT o_custkey) FILTER (WHERE o_custkey IN (SELECT c_custkey FROM customer)) AS Patients
FROM enc JOIN orders ON CAST(o_orderkey AS VARCHAR) = EncounterID LEFT JOIN dept USING (DepartmentID) GROUP BY 1, 2""")
def s09_contents(spark, sf):
    """SQL over the served views after a second build, which has twice the amounts of the first undone."""
    root = scratch_path(spark, "gold")
    for run in ("r1", "r2"):
        _gold(spark, sf, root, run, 2 if run == "r1" else 1)
        for name in contracts.GOLD:
            files.serve_current(spark, root, f"vw_{name}", name)
    return spark.sql("""
        SELECT FacilityName, EncounterType, count(*) AS Encounters, CAST(sum(TotalBilledAmount) AS DOUBLE) AS Billed,
          count(DISTINCT PatientSK) AS Patients
        FROM vw_fact_patient_encounters LEFT JOIN vw_dim_department USING (DepartmentSK) GROUP BY 1, 2""")


def _gold(spark, sf, root, run, times=1, encounters=None):
    encounters = b.encounters(spark, sf) if encounters is None else encounters
    return loads.build_gold(
        scd2.stage(b.patients(spark, sf)), b.providers(spark, sf), b.departments(spark, sf),
        encounters.withColumn("TotalBilledAmount", (F.col("TotalBilledAmount") * times).cast("decimal(12,2)")),
        b.vitals(spark, sf), root, run,
    )


@query("s10_control_scan", "SELECT SourceID, SourceSystem, EntityName, SourceFolderPath, TargetBronzePath FROM ctl WHERE IsActive AND IngestionType <> 'STREAMING'")
def s10(spark, sf):
    path = scratch_path(spark, "control")
    tables.overwrite(b.control(spark, sf), path)
    active = jdbc.read_control(spark, path).where("IsActive AND IngestionType <> 'STREAMING'")
    return active.select("SourceID", "SourceSystem", "EntityName", "SourceFolderPath", "TargetBronzePath")


@query("s11_raw_folder_scan", """
SELECT c_custkey // 100 AS part, sum(octet_length(encode(c_name)) + 1) AS size, string_agg(md5(c_name), ',' ORDER BY md5(c_name)) AS lines
FROM customer GROUP BY 1""")
def s11(spark, sf):
    """Files of any format, read as bytes: the size and the hash of every line."""
    path = scratch_path(spark, "raw")
    names = b.table(spark, sf, "customer").select(F.expr("c_custkey div 100").alias("part"), F.col("c_name").alias("value"))
    names.repartition("part").write.partitionBy("part").text(path)
    lines = F.split(F.regexp_replace(F.decode("content", "UTF-8"), "\n$", ""), "\n")
    return files.read_files(spark, path).where("length > 0").select(
        F.regexp_extract("path", "part=([0-9]+)", 1).cast("long").alias("part"), F.octet_length("content").cast("long").alias("size"),
        F.array_join(F.array_sort(F.transform(lines, F.md5)), ",").alias("lines"),
    ).groupBy("part").agg(F.sum("size").alias("size"), F.array_join(F.array_sort(F.split(F.array_join(F.collect_list("lines"), ","), ",")), ",").alias("lines"))


@query("k01_streaming_append", f"SELECT {_VIT_TEXT} FROM vit")
def k01(spark, sf):
    out = scratch_path(spark, "bronze")
    rows = b.vitals_of(events_stream(spark, sf))
    stream.write_append(rows, out, scratch_path(spark, "offsets"), trigger=None).awaitTermination()
    return plain(spark.read.schema(rows.schema).parquet(out))


def events_stream(spark, sf):
    """The events table as a file stream."""
    return (
        spark.readStream.schema(b.TABLES["events"]).option("pathGlobFilter", "events.parquet").parquet(sf)
    )


@query("k02_schema_evolution", """
SELECT event_id, event_type, CASE WHEN event_type <> 'click' THEN value END AS value FROM events""")
def k02(spark, sf):
    """A column that appears in the second append."""
    path = scratch_path(spark, "evolving")
    events = b.table(spark, sf, "events").select("event_id", "event_type", "value")
    tables.append(events.where("event_type = 'click'").drop("value"), path)
    tables.append(events.where("event_type <> 'click'"), path)
    return files.read_evolving(spark, path)


_THIRD = "event_id % 3 = 2 AND event_id % 10 = 0"


@query("k02_widened_type", f"""
SELECT event_id, CAST(user_id AS INTEGER) AS user_id,
  CASE event_id % 3 WHEN 1 THEN CAST(CAST(floor(value) AS DECIMAL(10,2)) AS DOUBLE) WHEN 2 THEN CAST(floor(value) AS DOUBLE) + 0.0625 END AS amount,
  FALSE AS held FROM events WHERE NOT ({_THIRD})
UNION ALL SELECT event_id, NULL, NULL, TRUE FROM events WHERE {_THIRD}""")
def k02_widened(spark, sf):
    """Three appends: the key widens from int to long, an amount appears and gets more digits, and a number comes as text,
    some of which is none and goes to quarantine."""
    path = scratch_path(spark, "evolving")
    events, key = b.table(spark, sf, "events"), F.col("event_id")
    user, whole = F.col("user_id").cast("int").alias("user_id"), F.floor("value")
    text = F.when(key % 10 == 0, F.concat(F.lit("user "), "user_id")).otherwise(F.col("user_id").cast("string")).alias("user_id")
    appends = [
        [key.cast("int").alias("event_id"), user], [key, user, whole.cast("decimal(10,2)").alias("amount")],
        [text, (whole + F.lit(0.0625)).cast("decimal(14,4)").alias("amount"), key],
    ]
    for i, columns in enumerate(appends):
        evolving.append_evolving(events.where(key % 3 == i).select(*columns), path, f"r{i}")
    rows = plain(evolving.read_evolved(spark, path)).withColumn("held", F.lit(False))
    held = evolving.read_held(spark, path).where("columns = array('user_id')").select(
        F.get_json_object("row", "$.event_id").cast("long").alias("event_id"), F.lit(True).alias("held")
    )
    return rows.unionByName(held, allowMissingColumns=True)


@query("k03_overwrite_new_schema", "SELECT EncounterID, EncounterType, 1 AS extra FROM enc")
def k03(spark, sf):
    root, rows = scratch_path(spark, "silver"), b.encounters(spark, sf)
    tables.publish(rows, root, "r1")
    narrow = tables.read_current(spark, root).select("EncounterID", "EncounterType", F.lit(1).alias("extra"))
    tables.publish(narrow, root, "r2")
    return tables.read_current(spark, root)


@query("k04_overwrite_gold", "SELECT DepartmentSK, DepartmentID, DepartmentName, FacilityName FROM dimdept")
def k04(spark, sf):
    path = scratch_path(spark, "dim_department")
    for _ in range(2):
        tables.overwrite(b.dim_department(spark, sf), path)
    return files.read_table(spark, path)


@query("k04_build_gold", f"""
SELECT {_FENC_TEXT}, p.PatientID AS PatientID, TRUE AS created
FROM fenc LEFT JOIN (SELECT PatientSK, PatientID FROM dimpat) p USING (PatientSK)""")
def k04_gold(spark, sf):
    """The published encounter fact beside the published patient dimension."""
    root = scratch_path(spark, "gold")
    _gold(spark, sf, root, "r1")
    fact = tables.read_current(spark, root, table="fact_patient_encounters")
    patients = tables.read_current(spark, root, table="dim_patient").select("PatientSK", "PatientID")
    created = F.col("_created_at").isNotNull()
    return plain(fact.withColumn("created", created).drop("_created_at").join(patients, "PatientSK", "left"))


@query("k04_failed_build_keeps_old_gold", """
SELECT 'dim_department' AS tab, count(*) AS n, TRUE AS refused FROM dimdept UNION ALL SELECT 'fact_patient_encounters', count(*), TRUE FROM fenc""")
def k04_failed(spark, sf):
    """A second build whose facts repeat a key: all five tables stay those of the first, and the log says why."""
    root, log = scratch_path(spark, "gold"), scratch_path(spark, "run_log")
    _gold(spark, sf, root, "r1")
    encounters = b.encounters(spark, sf)
    try:
        loads.build_gold(
            scd2.stage(b.patients(spark, sf)), b.providers(spark, sf), b.departments(spark, sf).limit(1),
            encounters.unionByName(encounters), b.vitals(spark, sf), root, "r2", log,
        )
    except loads.GoldRejected:
        pass
    failed = spark.read.schema(contracts.RUN_LOG).parquet(log).where("Status = 'FAILED' AND ErrorMessage LIKE '%repeated keys%'")
    counts = [
        tables.read_current(spark, root, table=t).agg(F.count(F.lit(1)).alias("n")).select(F.lit(t).alias("tab"), "n")
        for t in ("dim_department", "fact_patient_encounters")
    ]
    return counts[0].unionByName(counts[1]).withColumn("refused", F.lit(failed.count() == 1))


@query("k12_gold_rejects", """
SELECT 'LENGTH_State' AS RuleName, count(*) AS FailedRows FROM customer WHERE c_custkey % 5 = 0
UNION ALL SELECT 'REQUIRED_DateOfBirth', count(*) FROM customer WHERE c_custkey % 7 = 0
UNION ALL SELECT 'TYPES_FIT', count(*) FROM customer WHERE c_custkey % 7 = 0""")
def k12_rejects(spark, sf):
    """What the warehouse contract finds in a dimension with long states and unreadable dates."""
    key = F.col("PatientID").cast("long")
    patients = b.dim_patient(spark, sf).withColumns({
        "State": F.when(key % 5 == 0, "too long").otherwise(F.col("State")),
        "DateOfBirth": F.when(key % 7 == 0, "no date").otherwise(F.col("DateOfBirth").cast("string")),
    })
    rows, seen = loads.check_gold("dim_patient", patients)
    rows.write.format("noop").mode("overwrite").save()
    found = [(k, v) for k, v in seen.get.items() if v and k not in ("total", "passed", "quarantined")]
    return spark.createDataFrame(found, "RuleName string, FailedRows long")


@query("k05_create_or_merge", f"SELECT PatientSK, PatientID, IsCurrent, {ts(scd2.START)}, {ts(scd2.END)} FROM ver")
def k05(spark, sf):
    """The first load creates the table, the second is applied to it."""
    root = scratch_path(spark, "dim_patient_scd2")
    loads.load_versions(b.patients(spark, sf), root, "r1")
    loads.load_versions(b.patients_second_load(spark, sf), root, "r2")
    rows = tables.read_current(spark, root)
    return plain(rows.select("PatientSK", "PatientID", scd2.CURRENT, scd2.START, scd2.END))


@query("k06_quarantine_rerun", "SELECT EncounterID, 'r1' AS run_id FROM enc WHERE NOT LengthOfStayHours BETWEEN 0 AND 8760")
def k06(spark, sf):
    """The same bad batch quarantined twice leaves one copy."""
    root = scratch_path(spark, "gate")
    for _ in range(2):
        tables.gate(b.encounters(spark, sf), quality.encounter_rules(), root, "r1")
    return tables.read_quarantine(spark, root, contracts.ENCOUNTERS).select("EncounterID", "run_id")


@query("k07_quarantine_with_reason", """
SELECT c_custkey, 'BALANCE_NOT_NEGATIVE' AS _quarantine_reason, TRUE AS timed, 'r1' AS run_id FROM customer WHERE c_acctbal < 0""")
def k07(spark, sf):
    rule = quality.in_range("c_acctbal", 0, name="BALANCE_NOT_NEGATIVE")
    _, invalid = quality.split(b.table(spark, sf, "customer"), [rule])
    place = scratch_path(spark, "quarantine") + f"/customer/{rule.name}"
    tables.write_run(quality.quarantine_columns(invalid, "r1", rule.name), place, "r1")
    return spark.read.parquet(place).select(
        "c_custkey", "_quarantine_reason", F.col("_quarantined_at").isNotNull().alias("timed"), "run_id"
    )


@query("k08_append_run_log", "SELECT ExecutionID, RunID, Layer, Status, RecordsIngested FROM runs")
def k08(spark, sf):
    """Run events of the two layers appended in two writes, the second one repeated."""
    path, runs = scratch_path(spark, "run_log"), b.run_log(spark, sf)
    for layer in ("BRONZE", "SILVER", "SILVER"):
        jdbc.append_audit(runs.where(F.col("Layer") == layer), path, layer)
    return spark.read.parquet(path).select("ExecutionID", "RunID", "Layer", "Status", "RecordsIngested")


@query("k09_append_rule_log", """
SELECT strftime(AdmitTimestamp, '%Y') AS ExecutionID, 'RULE_02_VALID_LENGTH_OF_STAY' AS RuleName,
  count(*) AS TotalRecordsChecked, count(*) FILTER (WHERE NOT LengthOfStayHours BETWEEN 0 AND 8760) AS FailedRecordCount
FROM enc GROUP BY 1""")
def k09(spark, sf):
    path = scratch_path(spark, "rule_log")
    yearly = b.encounters(spark, sf).withColumn("ExecutionID", F.date_format("AdmitTimestamp", "yyyy"))
    counts = quality.rule_counts(yearly, quality.encounter_rules(), by=["ExecutionID"])
    jdbc.append_audit(tables.conform(counts, contracts.RULE_LOG), path)
    rows = spark.read.schema(contracts.RULE_LOG).parquet(path).where("RuleType = 'RANGE_CHECK'")
    return rows.where(F.col("RuleName").endswith("STAY")).select(
        "ExecutionID", "RuleName", "TotalRecordsChecked", "FailedRecordCount"
    )


def landing(spark, sf):
    """The six raw drops under one folder, as the control table's seed rows expect them; written beside each other."""
    root = scratch_path(spark, "raw")
    csv = {
        "landing/ehr/patients/": b.patients, "landing/ehr/providers/": b.providers,
        "landing/pm/departments/": b.departments, "landing/ehr/encounters/": b.encounters,
        "landing/claims/billing_claims/": b.claims,
    }

    def drop(folder, build):
        b.as_text(build(spark, sf)).write.option("header", True).csv(f"{root}/{folder}")

    at_once(spark, [
        *[partial(drop, *named) for named in csv.items()],
        lambda: b.as_text(b.labs(spark, sf)).write.json(f"{root}/landing/labs/lab_results/"),
    ])
    return root


@query("k10_raw_to_bronze", f"""
SELECT ClaimID, EncounterID, PatientID, CAST(ClaimAmount AS VARCHAR) AS ClaimAmount, InsurancePayer, ClaimStatus,
  {day('ClaimDate')}, 'CLAIMS_ENGINE' AS _source_system FROM clm""")
def k10(spark, sf):
    """Claims text copied to Bronze unchanged, with provenance."""
    raw, path = scratch_path(spark, "raw"), scratch_path(spark, "bronze")
    b.as_text(b.claims(spark, sf)).write.option("header", True).csv(raw)
    rows = files.with_provenance(files.read_csv(spark, raw, contracts.CLAIMS).drop(files.CORRUPT), "CLAIMS_ENGINE")
    tables.land(rows, path, "r1")
    return spark.read.parquet(path).select(*contracts.CLAIMS.names, "_source_system")


@query("k11_provenance", "SELECT o_orderkey, 'orders.parquet' AS file, 'ERP' AS _source_system, TRUE AS timed FROM orders")
def k11(spark, sf):
    rows = files.with_provenance(b.table(spark, sf, "orders"), "ERP")
    return rows.select(
        "o_orderkey", F.element_at(F.split("_source_file", "/"), -1).alias("file"), "_source_system",
        F.col("_ingested_at").isNotNull().alias("timed"),
    )


@query("k13_create_table", f"SELECT EncounterID, EncounterType, {num('TotalBilledAmount')} FROM fenc")
def k13(spark, sf):
    """A table created with its declared schema, replaced, then filled."""
    name = "strataflow_fact_patient_encounters"
    for _ in range(2):
        tables.create_table(spark, name, contracts.gold_schema("fact_patient_encounters"), scratch_path(spark, name))
    b.fact_encounters(spark, sf).write.insertInto(name)
    return plain(spark.table(name).select("EncounterID", "EncounterType", "TotalBilledAmount"))
