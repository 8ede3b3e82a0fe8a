import datetime as dt
import hmac
import json
import threading
import time

import pytest
from pyspark.sql import functions as F

from strataflow import contracts, loads, session
from strataflow.functions.keys import business_key, version_key
from strataflow.functions.masking import mask_columns
from strataflow.functions.parsing import parse_text
from strataflow.operators import control, dedup, layout, scd2, star
from strataflow.plans import transport
from strataflow.sources import evolving, files, jdbc, tables


def test_zip_code_keeps_its_zero(spark, tmp_path):
    (tmp_path / "p.csv").write_text(",".join(contracts.PATIENTS.names) + "\nP1,M1,A,B,1980-02-29,F,English,1 Main St,Boston,MA,02134,Aetna,2025-01-01 10:00:00\n")
    row = parse_text(files.read_csv(spark, str(tmp_path), contracts.PATIENTS), contracts.PATIENTS).first()
    assert row.ZipCode == "02134" and row.DateOfBirth == dt.date(1980, 2, 29)
    assert row.UpdatedTimestamp == dt.datetime(2025, 1, 1, 10)


def test_csv_header_must_match_the_contract(spark, tmp_path):
    (tmp_path / "d.csv").write_text("DepartmentName,DepartmentID,FacilityName\nICU,D1,North\n")
    with pytest.raises(Exception, match="header"):
        files.read_csv(spark, str(tmp_path), contracts.DEPARTMENTS).collect()


def test_json_array_document(spark, tmp_path):
    labs = [
        {"LabResultID": f"L{i}", "EncounterID": "E1", "PatientID": "P1", "TestCode": "LOINC_2823-3", "TestName": "Potassium",
         "TestValue": 4.5 + i, "Unit": "mmol/L", "IsAbnormal": bool(i), "ResultTimestamp": "2025-01-01 10:00:00"}
        for i in range(2)
    ]
    (tmp_path / "labs.json").write_text(json.dumps(labs, indent=2))
    rows = files.read_json_array(spark, str(tmp_path), contracts.LABS).orderBy("LabResultID").collect()
    assert [(r.LabResultID, r.TestValue, r.IsAbnormal) for r in rows] == [("L0", 4.5, False), ("L1", 5.5, True)]
    assert rows[0].ResultTimestamp == dt.datetime(2025, 1, 1, 10)


def test_readers_follow_the_published_version(spark, tmp_path):
    root = str(tmp_path / "t")
    assert not tables.table_exists(spark, root)
    with pytest.raises(FileNotFoundError):
        tables.read_current(spark, root)
    assert tables.publish(spark.range(5), root, "r1") == 1
    before = tables.read_current(spark, root)
    assert tables.publish(before.where("id > 2"), root, "r2") == 2
    assert tables.read_current(spark, root).count() == 2
    assert before.count() == 5


def test_conform_adds_missing_columns(spark):
    df = spark.createDataFrame([("D1", 7)], "DepartmentID string, Extra int")
    assert tables.conform(df, contracts.DEPARTMENTS).columns == ["DepartmentID", "DepartmentName", "FacilityName", "Extra"]


def test_keys_do_not_depend_on_the_session_time_zone(spark):
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    df = spark.createDataFrame([("P1", dt.datetime(2025, 1, 1, 10)), (None, dt.datetime(2025, 1, 1)), ("P2", None)], "id string, t timestamp")
    keyed = df.select("id", version_key("id", "t").alias("sk"), business_key("id").alias("bk"))
    utc = keyed.collect()
    try:
        spark.conf.set("spark.sql.session.timeZone", "America/New_York")
        assert keyed.collect() == utc
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    assert utc[0].sk is not None and utc[1].sk is None and utc[1].bk is None and utc[2].sk is None


def test_masking(spark):
    df = spark.createDataFrame([("Jane 12", "keep")], "FirstName string, City string")
    assert mask_columns(df).first() == ("Xxxx nn", "keep")
    assert mask_columns(df, policy="null").first().FirstName is None


def test_keyed_hash_is_hmac(spark):
    df = spark.createDataFrame([("Jané",), (None,), ("",)], "FirstName string")
    for secret in (b"k", b"k" * 64, b"k" * 100):
        wanted = [hmac.new(secret, v.encode(), "sha256").hexdigest() if v is not None else None for v in ("Jané", None, "")]
        assert [r.FirstName for r in mask_columns(df, policy="keyed", secret=secret).collect()] == wanted
    with pytest.raises(ValueError):
        mask_columns(df, policy="keyed")


@pytest.mark.parametrize("a,b,wanted", [
    ("int", "bigint", "bigint"), ("smallint", "int", "int"), ("float", "double", "double"), ("int", "double", "double"),
    ("bigint", "double", None), ("date", "timestamp", "timestamp"), ("decimal(10,2)", "decimal(8,4)", "decimal(12,4)"),
    ("int", "decimal(5,3)", "decimal(13,3)"), ("decimal(38,0)", "decimal(10,5)", None), ("string", "int", None),
    ("array<int>", "array<bigint>", "array<bigint>"), ("struct<x:int>", "struct<x:bigint,y:string>", "struct<x:bigint,y:string>"),
    ("struct<x:int>", "struct<x:string>", None), ("void", "int", "int"),
])
def test_widened_types(spark, a, b, wanted):
    kind = lambda t: spark.sql(f"SELECT CAST(NULL AS {t}) AS c").schema["c"].dataType
    for x, y in ((a, b), (b, a)):
        got = evolving.widened(kind(x), kind(y))
        assert got is None if wanted is None else {f.name: f.dataType for f in got} == {f.name: f.dataType for f in kind(wanted)} if (
            wanted.startswith("struct")) else got.simpleString() == wanted


def test_evolved_tables_open_no_footers_to_plan(spark, tmp_path):
    """A file of an append is made unreadable: planning and the other appends' columns do not need it."""
    path = str(tmp_path / "t")
    assert evolving.append_evolving(spark.createDataFrame([(1, "a")], "id int, T string"), path, "r1") == {"rows": 1, "quarantined": 0}
    assert evolving.append_evolving(spark.createDataFrame([(1 << 40, [1])], "ID bigint, extra array<int>"), path, "r2")["rows"] == 1
    wrong = spark.createDataFrame([("x", None), ("7", "b"), (None, "c")], "id string, t string")
    assert evolving.append_evolving(wrong, path, "r3") == {"rows": 2, "quarantined": 1}
    nested = spark.createDataFrame([(5, ("s",))], "id int, t struct<x:string>")
    assert evolving.append_evolving(nested, path, "r4") == {"rows": 0, "quarantined": 1}
    rows = evolving.read_evolved(spark, path)
    assert rows.dtypes == [("id", "bigint"), ("T", "string"), ("extra", "array<int>")]
    assert sorted(map(tuple, rows.collect()), key=repr) == sorted([(1, "a", None), (1 << 40, None, [1]), (7, "b", None), (None, "c", None)], key=repr)
    held = evolving.read_held(spark, path).collect()
    assert sorted((r["columns"], json.loads(r["row"])["id"]) for r in held) == [(["T"], 5), (["id"], "x")]
    for part in tmp_path.glob("t/append-*/*.parquet"):
        part.write_bytes(b"no parquet")
    assert evolving.read_evolved(spark, path).dtypes == rows.dtypes
    with pytest.raises(FileNotFoundError):
        evolving.read_evolved(spark, str(tmp_path / "nothing"))


def test_require_unique(spark):
    df = spark.createDataFrame([("a",), ("a",)], "k string")
    with pytest.raises(ValueError):
        dedup.require_unique(df, ["k"])
    assert dedup.require_unique(df.distinct(), ["k"]).count() == 1


def test_jdbc_options_need_one_target():
    assert jdbc.jdbc_options("jdbc:x", table="t", user="u") == {"url": "jdbc:x", "dbtable": "t", "user": "u"}
    with pytest.raises(ValueError):
        jdbc.jdbc_options("jdbc:x")


def test_a_repeated_load_replaces_its_rows_in_a_database(spark, monkeypatch):
    """What is sent, without a database: the rows of the same executions go before the new ones come."""
    sent = []
    monkeypatch.setattr(jdbc, "_run", lambda _, sink, text, values: sent.append((sink["url"], text, values)))
    monkeypatch.setattr(jdbc, "_insert", lambda df, sink: sent.append(df.count()))
    sink = jdbc.jdbc_options("jdbc:x", table="log.runs")
    rows = spark.createDataFrame([("e2",), ("e1",), ("e2",)], "ExecutionID string")
    jdbc.append_audit(rows, sink, "b")
    jdbc.append_audit(rows, sink)
    jdbc.append_audit(rows.limit(0), sink, "b")
    assert sent == [("jdbc:x", "DELETE FROM log.runs WHERE ExecutionID IN (?, ?)", ["e1", "e2"]), 3, 3, 0]
    with pytest.raises(ValueError):
        jdbc.delete_statement("t", "k", 0)


def test_scratch_root_comes_from_the_session(spark):
    assert session.scratch_path(spark, "x").startswith(spark.conf.get("spark.checkpoint.dir"))


def test_shuffle_partitions():
    assert session.shuffle_partitions(100 << 40, 8000) == 819200
    assert session.shuffle_partitions(1 << 20, 8) == 16


def test_zorder_prunes_on_both_columns(spark, tmp_path):
    rows = spark.range(64 * 64).select((F.col("id") % 64).alias("a"), F.floor(F.col("id") / 64).alias("b"))
    layout.zorder_by(rows, ["a", "b"], 16).write.parquet(str(tmp_path / "z"))
    spans = (
        spark.read.parquet(str(tmp_path / "z")).groupBy(F.col("_metadata.file_name"))
        .agg((F.max("a") - F.min("a")).alias("a"), (F.max("b") - F.min("b")).alias("b"), F.count(F.lit(1)).alias("n")).collect()
    )
    assert len(spans) == 16 and sum(r.n for r in spans) == 64 * 64
    for col in "ab":
        assert sum(r[col] for r in spans) / len(spans) < 32


@pytest.fixture
def raw_drop(tmp_path):
    folder = tmp_path / "raw" / "landing"
    text = {
        "ehr/patients": (contracts.PATIENTS, ["P1,M1,A,B,1980-01-01,F,English,1 St,Boston,MA,02134,Aetna,2025-01-01 10:00:00",
                                              "P2,M2,A,B,1980-01-01,F,English,1 St,Boston,MA,02134,Aetna,2025-02-01 10:00:00"]),
        "ehr/providers": (contracts.PROVIDERS, ["PR1,0123456789,Dr. A,Neurology,D1"]),
        "pm/departments": (contracts.DEPARTMENTS, ["D1,ICU,North"]),
        "ehr/encounters": (contracts.ENCOUNTERS, ["E1,P1,PR1,D1,ICU,2025-03-01 00:00:00,,,Fever,ADMITTED,10.5",
                                                  "E2,P1,PR1,D1,ICU,bad time,,,Fever,ADMITTED,10.5"]),
    }
    for name, (contract, lines) in text.items():
        (folder / name).mkdir(parents=True)
        (folder / name / "f.csv").write_text("\n".join([",".join(contract.names), *lines]) + "\n")
    (folder / "labs/lab_results").mkdir(parents=True)
    lab = {"LabResultID": "L1", "EncounterID": "E1", "PatientID": "P1", "TestCode": "c", "TestName": "n", "TestValue": 1.5,
           "Unit": "u", "IsAbnormal": False, "ResultTimestamp": "2025-03-01 05:00:00"}
    (folder / "labs/lab_results/f.json").write_text(json.dumps([lab], indent=2))
    return str(tmp_path / "raw")


def test_ingest_logs_failures_and_moves_watermarks(spark, raw_drop, tmp_path):
    """The claims folder is missing: its failure is logged, the others load, the run ends as FAILED."""
    bronze, log = str(tmp_path / "bronze"), str(tmp_path / "log")
    seed = control.seed_control(spark, dt.datetime(2025, 1, 1))
    after = tables.store(loads.ingest(spark, seed, raw_drop, bronze, log, "it's", json_array=True))
    events = spark.read.schema(contracts.RUN_LOG).parquet(log)
    status = {r.SourceEntity: r.Status for r in control.current_status(events).collect()}
    assert status.pop(loads.ALL_ENTITIES) == "FAILED"
    assert status == {"Patients": "SUCCESS", "Providers": "SUCCESS", "Departments": "SUCCESS", "Encounters": "SUCCESS",
                      "LabResults": "SUCCESS", "BillingClaims": "FAILED"}
    failure = events.where("SourceEntity = 'BillingClaims'").first()
    assert "billing_claims" in failure.ErrorMessage and failure.RunID == "it's" and failure.ExecutedBy
    marks = {r.EntityName: r.WatermarkValue for r in after.collect()}
    assert marks["Patients"] == dt.datetime(2025, 2, 1, 10) and marks["Encounters"] == dt.datetime(2025, 3, 1)
    assert marks["BillingClaims"] == dt.datetime(1970, 1, 1) and marks["PatientVitals"] is None
    landed = spark.read.parquet(f"{bronze}/bronze/ehr/encounters/")
    assert landed.count() == 2 and landed.where("_source_system = 'EPIC_EHR' AND _source_file LIKE '%f.csv'").count() == 2
    # Files that were read do not come again, whatever the times of their rows.
    again = loads.ingest(spark, after, raw_drop, bronze, log + "2", "r2", json_array=True)
    again.count()
    rows = {r.SourceEntity: r.RecordsIngested for r in spark.read.schema(contracts.RUN_LOG).parquet(log + "2").collect()}
    assert (rows["Patients"], rows["Encounters"], rows["Providers"], rows["LabResults"]) == (0, 0, 1, 0)


def claims_drop(tmp_path, name, *ids):
    folder = tmp_path / "raw/landing/claims/billing_claims"
    folder.mkdir(parents=True, exist_ok=True)
    lines = [f"{i},E1,P1,10.5,PAYER,OPEN,2025-03-01" for i in ids]
    (folder / name).write_text("\n".join([",".join(contracts.CLAIMS.names), *lines]) + "\n")


def claims_landed(spark, tmp_path):
    return sorted(r.ClaimID for r in loads.read_bronze(spark, "BillingClaims", str(tmp_path / "bronze")).collect())


def claims_load(spark, tmp_path, run):
    seed = control.seed_control(spark).where("EntityName = 'BillingClaims'")
    loads.ingest(spark, seed, str(tmp_path / "raw"), str(tmp_path / "bronze"), str(tmp_path / "log" / run), run)
    rows = spark.read.schema(contracts.RUN_LOG).parquet(str(tmp_path / "log" / run)).where("SourceEntity = 'BillingClaims'").collect()
    return [(r.Status, r.RecordsIngested) for r in rows]


def test_entities_load_beside_each_other(spark, raw_drop, tmp_path, monkeypatch):
    """Two entities wait for each other, which no load in turn could; those of one Bronze folder never run at once."""
    meet, land, inside, most = threading.Barrier(2, timeout=60), loads.land_entity, [], []

    def wait(spark, row, *args):
        if row.EntityName in ("Patients", "Providers"):
            meet.wait()
        if row.TargetBronzePath == "bronze/same/":
            inside.append(row.EntityName)
            most.append(len(inside))
            done = land(spark, row, *args)
            inside.remove(row.EntityName)
            return done
        return land(spark, row, *args)

    monkeypatch.setattr(loads, "land_entity", wait)
    named = F.col("EntityName").isin("Departments", "Encounters")
    seed = control.seed_control(spark).where("EntityName NOT IN ('LabResults', 'BillingClaims')")
    seed = seed.withColumn("TargetBronzePath", F.when(named, "bronze/same/").otherwise(F.col("TargetBronzePath")))
    after = loads.ingest(spark, seed, raw_drop, str(tmp_path / "bronze"), str(tmp_path / "log"), "r1")
    events = spark.read.schema(contracts.RUN_LOG).parquet(str(tmp_path / "log")).where("Status <> 'STARTED'").collect()
    assert {r.SourceEntity: (r.Status, r.RecordsIngested, r.ErrorMessage) for r in events} == {
        "Patients": ("SUCCESS", 2, None), "Providers": ("SUCCESS", 1, None), "Departments": ("SUCCESS", 1, None),
        "Encounters": ("SUCCESS", 2, "1 unreadable"), loads.ALL_ENTITIES: ("SUCCESS", 0, None),
    }
    assert most == [1, 1]
    marks = {r.EntityName: r.WatermarkValue for r in after.collect()}
    assert marks["Patients"] == dt.datetime(2025, 2, 1, 10) and marks["Encounters"] == dt.datetime(2025, 3, 1)


def test_a_wait_for_the_log_is_no_load_time(spark, tmp_path, monkeypatch):
    """All loads end at once and a log row takes a second: each row's times are its own load's, inside those of the run."""
    ends, append = threading.Barrier(3, timeout=60), loads.append_audit

    def land(spark, row, *args):
        ends.wait()
        if row.EntityName == "Providers":
            raise ValueError("no drop")
        return {"rows": 1, "high": None}

    def slow(event, sink):
        time.sleep(1)
        append(event, sink)

    monkeypatch.setattr(loads, "land_entity", land)
    monkeypatch.setattr(loads, "append_audit", slow)
    seed = control.seed_control(spark).where("EntityName IN ('Patients', 'Providers', 'Departments')")
    loads.ingest(spark, seed, str(tmp_path), str(tmp_path / "bronze"), str(tmp_path / "log"), "r1")
    events = spark.read.schema(contracts.RUN_LOG).parquet(str(tmp_path / "log")).where("Status <> 'STARTED'").collect()
    times = {r.SourceEntity: (r.ExecutionStartTime, r.ExecutionEndTime) for r in events}
    began, done = times.pop(loads.ALL_ENTITIES)
    assert len(times) == 3 and max(e for _, e in times.values()) - min(e for _, e in times.values()) < dt.timedelta(seconds=1)
    assert all(began <= s <= e <= done for s, e in times.values())


def test_landed_rows_are_counted_in_their_folder(spark, tmp_path):
    """Rows of a second attempt are not counted, derived columns are not written, no rows give zero."""
    path, rows = str(tmp_path / "t"), spark.createDataFrame([("1",), ("x",), (None,)], "a string")
    asked = {"high": F.max("n"), "bad": F.count_if(F.col("n").isNull())}, {"n": F.col("a").try_cast("int")}
    for _ in range(2):
        seen = tables.land(rows, path, "r1", *asked)
        assert (seen["rows"], seen["high"], seen["bad"]) == (3, 1, 2)
    assert spark.read.parquet(path).drop("run_id", "attempt").columns == ["a"]
    none = tables.land(rows.where("a = 'y'"), path, "r1", *asked)
    assert (none["rows"], none["high"], none["bad"]) == (0, None, 0)


def test_a_load_does_not_read_bronze(spark, tmp_path):
    """The rows of the first load are made unreadable; later loads do not notice."""
    claims_drop(tmp_path, "a b%20.csv", "c1", "c2")
    assert claims_load(spark, tmp_path, "r1") == [("SUCCESS", 2)]
    assert claims_landed(spark, tmp_path) == ["c1", "c2"]
    target = tmp_path / "bronze/bronze/claims/billing_claims"
    for part in target.glob("run_id=r1/*/*.parquet"):
        part.write_bytes(b"no parquet")
        (part.parent / f".{part.name}.crc").unlink(missing_ok=True)
    claims_drop(tmp_path, "b.csv", "c2", "c3")
    assert claims_load(spark, tmp_path, "r2") == [("SUCCESS", 2)]
    assert claims_load(spark, tmp_path, "r3") == [("SUCCESS", 0)]


def test_a_file_that_comes_again_stands_in_for_its_rows(spark, tmp_path):
    claims_drop(tmp_path, "a b%20.csv", "c1", "c2")
    claims_drop(tmp_path, "other.csv", "c1")
    claims_load(spark, tmp_path, "r1")
    assert claims_landed(spark, tmp_path) == ["c1", "c1", "c2"]
    time.sleep(1.1)
    claims_drop(tmp_path, "a b%20.csv", "c2", "c4")
    assert claims_load(spark, tmp_path, "r2") == [("SUCCESS", 2)]
    assert claims_landed(spark, tmp_path) == ["c1", "c2", "c4"]


def test_a_broken_load_is_read_again(spark, tmp_path, monkeypatch):
    claims_drop(tmp_path, "a.csv", "c1")

    def stop(*_, **__):
        raise RuntimeError("driver lost")

    with monkeypatch.context() as patch:
        patch.setattr(tables, "_completed_loads", stop)
        patch.setattr(loads, "files_landed", lambda *_: None)
        assert claims_load(spark, tmp_path, "r1") == [("FAILED", 0)]
    assert claims_landed(spark, tmp_path) == []
    assert claims_load(spark, tmp_path, "r1-again") == [("SUCCESS", 1)]
    assert claims_landed(spark, tmp_path) == ["c1"]


def test_seed_has_seven_entities_and_six_batch_loads(spark):
    seed = control.seed_control(spark)
    assert seed.count() == 7 and control.active_entities(seed).count() == 6
    new, n = control.advance_watermark(seed, "EPIC_EHR", "Patients", dt.datetime(2025, 5, 5))
    assert n == 1 and new.where("EntityName = 'Patients'").first().WatermarkValue == dt.datetime(2025, 5, 5)
    assert control.advance_watermark(seed, "EPIC_EHR", "Nobody", dt.datetime(2025, 5, 5))[1] == 0


def test_create_or_merge(spark, tmp_path):
    schema = "PatientID string, AddressLine string, City string, PrimaryInsurancePayer string, UpdatedTimestamp timestamp"
    root = str(tmp_path / "dim")
    one = spark.createDataFrame([("P1", "a", "x", "p", dt.datetime(2025, 1, 1))], schema)
    two = spark.createDataFrame([("P1", "a", "x", "q", dt.datetime(2025, 2, 1))], schema)
    assert [loads.load_versions(df, root, run) for df, run in ((one, "r1"), (two, "r2"), (two, "r3"))] == [1, 2, 3]
    rows = tables.read_current(spark, root).orderBy("EffectiveStartDate").collect()
    assert [(r.PrimaryInsurancePayer, r.IsCurrent) for r in rows] == [("p", False), ("q", True)]


def test_csv_lines_are_written_over_all_partitions(spark):
    """Each partition of lines becomes a file with its header; none is gathered with others."""
    lines = spark.range(0, 1000, 1, 9).select(F.concat_ws(",", F.col("id").cast("string"), F.lit("a,b")).alias("value"))
    rows = transport._csv_lines(spark, lines, False)
    assert len(rows.inputFiles()) == 9
    assert sorted(int(r.DepartmentID) for r in rows.where("sound").collect()) == list(range(1000))
    assert transport._csv_lines(spark, lines.limit(0), True).count() == 0


def test_calls_at_once_run_beside_each_other_and_keep_their_order(spark):
    both = threading.Barrier(2, timeout=20)
    assert session.at_once(spark, [lambda: (both.wait(), "a")[1], lambda: (both.wait(), "b")[1]]) == ["a", "b"]
    ended = []

    def fail(text, seconds):
        time.sleep(seconds)
        ended.append(text)
        raise ValueError(text)

    with pytest.raises(ValueError, match="first"):
        session.at_once(spark, [lambda: fail("first", 0.3), lambda: fail("second", 0)])
    assert ended == ["second", "first"]


def _gold_rows(spark, n):
    at = dt.datetime(2025, 1, 1)
    patients = spark.createDataFrame(
        [(f"P{i}", f"M{i}", "A", "B", at.date(), "F", "English", None, None, "MA", None, None, at) for i in range(n)], contracts.PATIENTS
    )
    providers = spark.createDataFrame([(f"D{i}", str(i), "A", "B", "W1") for i in range(n)], contracts.PROVIDERS)
    departments = spark.createDataFrame([("W1", "ICU", "North")], contracts.DEPARTMENTS)
    encounters = spark.createDataFrame(
        [(f"E{i}", f"P{i}", f"D{i}", "W1", "ER", at, at, None, None, "DONE", None) for i in range(n + 1)], contracts.ENCOUNTERS
    ).withColumn("TotalBilledAmount", F.lit(1).cast("decimal(12,2)"))
    vitals = spark.createDataFrame(
        [(f"T{i}", f"P{i}", f"E{i}", "bed", 80, 120, 80, 97.0, 36.6, at) for i in range(n)],
        "TelemetryID string, PatientID string, EncounterID string, DeviceID string, HeartRate int, BloodPressureSystolic int, "
        "BloodPressureDiastolic int, OxygenSaturation double, BodyTemperature double, EventTimestamp timestamp",
    ).withColumn("IsCriticalAlert", F.lit(False))
    return scd2.stage(patients), providers, departments, encounters, vitals


def test_gold_shuffles_encounters_for_patients_only(spark, tmp_path, monkeypatch):
    """Provider and department keys are broadcast by their measured size, whatever Spark makes of the files."""
    built, make = [], star.fact_encounters
    monkeypatch.setattr(loads.star, "fact_encounters", lambda *args: built.append(make(*args)) or built[-1])
    rows, root, log = _gold_rows(spark, 5), str(tmp_path / "gold"), str(tmp_path / "log")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        loads.build_gold(*rows, root, "r1", log)
        plan = built[0]._jdf.queryExecution().sparkPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert (plan.count("BroadcastHashJoin"), plan.count("SortMergeJoin")) == (2, 1)
    fact = tables.read_current(spark, root, table="fact_patient_encounters").orderBy("EncounterID").collect()
    assert [(r.PatientSK is None, r.ProviderSK is None, r.DepartmentSK is None) for r in fact] == [(False,) * 3] * 5 + [(True, True, False)]
    assert spark.read.schema(contracts.RUN_LOG).parquet(log).first().RecordsIngested == 5 + 5 + 1 + 6 + 5


def test_gold_names_the_first_table_that_breaks_its_contract(spark, tmp_path):
    versions, providers, departments, encounters, vitals = _gold_rows(spark, 3)
    broken = providers.withColumn("NPI_Number", F.lit("12345678901"))
    twice = departments.unionByName(departments)
    with pytest.raises(loads.GoldRejected, match="dim_provider: {'LENGTH_NPI_Number': 3}, 0 repeated keys"):
        loads.build_gold(versions, broken, twice, encounters, vitals, str(tmp_path / "gold"), "r1")
    assert not tables.table_exists(spark, str(tmp_path / "gold"))


def test_serving_views_read_the_encounters_once(spark, tmp_path, monkeypatch):
    rows, asked, made = _gold_rows(spark, 4), [], []
    bound = transport.b
    for name, df in zip(("providers", "departments", "vitals"), (rows[1], rows[2], rows[4])):
        monkeypatch.setattr(bound, name, lambda *_, df=df: df)
    monkeypatch.setattr(bound, "patients", lambda *_: rows[0].drop("PatientSK", scd2.CURRENT, scd2.START, scd2.END))
    monkeypatch.setattr(bound, "encounters", lambda *_: asked.append(1) or rows[3])
    build = loads.build_gold
    monkeypatch.setattr(loads, "build_gold", lambda *args: made.append(args[6]) or build(*args))
    counts = {r.view: r.n for r in transport.s09(spark, str(tmp_path)).collect()}
    assert counts == {"dim_department": 1, "dim_patient": 4, "dim_provider": 4, "fact_patient_encounters": 5, "fact_vitals_telemetry": 4}
    assert (len(asked), made) == (1, ["r1", "r2"])
