import datetime as dt
import random
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from strataflow import contracts, loads
from strataflow.operators import control, quality, references, silver, slices
from strataflow.sources import tables
from strataflow.streaming import offsets as continuity, vitals as stream

DAY = dt.datetime(2025, 1, 1)


def encounter(key, patient="P1", hours="10.00", billed="100.00", admit=DAY):
    return (
        key, patient, "D1", "W1", "ICU", admit, None, Decimal(hours) if hours else None, "Fever", "HOME",
        Decimal(billed),
    )


@pytest.fixture
def null_los(spark):
    """Good; no length of stay; negative; no key; no patient and no stay; stay and amount both wrong."""
    rows = [
        encounter("E1"), encounter("E2", hours=None), encounter("E3", hours="-1"), encounter(None),
        encounter("E5", patient=None, hours=None), encounter("E6", hours="9000", billed="-1"),
    ]
    return spark.createDataFrame(rows, contracts.ENCOUNTERS)


def keys(df):
    return sorted((r.EncounterID or "-") for r in df.collect())


def test_no_row_is_lost(null_los):
    valid, invalid = quality.split(null_los, quality.encounter_rules())
    assert keys(valid) == ["E1", "E2"]
    assert keys(invalid) == ["-", "E3", "E5", "E6"]


def test_drop_policy_loses_the_undecided_row(null_los):
    valid, invalid = quality.split(null_los, quality.encounter_rules("drop", "drop"))
    assert keys(valid) == ["E1"]
    assert keys(invalid) == ["-", "E3", "E5", "E6"]


def test_fail_policy_quarantines_it(null_los):
    valid, invalid = quality.split(null_los, quality.encounter_rules("fail"))
    assert keys(valid) == ["E1"] and invalid.count() == 5


def test_failed_rules_are_named(null_los):
    _, invalid = quality.split(null_los, quality.encounter_rules())
    named = {r.EncounterID: r[quality.FAILED] for r in invalid.collect()}
    assert named["E6"] == "RULE_02_VALID_LENGTH_OF_STAY,RULE_03_VALID_BILLED_AMOUNT"
    assert named["E5"] == "RULE_01_NOT_NULL_KEYS"


def test_gate_counts_rows_written_and_is_idempotent(spark, null_los, tmp_path):
    root = str(tmp_path / "silver")
    for _ in range(2):
        counts = tables.gate(null_los, quality.encounter_rules(), root, "r1")
    assert (counts["total"], counts["passed"], counts["quarantined"]) == (6, 2, 4)
    assert keys(tables.read_valid(spark, root, contracts.ENCOUNTERS)) == ["E1", "E2"]
    bad = tables.read_quarantine(spark, root, contracts.ENCOUNTERS)
    assert bad.count() == 4
    assert {r.run_id for r in bad.collect()} == {"r1"}
    assert bad.where("_quarantined_at IS NULL OR _quarantine_reason IS NULL").isEmpty()


def test_quarantine_keeps_all_runs_and_silver_only_the_last(spark, null_los, tmp_path):
    root = str(tmp_path / "silver")
    tables.gate(null_los, quality.encounter_rules(), root, "r1")
    tables.gate(null_los.where("EncounterID = 'E1'"), quality.encounter_rules(), root, "r2")
    assert keys(tables.read_valid(spark, root, contracts.ENCOUNTERS)) == ["E1"]
    assert tables.read_quarantine(spark, root, contracts.ENCOUNTERS).count() == 4


def test_null_keys_and_ties_survive_dedup(spark):
    raw = [encounter(None, billed=str(i)) for i in (1, 2, 3)]
    raw += [encounter("E1", billed="5"), encounter("E1", billed="4")]
    rows = spark.createDataFrame(raw, contracts.ENCOUNTERS)
    typed = rows.select(*[F.date_format(c, "yyyy-MM-dd HH:mm:ss").alias(c) if "Timestamp" in c else F.col(c).cast("string").alias(c) for c in rows.columns])
    got = [silver.encounters(typed.repartition(n)).collect() for n in (1, 5)]
    for result in got:
        assert sorted(r.TotalBilledAmount for r in result if r.EncounterID is None) == [1, 2, 3]
        assert [r.TotalBilledAmount for r in result if r.EncounterID] == [4]


def test_unparsed_text_is_reported(spark):
    row = ("E1", "P1", "D1", "W1", "ICU", "01/02/2025", "", "12", "Fever", "ADMITTED", "ten")
    raw = spark.createDataFrame([row], contracts.text_contract(contracts.ENCOUNTERS))
    typed = silver.encounters(raw).first()
    assert typed._unparsed == "AdmitTimestamp=01/02/2025; TotalBilledAmount=ten"
    assert typed.DischargeTimestamp is None and typed.LengthOfStayHours == 12


def test_rule_log_and_run_log_agree(spark, null_los, tmp_path):
    sinks = str(tmp_path / "runs"), str(tmp_path / "rules")
    for _ in range(2):
        loads.load_silver(
            null_los, quality.encounter_rules(), str(tmp_path / "t"), "silver.fact_encounters", "Encounters", "r1", *sinks
        )
    run = spark.read.parquet(sinks[0]).collect()
    assert [(r.Status, r.RecordsIngested, r.RecordsQuarantined) for r in run] == [("QUARANTINED", 2, 4)]
    rules = {r.RuleName: (r.TotalRecordsChecked, r.FailedRecordCount) for r in spark.read.parquet(sinks[1]).collect()}
    assert rules == {
        "RULE_01_NOT_NULL_KEYS": (6, 2), "RULE_02_VALID_LENGTH_OF_STAY": (6, 2), "RULE_03_VALID_BILLED_AMOUNT": (6, 1),
    }


def test_contract_rejects_missing_long_and_misfit_values(spark):
    df = spark.createDataFrame([("k", "i", "n" * 11, "x", "y", "d"), ("k", "i", "1", None, "y", "d")],
                               "ProviderSK string, ProviderID string, NPI_Number string, ProviderName string, Specialty string, DepartmentID string")
    tagged = quality.tag(quality.enforce(df, contracts.DIM_PROVIDER), quality.contract_rules(contracts.DIM_PROVIDER))
    assert [r[quality.FAILED] for r in tagged.collect()] == ["LENGTH_NPI_Number", "REQUIRED_ProviderName"]


def test_drift(spark):
    df = spark.createDataFrame([(1, "a", "b")], "DepartmentID long, DepartmentName string, Extra string")
    assert quality.drift(df, contracts.DEPARTMENTS) == [
        ("FacilityName", "missing", "string", None), ("Extra", "extra", None, "string"),
        ("DepartmentID", "type", "string", "bigint"),
    ]
    counted = {r.ColumnName: r.RowsWithValue for r in quality.drift_profile(df, contracts.DEPARTMENTS).collect()}
    assert counted == {"FacilityName": 0, "Extra": 1, "DepartmentID": 1}


def test_unknown_policy_is_refused():
    with pytest.raises(ValueError):
        quality.Rule("r", "NO_SUCH_TYPE", None)


def test_final_status():
    assert control.final_status(0) == "SUCCESS" and control.final_status(3) == "QUARANTINED"


def test_batch_silver_vitals_keeps_one_row_per_reading(spark):
    rows = spark.createDataFrame([("t1", DAY), ("t1", DAY), ("t2", DAY), (None, DAY)], "TelemetryID string, EventTimestamp timestamp")
    assert sorted(r.TelemetryID or "-" for r in stream.silver(rows).collect()) == ["-", "t1", "t2"]


def test_references_read_the_parts_that_may_hold_a_key(spark, tmp_path):
    """Other parts are made unreadable; filters are made anew for rewritten parts only."""
    root = str(tmp_path / "parent")
    parent = spark.range(5000).select(F.concat(F.lit("k"), "id").alias("id"), F.col("id").alias("v"))
    tables.publish_parts(parent.unionByName(spark.createDataFrame([(None, 1)], "id string, v long")), root, "r1", "id", 32)
    assert references.update_filters(spark, root, "id") == list(range(32))
    assert references.update_filters(spark, root, "id") == []
    child = spark.createDataFrame([(1, "k17"), (2, "k17"), (3, "x1"), (4, None), (5, "x2")], "c long, id string")
    keys = [r.p for r in child.where("id LIKE 'k%'").select(tables.part_of("id", 32).alias("p")).distinct().collect()]
    for part, folder in tables.part_folders(spark, root).items():
        if part not in keys:
            for file in (tmp_path / "parent" / folder / f"_part={part}").glob("*.parquet"):
                file.write_bytes(b"no parquet")
                (file.parent / f".{file.name}.crc").unlink(missing_ok=True)
    # x1 and x2 are settled by the filters alone.
    assert sorted(r.c for r in references.orphans_in_parts(child, root, "id").collect()) == [3, 5]
    seen = references.repeated_keys(child, root, "id").collect()
    assert [(r.id, r.rows, r.in_table) for r in seen] == [("k17", 2, True)]
    touched = tables.touched_parts(child.where("c = 1"), root)
    kept = tables.read_parts(spark, root, touched).where("id <> 'k17'")
    tables.publish_parts(kept, root, "r2", only=touched)
    assert references.update_filters(spark, root, "id") == touched
    assert sorted(r.c for r in references.orphans_in_parts(child.where("c < 3"), root, "id").collect()) == [1, 2]


@pytest.mark.parametrize("size", [1, 3000, 40_000])
def test_filters_never_miss_a_key(spark, tmp_path, size):
    root = str(tmp_path / "parent")
    tables.publish_parts(spark.range(size).withColumnRenamed("id", "k"), root, "r1", "k", 2)
    references.update_filters(spark, root, "k")
    tried = references._tried(spark.range(2 * size).withColumnRenamed("id", "k"), spark, root, "k").collect()
    assert len(tried) == 2 * size and all(r.possible for r in tried if r.k < size)
    assert sum(r.possible for r in tried if r.k >= size) <= 0.03 * size


def test_islands_of_offsets(spark):
    rng = random.Random(9)
    rows = [(p, o) for p in (0, 1) for o in range(300) if rng.random() < 0.8 for _ in range(rng.choice([1, 1, 2]))] + [(None, 3), (2, None), (3, 7)]
    rng.shuffle(rows)
    half = len(rows) // 2
    logs = [
        continuity.islands(spark.createDataFrame(part, "_kafka_partition int, _kafka_offset long"), slice_size=16) for part in (rows[:half], rows[half:])
    ]
    merged = continuity.merged(logs[0].unionByName(logs[1]))
    placed = [(p, o) for p, o in rows if p is not None and o is not None]
    lost = {(r.partition, o) for r in continuity.gaps(merged).collect() for o in range(r.first_missing, r.last_missing + 1)}
    for r in continuity.summary(merged).collect():
        own = [o for p, o in placed if p == r.partition]
        assert (r.first, r.last, r.seen, r.repeated) == (min(own), max(own), len(set(own)), len(own) - len(set(own)))
        wanted = {(r.partition, o) for o in range(min(own), max(own)) if o not in own}
        assert {x for x in lost if x[0] == r.partition} == wanted and r.missing == len(wanted)
    assert continuity.islands(spark.createDataFrame([], "_kafka_partition int, _kafka_offset long")).isEmpty()


def test_slices_count_keys_beyond_one_bitmap(spark):
    """Numbers over several buckets, NULL keys and slicer values, and keys that come later."""
    fact = spark.range(100_000).select(
        F.when(F.col("id") % 11 > 0, F.concat(F.lit("p"), F.col("id") % 70_000)).alias("k"), (F.col("id") % 3).alias("a"),
        F.when(F.col("id") % 2 == 0, "x").alias("b"), F.lit(1).alias("m"),
    )
    first = tables.store(slices.numbered(fact.where("a = 0"), "k"))
    numbers = tables.store(slices.numbered(fact, "k", first))
    assert numbers.agg(F.countDistinct(slices.NUMBER), F.max(slices.NUMBER) + 1, F.count("*")).first()[:] == (numbers.count(),) * 3
    assert first.join(numbers, ["k", slices.NUMBER]).count() == first.count()
    table = tables.store(slices.slice_table(fact, numbers, "k", ["a", "b"], {"n": F.sum("m")}))
    got = {(r.a, r.b, r.level): (r.keys, r.n) for r in slices.every_slice(table, ["a", "b"], ["n"], "keys").collect()}
    for cols, level in ((["a", "b"], 0), (["a"], 1), (["b"], 2), ([], 3)):
        for r in fact.groupBy(*cols).agg(F.countDistinct("k").alias("keys"), F.sum("m").alias("n")).collect():
            row = r.asDict()
            assert got.pop((row.get("a"), row.get("b"), level)) == (r["keys"], r["n"])
    assert not got
    one = slices.by_slice(table, ["b"], ["n"], "keys", {"a": [1, 2]})
    assert {r.b: r["keys"] for r in one.collect()} == {
        r.b: r["keys"] for r in fact.where("a > 0").groupBy("b").agg(F.countDistinct("k").alias("keys")).collect()
    }
    # The second aggregation has the small table as its only input.
    assert set(one.inputFiles()) == set(table.inputFiles())
