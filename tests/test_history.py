import datetime as dt
import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from strataflow import loads
from strataflow.operators import scd2
from strataflow.operators.joins import as_of, orphans
from strataflow.operators.ordered import in_order
from strataflow.sources import tables

T1, T2, T3 = (dt.datetime(2025, m, 1) for m in (1, 3, 6))
SCHEMA = "PatientID string, AddressLine string, City string, PrimaryInsurancePayer string, State string, UpdatedTimestamp timestamp"


def patients(spark, *rows):
    return spark.createDataFrame([tuple(r) for r in rows], SCHEMA)


@pytest.fixture
def first(spark):
    return patients(
        spark, ("changed", "a", "x", "p", "NY", T1), ("same", "a", "x", "p", "NY", T1), ("from_null", "a", "x", None, "NY", T1),
        ("to_null", "a", "x", "p", "NY", T1), ("untracked", "a", "x", "p", "NY", T1),
    )


@pytest.fixture
def second(spark):
    return patients(
        spark, ("changed", "a", "x", "q", "NY", T2), ("same", "a", "x", "p", "NY", T2), ("from_null", "a", "x", "z", "NY", T2),
        ("to_null", "a", "x", None, "NY", T2), ("untracked", "a", "x", "p", "TX", T2), ("new", "b", "y", "p", "CA", T2),
    )


def shown(df):
    cols = ["PatientID", "PrimaryInsurancePayer", scd2.START, "IsCurrent"]
    return sorted((tuple(r) for r in df.select(*cols).collect()), key=str)


def test_apply_closes_and_opens_in_one_run(spark, first, second):
    result = scd2.apply_scd2(scd2.initial_load(first), second)
    got = shown(result)
    for key, old, new in (("changed", "p", "q"), ("from_null", None, "z"), ("to_null", "p", None)):
        assert (key, old, T1, False) in got and (key, new, T2, True) in got
    for key in ("same", "untracked"):
        assert [r for r in got if r[0] == key] == [(key, "p", T1, True)]
    assert ("new", "p", T2, True) in got
    assert scd2.violations(result, "PatientID").isEmpty()


def test_rerun_and_small_batch_give_the_same(spark, first, second):
    target = scd2.initial_load(first)
    once = scd2.apply_scd2(target, second)
    assert shown(scd2.apply_scd2(once, second)) == shown(once)
    assert shown(scd2.apply_scd2(target, second, small_batch=True)) == shown(once)
    some = second.where("PatientID = 'changed'")
    assert shown(scd2.apply_scd2(target, some, small_batch=True)) == shown(scd2.apply_scd2(target, some))


def test_plain_merge_leaves_no_current_version_until_rerun(spark, first, second):
    merged = scd2.merge_close_only(scd2.initial_load(first), second)
    got = shown(merged)
    assert [r for r in got if r[0] == "changed"] == [("changed", "p", T1, False)]
    assert [r for r in got if r[0] == "from_null"] == [("from_null", None, T1, True)]
    again = shown(scd2.merge_close_only(merged, second))
    assert [r for r in again if r[0] == "changed"] == [("changed", "p", T1, False), ("changed", "q", T2, True)]


def test_late_change_is_put_in_its_place(spark, first, second):
    target = scd2.apply_scd2(scd2.initial_load(first), second.withColumn("UpdatedTimestamp", F.lit(T3)))
    result = scd2.apply_scd2(target, patients(spark, ("changed", "a", "x", "mid", "NY", T2)))
    spans = [
        (r.PrimaryInsurancePayer, r[scd2.START], r[scd2.END])
        for r in result.where("PatientID = 'changed'").orderBy(scd2.START).collect()
    ]
    assert spans == [("p", T1, T2), ("mid", T2, T3), ("q", T3, dt.datetime(9999, 12, 31, 23, 59, 59))]


def test_plain_merge_of_a_late_change_ends_before_it_starts(spark, first):
    target = scd2.initial_load(first.withColumn("UpdatedTimestamp", F.lit(T3)))
    late = patients(spark, ("changed", "a", "x", "q", "NY", T1))
    merged = scd2.merge_close_only(target, late)
    problems = {(r.PatientID, r.problem) for r in scd2.violations(merged, "PatientID").collect()}
    assert problems == {("changed", "no current"), ("changed", "empty version")}


def test_key_twice_in_one_batch_becomes_versions(spark):
    batch = patients(spark, ("k", "a", "x", "p", "NY", T1), ("k", "a", "x", "q", "NY", T2), ("k", "a", "x", "q", "NY", T3))
    assert shown(scd2.initial_load(batch)) == [("k", "p", T1, False), ("k", "q", T2, True)]


def test_rows_without_key_or_time_do_not_become_versions(spark):
    batch = patients(spark, (None, "a", "x", "p", "NY", T1), ("k", "a", "x", "p", "NY", None))
    assert scd2.initial_load(batch).isEmpty()


def test_equal_start_is_decided_the_same_way_on_any_partitioning(spark):
    batch = patients(spark, *[("k", "a", str(i), "p", "NY", T1) for i in range(20)])
    results = {tuple(r.City for r in scd2.initial_load(batch.repartition(n)).collect()) for n in (1, 3, 8)}
    assert len(results) == 1 and len(next(iter(results))) == 1


def random_log(spark, seed, users=4, rows=400):
    rng = random.Random(seed)
    start = dt.datetime(2025, 1, 1)
    data = [
        (rng.choice("a" * 5 + "bcd"[: users - 1]), rng.choice("xyz"), start + dt.timedelta(minutes=i))
        for i in rng.sample(range(5000), rows)
    ]
    return data, spark.createDataFrame(data, f"k string, state string, {scd2.START} timestamp")


@pytest.mark.parametrize("seed", [1, 2])
def test_large_groups_give_the_history_of_a_plain_window(spark, seed):
    _, log = random_log(spark, seed)
    plain = scd2.history_from_changelog(log, ["k"], ["state"], max_rows=None)
    split = scd2.history_from_changelog(log, ["k"], ["state"], max_rows=15)
    columns = plain.columns
    assert sorted(map(tuple, plain.collect())) == sorted(map(tuple, split.select(*columns).collect()))
    assert "_slice" not in split.columns


def test_only_groups_over_the_bound_are_split(spark):
    data, log = random_log(spark, 3)

    def count(order, rows):
        return rows.withColumn("sliced", F.lit(bool(order.slices)))

    largest = max(sum(r[0] == k for r in data) for k in "bcd")
    marked = in_order(log, ["k"], [scd2.START], count, max_rows=largest)
    assert {(r.k, r.sliced) for r in marked.collect()} == {("a", True), ("b", False), ("c", False), ("d", False)}


def test_tasks_and_files_do_not_grow_with_the_slices(spark):
    """Far more slices than a shuffle has partitions: no slice is over the bound, and a task takes several."""
    rows = spark.range(3000).select((F.col("id") % 2).alias("k"), F.col("id").alias("t"), (F.col("id") % 7 < 3).alias("v"))
    files = []

    def work(order, part):
        files.append(len(part.inputFiles()))
        return order.previous(part, ["t"], "before").withColumn("slice", F.col("_slice") if order.slices else F.lit(-1).cast("long"))

    got = in_order(rows, ["k"], ["t"], work, 10).collect()
    sizes = Counter((r.k, r.slice) for r in got)
    assert len(sizes) >= 300 and max(sizes.values()) <= 10
    assert files[0] <= int(spark.conf.get("spark.sql.shuffle.partitions"))
    assert all((r.before.t if r.before else None) == (r.t - 2 if r.t > 1 else None) for r in got) and len(got) == 3000


@pytest.mark.parametrize("max_rows", [1, 3])
def test_violations_of_groups_in_tiny_slices(spark, max_rows):
    _, log = random_log(spark, 5)
    late = scd2.history_from_changelog(log, ["k"], ["state"], max_rows=None).withColumn(scd2.END, F.col(scd2.END) + F.expr("INTERVAL 1 HOUR"))
    whole, cut = (sorted(map(tuple, scd2.violations(late, "k", max_rows=n).collect())) for n in (None, max_rows))
    assert whole and whole == cut


@pytest.mark.parametrize("opts", [
    {"versions_per_key": 10_000}, {"broadcast_bytes": 0, "max_rows": None}, {"broadcast_bytes": 0, "max_rows": 10}, {},
])
def test_as_of_equals_brute_force(spark, opts):
    data, log = random_log(spark, 7)
    versions = scd2.history_from_changelog(log, ["k"], ["state"], max_rows=None)
    # Leave a gap: one version ends early, so some facts have no valid version.
    rng = random.Random(8)
    start = dt.datetime(2025, 1, 1)
    facts = [(i, rng.choice(["a", "b", "zz", None]), start + dt.timedelta(minutes=rng.randrange(6000))) for i in range(300)]
    facts += [(900, "a", None), (901, "a", data[0][2]), (902, data[0][0], data[0][2])]
    fact_df = spark.createDataFrame(facts, "id long, k string, at timestamp")
    cut = versions.withColumn(scd2.END, F.when(F.col("state") == "x", F.col(scd2.START) + F.expr("interval 3 minutes")).otherwise(F.col(scd2.END)))
    known = [(r.k, r[scd2.START], r[scd2.END], r.state) for r in cut.collect()]
    wanted = {
        i: next((s for k2, a, z, s in known if k is not None and at is not None and k2 == k and a <= at < z), None)
        for i, k, at in facts
    }
    got = as_of(fact_df, cut, "k", "at", scd2.START, scd2.END, ["state"], **opts).collect()
    assert {r.id: r.state for r in got} == wanted and len(got) == len(facts)


def test_orphans_ignore_missing_keys(spark):
    child = spark.createDataFrame([("a",), ("b",), (None,)], "k string")
    parent = spark.createDataFrame([("a",), (None,)], "k string")
    assert [r.k for r in orphans(child, parent, "k").collect()] == ["b"]


def test_a_batch_reads_and_writes_its_parts_only(spark, tmp_path, first, second):
    """The files of the other parts are made unreadable: the load does not notice, and they stay as they are."""
    root = str(tmp_path / "dim")
    many = spark.range(200).select(F.concat(F.lit("k"), "id").alias("PatientID"), F.lit("a").alias("AddressLine"), F.lit("x").alias("City"),
                                   F.lit("p").alias("PrimaryInsurancePayer"), F.lit("NY").alias("State"), F.lit(T1).alias("UpdatedTimestamp"))
    loads.load_versions(first.unionByName(many), root, "r1", parts=8)
    whole = tables.read_current(spark, root)
    batch = second.where("PatientID IN ('changed', 'new')")
    wanted = shown(scd2.apply_scd2(tables.store(whole), batch))
    touched = tables.touched_parts(batch, root)
    assert 1 <= len(touched) <= 2 and len(tables.part_folders(spark, root)) == 8
    hidden = {}
    for part, folder in tables.part_folders(spark, root).items():
        for file in (tmp_path / "dim" / folder / f"_part={part}").glob("*.parquet"):
            if part not in touched:
                hidden[file] = file.read_bytes()
                file.write_bytes(b"no parquet")
                (file.parent / f".{file.name}.crc").unlink(missing_ok=True)
    assert len(hidden) == 8 - len(touched)
    loads.load_versions(batch, root, "r2")
    for file, content in hidden.items():
        assert file.read_bytes() == b"no parquet"
        file.write_bytes(content)
    assert shown(tables.read_current(spark, root)) == wanted
    written = [f for f in (tmp_path / "dim").glob("attempt=v2-*/_part=*")]
    assert sorted(int(f.name.split("=")[1]) for f in written) == touched
    # An empty batch and a new column.
    loads.load_versions(batch.limit(0), root, "r3")
    loads.load_versions(batch.withColumn("Extra", F.lit(1)), root, "r4")
    rows = tables.read_current(spark, root)
    assert shown(rows) == wanted and rows.where("Extra = 1").count() >= 1 and rows.where("Extra IS NULL").count() > 150


def test_tables_of_one_folder_become_parts_with_the_next_load(spark, tmp_path, first, second):
    root = str(tmp_path / "dim")
    tables.publish(scd2.initial_load(first), root, "r1")
    loads.load_versions(second, root, "r2", parts=4)
    assert shown(tables.read_current(spark, root)) == shown(scd2.apply_scd2(scd2.initial_load(first), second))
    assert set(tables.part_folders(spark, root)) <= set(range(4))
