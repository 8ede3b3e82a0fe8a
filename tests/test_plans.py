"""The physical plans the operators are meant to have."""

import contextlib
import datetime as dt
import io

import pytest
from pyspark.sql import functions as F

from strataflow import contracts
from strataflow.operators import control, dedup, joins, layout, marts, quality, scd2, silver, star
from strataflow.operators.ordered import in_order
from strataflow.plans import QUERIES, bindings as b

SF = "/root/testdata/sf0.001"


def plan(df, mode="formatted"):
    out = io.StringIO()
    with contextlib.redirect_stdout(out):
        df.explain(mode)
    return out.getvalue()


def simple(df):
    return plan(df, "simple")


def test_dedup_limits_each_key_before_the_shuffle(spark):
    text = simple(dedup.keep_latest(b.claims(spark, SF), ["ClaimID"], ["ClaimDate"]))
    assert text.count("WindowGroupLimit") == 2 and "Partial" in text
    assert text.count("Exchange") == 1


def test_rules_read_their_input_once(spark):
    rows = b.table(spark, SF, "orders").select(
        F.col("o_orderkey").cast("string").alias("EncounterID"), F.col("o_custkey").cast("string").alias("PatientID"),
        F.col("o_totalprice").cast("decimal(10,2)").alias("LengthOfStayHours"),
        F.col("o_totalprice").cast("decimal(12,2)").alias("TotalBilledAmount"),
    )
    text = simple(quality.rule_counts(rows, quality.encounter_rules()))
    assert text.count("FileScan") == 1 and text.count("Exchange") == 1


def scans(df):
    return simple(df).count("FileScan")


def test_dedup_and_split_read_their_input_once(spark, tmp_path):
    path = str(tmp_path / "raw")
    b.as_text(b.encounters(spark, SF)).write.parquet(path)
    assert scans(silver.encounters(spark.read.parquet(path))) == 1
    assert scans(quality.sides(spark.read.parquet(f"{SF}/orders.parquet"), [quality.not_null("o_custkey")])) == 1
    labs = b.labs(spark, SF)
    keys = spark.range(5).select(F.col("id").cast("string").alias("EncounterID"))
    ranges = spark.createDataFrame([("c", 1.0, 2.0)], "TestCode string, MinNormal double, MaxNormal double")
    assert scans(silver.labs(labs, ranges, keys)) == 1


def test_first_summary_resolves_departments_only(spark):
    text = simple(QUERIES["a02_from_raw_text"](spark, SF))
    assert text.count("Join") <= 4 and "customer" not in text


def test_null_keys_are_sliced_too(spark):
    rows = spark.range(2000).select(F.lit(None).cast("string").alias("k"), F.col("id").alias("t"), (F.col("id") % 3).alias("v"))

    def work(order, part):
        seen = order.previous(part, ["v"], "before")
        return seen.withColumn("task", F.col("_slice") if order.slices else F.lit(-1))

    got = in_order(rows, ["k"], ["t"], work, 200).collect()
    assert len(got) == 2000 and len({r.task for r in got}) > 1
    assert all((r.before.v if r.before else None) == ((r.t - 1) % 3 if r.t else None) for r in got)


def test_watermark_filter_reaches_the_scan(spark):
    rows = control.incremental(b.table(spark, SF, "orders"), "o_orderdate", dt.datetime(1999, 1, 1))
    text = plan(rows.select("o_orderkey"))
    assert "GreaterThan(o_orderdate" in text
    assert "ReadSchema: struct<o_orderkey:bigint,o_orderdate:timestamp>" in text


def test_current_filter_reaches_the_scan(spark, tmp_path):
    scd2.stage(b.patients(spark, SF)).write.parquet(str(tmp_path / "v"))
    text = plan(star.dim_patient(spark.read.parquet(str(tmp_path / "v"))).select("PatientSK"))
    assert "EqualTo(IsCurrent,true)" in text and "AddressLine" not in text


def test_scd2_shuffles_the_target_once(spark, tmp_path):
    scd2.stage(b.patients(spark, SF)).write.parquet(str(tmp_path / "v"))
    batch = b.as_text(b.patients_second_load(spark, SF)).withColumn("UpdatedTimestamp", F.col("UpdatedTimestamp").cast("timestamp"))
    text = simple(scd2.apply_scd2(spark.read.parquet(str(tmp_path / "v")), batch.drop("DateOfBirth")))
    assert text.count("Exchange hashpartitioning") == 1 and text.count("+- Sort ") == 1


def test_as_of_is_no_nested_loop_and_no_pair_join(spark):
    facts = b.table(spark, SF, "orders").select("o_orderkey", F.col("o_custkey").alias("user_id"), F.col("o_orderdate").alias("at"))
    log = b.changelog(spark, SF).withColumn(scd2.END, scd2.open_end())
    args = (facts, log, "user_id", "at", scd2.START, scd2.END, ["event_type"])
    merged = simple(joins.as_of(*args, broadcast_bytes=0))
    assert "NestedLoop" not in merged and "Cartesian" not in merged and "Join" not in merged
    many = simple(joins.as_of(*args, versions_per_key=1))
    assert "Join" not in many
    small = simple(joins.as_of(*args, versions_per_key=10_000))
    assert small.count("BroadcastHashJoin") == 1 and small.count("Exchange hashpartitioning") == 1
    facts_side = small[: small.index("BroadcastExchange")]
    assert "Exchange hashpartitioning" not in facts_side


@pytest.mark.parametrize("name", sorted(n for n in QUERIES if n[0] in "ajpwou" and not n.startswith(("a02_from", "j01", "j10", "p06"))))
def test_no_cartesian_products(spark, name):
    text = simple(QUERIES[name](spark, SF))
    assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text


def test_replicated_is_bounded(spark):
    facts, dim = spark.range(100).withColumnRenamed("id", "k"), spark.range(50).select(F.col("id").alias("k"), F.lit(1).alias("v"))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        small = facts.join(joins.replicated(dim, 1_000), "k", "left")
        large = facts.join(joins.replicated(dim, 100), "k", "left")
        assert "BroadcastHashJoin" in simple(small) and "BroadcastHashJoin" not in simple(large)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_large_dimensions_are_shuffled(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        text = simple(star.fact_vitals(b.vitals(spark, SF), b.dim_patient(spark, SF)))
        assert "SortMergeJoin" in text
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_bucketed_join_has_no_shuffle(spark, tmp_path):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        for name in ("t_one", "t_two"):
            layout.write_bucketed(spark.range(1000).select(F.col("id").cast("string").alias("k")), name, str(tmp_path / name), "k", 4)
        joined = spark.table("t_one").join(spark.table("t_two"), "k").groupBy("k").count()
        assert "Exchange" not in simple(joined)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        for name in ("t_one", "t_two"):
            spark.sql(f"DROP TABLE IF EXISTS {name}")


def test_clustering_splits_one_hot_value(spark, tmp_path):
    rows = spark.range(10000).select(F.lit("ICU").alias("kind"), F.lit(1).alias("t"), F.col("id"))
    sizes = layout.cluster_by(rows, ["kind", "t"], 4, "id").groupBy(F.spark_partition_id()).count().collect()
    assert len(sizes) == 4 and max(r["count"] for r in sizes) < 5000


def test_facts_keep_their_rows(spark):
    encounters = b.encounters(spark, SF)
    assert b.fact_encounters(spark, SF).count() == encounters.count()
    assert b.fact_vitals(spark, SF).count() == b.vitals(spark, SF).count()


def test_groups_add_up_to_the_whole(spark):
    fact, departments = b.fact_encounters(spark, SF, ["DepartmentSK"]), b.dim_department(spark, SF)
    parts = marts.encounter_summary(fact, departments).agg(F.sum("TotalEncounters")).first()[0]
    assert parts == fact.count()


def test_contracts_of_gold(spark):
    facts = b.fact_vitals(spark, SF)
    assert [(f.name, f.dataType) for f in facts.schema] == [(c.name, c.kind) for c in contracts.FACT_VITALS]
