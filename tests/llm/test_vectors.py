"""Nearest neighbours and exact top-k against brute force."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from strataflow.llm import ann, topk

SCHEMA = "vec_id long, embedding array<float>, label int, rank string"


def table(spark, vectors, ids=None):
    ids = range(len(vectors)) if ids is None else ids
    return spark.createDataFrame([(int(i), v, 1, "r") for i, v in zip(ids, vectors, strict=True)], SCHEMA).repartition(4)


ODD = [(None, [1.0, 2.0]), (100_000, None), (100_020, []), (100_040, [1.0, None]), (100_060, [math.nan, 1.0]), (100_080, [math.inf, 1.0])]


def with_odd(spark, df):
    return df.unionByName(spark.createDataFrame([(i, v, 1, "r") for i, v in ODD], SCHEMA))


def clustered(count, width, seed):
    rng = np.random.default_rng(seed)
    centers = rng.normal(size=(20, width))
    return (centers[rng.integers(0, 20, count)] + 0.6 * rng.normal(size=(count, width))).astype(np.float32)


def test_top_k_is_exact(spark, monkeypatch):
    monkeypatch.setattr(topk, "RANGE_ROWS", 200)
    vectors = clustered(900, 8, 1)
    vectors[300:500] = vectors[0]
    df = with_odd(spark, table(spark, vectors.tolist()))
    got = {}
    for r in topk.top_k(df, F.col("id") % 50 == 0).collect():
        got.setdefault(r["query_id"], []).append((r["rank"], r["vec_id"], r["score"]))
    whole = np.floor(256 * vectors.astype(float)).astype(int)
    assert sorted(got) == list(range(0, 900, 50))
    for q, rows in got.items():
        score = whole @ whole[q]
        order = [i for i in np.lexsort((np.arange(900), -score)) if i != q][:5]
        assert sorted(rows) == [(k + 1, i, score[i]) for k, i in enumerate(order)]


def test_top_k_prunes():
    rng = np.random.default_rng(2)
    rows = np.concatenate([rng.integers(0, 5, (1000, 16)) + 100 * (k == 3) for k in range(8)])
    queries = rng.integers(1, 5, (10, 16))
    found, score, blocks = topk.search_range(-np.ones(10, int), queries, np.arange(8000), rows, 5)
    assert blocks < 10 * 63 / 3
    exact = -np.sort(-(queries @ rows.T), axis=1)[:, :5]
    assert (score == exact).all()


def test_top_k_large_values_and_few_rows(spark):
    big = [[2.0**22, 1.0], [2.0**21 + 0.5, -3.0], [5.0, 0.25]]
    got = topk.top_k(table(spark, big, [0, 1, 50]), F.col("id") % 50 == 0).collect()
    whole = [[math.floor(256 * x) for x in v] for v in big]
    dot = lambda a, b: sum(x * y for x, y in zip(whole[a], whole[b], strict=True))
    assert {(r["query_id"], r["vec_id"]): r["score"] for r in got} == {
        (0, 1): dot(0, 1), (0, 50): dot(0, 2), (50, 0): dot(2, 0), (50, 1): dot(2, 1)
    }
    assert topk.top_k(table(spark, big).limit(0), F.col("id") % 50 == 0).count() == 0


def brute_force(ids, whole, asked, k):
    """{query: [(rank, id, score)]} from integer vectors."""
    found = {}
    for q in asked:
        score = whole @ whole[list(ids).index(q)]
        order = [i for i in np.lexsort((ids, -score)) if ids[i] != q][:k]
        found[q] = [(r + 1, ids[i], score[i]) for r, i in enumerate(order)]
    return found


def by_query(rows):
    found = {}
    for r in rows:
        found.setdefault(r["query_id"], []).append((r["rank"], r["vec_id"], r["score"]))
    return {q: sorted(x) for q, x in found.items()}


def sent_to_python(df):
    """Rows of a DataFrame, and the bytes its plan handed to Python workers."""
    rows, sent, plans = df.collect(), 0, [df._jdf.queryExecution().executedPlan()]
    while plans:
        plan = plans.pop()
        kind = plan.getClass().getSimpleName()
        if kind == "AdaptiveSparkPlanExec":
            plans.append(plan.executedPlan())
        elif kind.endswith("QueryStageExec"):
            plans.append(plan.plan())
        metric = plan.metrics().get("pythonDataSent")
        sent += metric.get().value() if metric.isDefined() else 0
        plans += [plan.children().apply(i) for i in range(plan.children().size())]
    return rows, sent


def test_top_k_sends_no_range_twice(spark):
    count, width = 16_384, 16
    values = [(F.pmod(F.xxhash64("id", F.lit(j)), F.lit(1000)) / 1000 - 0.5).cast("float") for j in range(width)]
    df = spark.range(count).select(F.col("id").alias("vec_id"), F.array(values).alias("embedding"))
    rows, sent = sent_to_python(topk.top_k(df, F.col("id") % 4 == 0))
    assert len(rows) == 5 * count // 4
    # Each vector of doubles once; joined to every 512 queries a range went to Python over again.
    assert sent < 3 * count * width * 8


def test_top_k_small_pieces_and_ranges(spark, monkeypatch):
    monkeypatch.setattr(topk, "RANGE_ROWS", 60)
    rng = np.random.default_rng(6)
    ids = [int(i) for i in rng.permutation(400) - 50]
    vectors = [rng.integers(-2, 3, rng.integers(1, 6)).tolist() for _ in ids]
    whole = np.array([v + [0] * (5 - len(v)) for v in vectors]) * 256
    got = topk.top_k(table(spark, [[float(x) for x in v] for v in vectors], ids), F.col("id") % 3 == 0, k=9)
    assert by_query(got.collect()) == brute_force(ids, whole, [i for i in ids if i % 3 == 0], 9)


def test_top_k_of_repeated_ids_takes_the_smallest_vector(spark):
    ids, vectors = [0, 50, 0, 7, 7], [[0.002, 1.0], [0.5, 0.5], [0.001, 9.0], [1.0, 1.0], [0.5, 3.0]]
    got = by_query(topk.top_k(table(spark, vectors, ids), F.col("id") % 50 == 0).collect())
    whole = np.array([[0, 2304], [128, 128], [128, 768]])
    assert got == brute_force([0, 50, 7], whole, [0, 50], 5)


@pytest.mark.parametrize(("most", "kind"), [(3, np.float32), (1000, np.float32), (10**6, np.float64), (2**26, np.int64)])
def test_search_range_in_each_type(most, kind):
    rng = np.random.default_rng(most)
    rows, ids = rng.integers(-most, most + 1, (1500, 4)), np.sort(rng.choice(9000, 1500, replace=False)) - 100
    rows[200:500] = rows[0]
    rows[600:1000, 0] += most // 2
    asked = np.concatenate([rows[:40], rows[450:460], rows[900:910]])
    asked_ids = np.concatenate([ids[:40], ids[450:460], ids[900:910]])
    assert topk.exact_type(asked, topk.largest(rows), 4) is kind
    for k, block_rows in ((1, 128), (5, 7), (40, 16), (2000, 128)):
        found, score, _ = topk.search_range(asked_ids, asked, ids, rows, k, block_rows)
        exact = asked @ rows.T
        for i, q in enumerate(asked_ids):
            order = [j for j in np.lexsort((ids, -exact[i])) if ids[j] != q][:k]
            there = score[i] > topk.NONE
            assert found[i][there].tolist() == ids[order].tolist() and score[i][there].tolist() == exact[i][order].tolist()


@pytest.mark.parametrize("scaled", [False, True])
def test_nearest_recall(spark, monkeypatch, scaled):
    monkeypatch.setattr(ann, "SHARD_ROWS", 700)
    vectors = clustered(2000, 24, 3)
    if scaled:
        vectors *= np.random.default_rng(4).uniform(0.3, 3, (2000, 1)).astype(np.float32)
    vectors[700:1300] = vectors[0]
    vectors[40] = 0
    df = with_odd(spark, table(spark, vectors.tolist()))
    got = {}
    for r in ann.nearest(df, F.col("id") % 20 == 0).collect():
        got.setdefault(r["query_id"], []).append((r["rank"], r["vec_id"], r["score"]))
    assert sorted(got) == [q for q in range(0, 2000, 20) if q != 40]
    hits = 0
    for q, rows in got.items():
        rows.sort()
        score = np.array([math.fsum(a * b for a, b in zip(v.tolist(), vectors[q].tolist(), strict=True)) for v in vectors])
        order = [i for i in np.lexsort((np.arange(2000), -np.round(score, 9))) if i not in (q, 40)][:20]
        assert [r[0] for r in rows] == list(range(1, 21)) and q not in [r[1] for r in rows]
        assert all(abs(s - score[i]) < 1e-6 for _, i, s in rows)
        assert rows == sorted(rows, key=lambda r: (-r[2], r[1]))
        hits += len(set(order) & {r[1] for r in rows})
    assert hits >= 0.95 * 20 * len(got)


def test_nearest_few_rows(spark):
    got = ann.nearest(table(spark, [[1.0, 0.0], [0.5, 0.5], [0.5, 0.5, 0.25]], [0, 3, 7]), F.col("id") % 20 == 0).collect()
    assert [(r["query_id"], r["rank"], r["vec_id"], r["score"]) for r in sorted(got, key=lambda r: r["rank"])] == [
        (0, 1, 3, 0.5), (0, 2, 7, 0.5)
    ]
    assert ann.nearest(table(spark, [[1.0]]).limit(0), F.col("id") % 20 == 0).count() == 0
    assert ann.nearest(table(spark, [[1.0]]), F.col("id") % 20 == 0).count() == 0
