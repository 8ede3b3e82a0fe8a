"""Near duplicates against brute force over all pairs."""

import random

import numpy as np
import pytest

from strataflow.llm import minhash
from strataflow.llm.components import components

SCHEMA = "doc_id long, text string, kept string, bucket int"


def sets_of(docs):
    out = []
    for text in docs:
        words = (text or "").encode().lower().split()
        size = min(5, len(words))
        out.append({tuple(words[i : i + size]) for i in range(len(words) - size + 1)} if words else set())
    return out


def brute(ids, docs):
    sets, parent = sets_of(docs), list(range(len(docs)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(len(docs)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if both and 100 * both >= 85 * (len(sets[i]) + len(sets[j]) - both):
                a, b = root(i), root(j)
                parent[max(a, b, key=lambda k: ids[k])] = min(a, b, key=lambda k: ids[k])
    return sets, [ids[root(i)] for i in range(len(docs))]


def corpus():
    rng = random.Random(5)
    word = lambda: rng.choice("abcdefghijklmnopqrstuvwxyz") + str(rng.randint(0, 99))
    docs = [None, "", "  \n", "One two", "one TWO", "one two three", "É a b c d e", "é a b c d e"]
    for size in (8, 30, 60, 150, 400):
        for _ in range(6):
            base = [word() for _ in range(size)]
            docs.append(" ".join(base))
            text = list(base)
            # A chain of edits: neighbours are similar, the ends need not be.
            for _ in range(10):
                text = list(text)
                for _ in range(rng.randint(1, max(1, size // 80))):
                    text[rng.randrange(size)] = word()
                docs.append("\t".join(text))
            docs.append(" ".join(base).upper())
            docs.append(" ".join(base[: size // 2] + [word() for _ in range(size // 2)]))
    hot = [word() for _ in range(200)]
    for _ in range(150):
        text = list(hot)
        for _ in range(rng.randint(0, 6)):
            text[rng.randrange(200)] = word()
        docs.append(" ".join(text))
    ids = rng.sample(range(10_000), len(docs))
    return ids, docs


def test_components_equal_brute_force(spark):
    ids, docs = corpus()
    sets, wanted = brute(ids, docs)
    df = spark.createDataFrame([(i, t, "x", 1) for i, t in zip(ids, docs, strict=True)], SCHEMA).repartition(5)
    got = {r["doc_id"]: r for r in minhash.near_duplicates(df).collect()}
    assert len(got) == len(docs)
    for i, own, component in zip(ids, sets, wanted, strict=True):
        assert (got[i]["n_shingles"], got[i]["component_id"], got[i]["kept"]) == (len(own), component, i == component)
        assert got[i]["bucket"] == 1


def test_blocks_of_a_large_bucket(spark, monkeypatch):
    """Chains of edits far from both leaders, with buckets cut into many blocks."""
    monkeypatch.setattr(minhash, "BLOCK", 8)
    monkeypatch.setattr(minhash, "TASK_ROWS", 50)
    rng = random.Random(9)
    word = lambda: "".join(rng.choices("abcdefghij", k=6))
    base = [word() for _ in range(300)]
    docs = []
    for _ in range(12):
        text = list(base)
        for _ in range(rng.randint(10, 14)):
            text[rng.randrange(300)] = word()
        for _ in range(8):
            text = list(text)
            text[rng.randrange(300)] = word()
            docs.append(" ".join(text))
    ids = rng.sample(range(5_000), len(docs))
    _, wanted = brute(ids, docs)
    df = spark.createDataFrame([(i, t, "x", 1) for i, t in zip(ids, docs, strict=True)], SCHEMA)
    got = {r["doc_id"]: r["component_id"] for r in minhash.near_duplicates(df).collect()}
    assert got == dict(zip(ids, wanted, strict=True))
    assert 1 < len(set(wanted)) < len(ids)


def test_empty_nulls_and_repeats(spark):
    assert minhash.near_duplicates(spark.createDataFrame([], SCHEMA)).count() == 0
    rows = [(None, "a b c", "x", 1), (None, "a b", "x", 1), (4, "a b c", "x", 1), (4, "a b c", "x", 1), (9, "A b c", "x", None)]
    got = minhash.near_duplicates(spark.createDataFrame(rows, SCHEMA)).collect()
    assert sorted(((r["doc_id"] or 0), r["component_id"], r["kept"]) for r in got if r["doc_id"]) == [
        (4, 4, True), (4, 4, True), (9, 4, False)
    ]
    assert [(r["component_id"], r["kept"]) for r in got if r["doc_id"] is None] == [(None, True)] * 2


def test_estimate_is_near_similarity(spark):
    rng = np.random.default_rng(3)
    rows = []
    for similarity in (0.3, 0.6, 0.85, 0.95):
        for _ in range(20):
            shared, own = int(2000 * similarity), int(1000 * (1 - similarity))
            base = rng.integers(0, 1 << 63, shared + 2 * own, dtype=np.uint64)
            sigs = [
                minhash.signature(minhash.minima(np.unique(s))).tolist() for s in (base[: shared + own], np.delete(base, slice(shared, shared + own)))
            ]
            rows.append((shared / (shared + 2 * own), *sigs))
    df = spark.createDataFrame(rows, "truth double, a array<long>, b array<long>")
    got = df.select("truth", minhash.estimated_similarity(df["a"], df["b"]).alias("e")).collect()
    assert max(abs(r["truth"] - r["e"]) for r in got) < 0.2
    assert abs(np.mean([r["truth"] - r["e"] for r in got])) < 0.02


@pytest.mark.parametrize("links", [[], [(2, 1), (3, 2), (4, 3), (5, 4), (9, 8), (8, 9), (7, 7)], [(k, k + 1) for k in range(60)]])
def test_components(spark, links):
    got = dict(components(spark.createDataFrame(links, "a long, b long")).collect())
    parent = {n: n for link in links if link[0] != link[1] for n in link}
    for _ in parent:
        for a, b in links:
            if a != b:
                parent[a] = parent[b] = min(parent[a], parent[b])
    assert got == parent


@pytest.mark.parametrize("heavy", [False, True])
def test_groups_of_a_large_bucket_are_bounded(spark, monkeypatch, heavy):
    """What a task loads at once does not grow with the number of blocks; long sets make smaller blocks."""
    monkeypatch.setattr(minhash, "BLOCK", 8 if not heavy else 1000)
    monkeypatch.setattr(minhash, "TASK_ROWS", 32 if not heavy else 4000)
    monkeypatch.setattr(minhash, "BLOCK_BYTES", 8 << 20 if not heavy else 8 * 1100, raising=False)
    monkeypatch.setattr(minhash, "TASK_BYTES", 32 << 20 if not heavy else 32 * 1100, raising=False)
    # One bucket of 400 members and 100 of two.
    rows = [(1, k) for k in range(400)] + [(10 + k // 2, 1000 + k) for k in range(200)]
    rows = [(*r, r[1], 1, [1, 2], [r[0], 7], bytearray(1000 if heavy else 8)) for r in rows]
    df = spark.createDataFrame(rows, "bucket long, rep long, component long, n int, sig array<long>, bands array<long>, shingles binary")

    def work(table):
        # A piece of a group begins where the pieces before it end.
        rep = table.column("rep")
        bucket, end = table.column("bucket")[0].as_py(), rep.chunk(0).offset + len(rep)
        return iter([(bucket, r) for r in rep.to_pylist()] + [(-1, end)])

    got = minhash._within_buckets(df, work, ("bucket", "rep")).collect()
    assert max(r["rep"] for r in got if r["bucket"] == -1) <= 100
    assert {(r["bucket"], r["rep"]) for r in got if r["bucket"] != -1} == {r[:2] for r in rows}
