"""Ranked search against scores of all documents."""

import math
import random
import re
from collections import Counter

import numpy as np
import pytest

from strataflow.llm import ranked

TERM = re.compile("[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def terms(text):
    return TERM.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))


def brute(docs, items, k=10):
    rows = [(i, Counter(terms(t))) for i, t in docs]
    rows = [(i, c, sum(c.values())) for i, c in rows if c]
    whole, total = len(rows), sum(n for _, _, n in rows)
    df = Counter(t for _, c, _ in rows for t in c)
    asked = {}
    for item, text in items:
        if item is not None:
            asked.setdefault(item, set()).update(terms(text))
    out = []
    for item, own in asked.items():
        found = []
        for doc, count, n in rows:
            m = 10 + 90 * n * whole // total
            score = sum(
                math.floor(1000 * math.log((2 * whole + 2) / (2 * df[t] + 1))) * (10**9 * count[t] // (1000 * count[t] + 8 * m))
                for t in own if t in count
            )
            if score > 0:
                found.append((-score, doc is None, doc or 0))
        out += [(item, r, None if none else doc, -s) for r, (s, none, doc) in enumerate(sorted(found)[:k], 1)]
    return sorted(out, key=lambda r: r[:2])


def run(spark, docs, items, k=10):
    d = spark.createDataFrame([(i, t, 1, "x") for i, t in docs], "doc_id long, text string, shard int, item_id string").repartition(3)
    q = spark.createDataFrame([(i, t, 2) for i, t in items], "item_id long, text string, block int")
    return sorted((tuple(r) for r in ranked.rank_documents(d, q, k).collect()), key=lambda r: r[:2])


def corpus(seed, n, size):
    rng = random.Random(seed)
    vocabulary = [rng.choice(["", "É", "日本", "7"]) + "".join(rng.choices("abXY", k=rng.randint(1, 4))) for _ in range(size)]
    # Words of very different frequencies: some in nearly all documents.
    weights = [1 / (i + 1) for i in range(size)]
    docs = [(i, " ,-"[i % 3].join(rng.choices(vocabulary, weights, k=rng.randint(0, 40)))) for i in range(n)]
    docs += [(None, docs[3][1]), (n + 5, docs[3][1]), (3, docs[3][1]), (n + 6, None), (n + 7, ""), (n + 8, "!!")]
    items = [(i, " ".join(rng.choices(vocabulary, k=rng.randint(1, 25)))) for i in range(30)]
    items += [(31, None), (32, ""), (33, "unknownword"), (None, docs[0][1]), (34, docs[5][1]), (34, docs[6][1]), (35, vocabulary[0])]
    return docs, items


@pytest.mark.parametrize("seed,n,size", [(1, 300, 80), (2, 40, 9)])
def test_equals_brute_force(spark, seed, n, size):
    docs, items = corpus(seed, n, size)
    assert run(spark, docs, items) == brute(docs, items)


def test_small_shards_and_blocks(spark, monkeypatch):
    docs, items = corpus(3, 400, 60)
    for name, value in {"SHARD_BYTES": 600, "SHARD_DOCS": 25, "ITEM_BLOCK": 4, "RANGE_DOCS": 8}.items():
        monkeypatch.setattr(ranked, name, value)
    assert run(spark, docs, items, 3) == brute(docs, items, 3)


def test_empty_tables(spark):
    docs, items = corpus(5, 20, 10)
    assert run(spark, [], items) == run(spark, docs, []) == []


def test_long_text(spark):
    docs = [(1, "Ab1é," * 900_000 + "z" * 2_500_000 + " q"), (2, "ab1é q"), (3, "w")]
    items = [(1, "AB1É"), (2, "q w"), (3, "z" * 2_500_000)]
    assert run(spark, docs, items) == brute(docs, items)


def test_search_skips_and_is_exact():
    rng = np.random.default_rng(7)
    for _ in range(30):
        n = 20_000
        lists = []
        for size in (3, 40, 500, 9_000, 15_000):
            docs = np.sort(rng.choice(n, size, replace=False))
            lists.append((docs, rng.integers(1, 10**7 // size, size)))
        every = np.zeros(n, np.int64)
        for docs, scores in lists:
            every[docs] += scores
        order = np.lexsort((np.arange(n), -every))[:10]
        docs, scores, touched = ranked.search(lists, n, 10)
        assert docs.tolist() == order.tolist() and scores.tolist() == every[order].tolist()
        assert touched < sum(len(d) for d, _ in lists) / 2


def test_length_factor_beyond_64_bits():
    lengths = np.array([10**9, 3])
    got = ranked.length_factor(lengths, 10**12, 10**15).tolist()
    assert got == [10 + 90 * n * 10**12 // 10**15 for n in (10**9, 3)]
