"""Source divergence against plain Python on whole and odd tables."""

import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest

from strataflow.llm import divergence

SCHEMA = "text string, lang string, source string, term string, n int"
TERM = re.compile("[^\x00-\x40\x5B-\x60\x7B-\x7F]+")


def lower(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)


def brute(rows, min_docs=10, k=10):
    groups, docs = defaultdict(Counter), defaultdict(Counter)
    for text, lang, source in rows:
        found = TERM.findall(lower(text or ""))
        groups[lang or "", source or ""].update(found)
        docs[lang or ""].update(set(found))
    out = []
    for lang in {g[0] for g in groups}:
        kept = [t for t, n in docs[lang].items() if n >= min_docs]
        own = {s: c for (l, s), c in groups.items() if l == lang}

        def shares(count):
            total = sum(count[t] for t in kept)
            return {t: 1 + 10**9 * (count[t] + 2) // (total + 2 * len(kept)) for t in kept}

        p = {s: shares(c) for s, c in own.items()}
        q = shares(sum(own.values(), Counter()))
        f = lambda a, b: (a - b) ** 2 // (a + b)
        for s in own:
            pairs = [(sum(f(p[s][t], p[o][t]) for t in kept), o) for o in own if o != s]
            terms = [(f(p[s][t], q[t]), t) for t in kept if own[s][t] and p[s][t] > q[t]]
            for part, found, limit in (("pair", pairs, None), ("term", terms, k)):
                ranked = sorted(found, key=lambda x: (-x[0], x[1].encode()))[:limit]
                out += [(lang, s, part, item, value, i) for i, (value, item) in enumerate(ranked, 1)]
    return sorted(out)


def run(spark, rows, **options):
    df = spark.createDataFrame([(*r, "x", 1) for r in rows], SCHEMA).repartition(3)
    return sorted(map(tuple, divergence.audit(df, **options).collect()))


def corpus(seed, n):
    rng = random.Random(seed)
    vocabulary = [rng.choice(["", "é", "日", "Ä"]) + "".join(rng.choices("abCD", k=rng.randint(1, 3))) for _ in range(120)]
    out = []
    for _ in range(n):
        lang, source = rng.choice(["en", "en", "de", None]), rng.choice(["hot", "hot", "b", "c", "d", "", None])
        own = vocabulary[rng.randint(0, 40) :] if source == "hot" else vocabulary[: rng.randint(1, 120)]
        out.append((rng.choice([" ", "1", "-_"]).join(rng.choices(own, k=rng.randint(0, 60))), lang, source))
    return out + [(None, "en", "none"), ("", "xx", "only"), ("rare words", "yy", "a"), ("", "yy", "b"), out[0], out[0]]


@pytest.mark.parametrize("seed,n,min_docs", [(1, 300, 10), (2, 60, 2), (3, 200, 500)])
def test_equals_brute_force(spark, seed, n, min_docs):
    rows = corpus(seed, n)
    assert run(spark, rows, min_docs=min_docs) == brute(rows, min_docs)


def test_small_pieces_everywhere(spark, monkeypatch):
    """Many flushes, bands, merges, cells and blocks give the same rows."""
    rows = corpus(4, 250)
    for name, value in {"HELD_TERMS": 50, "BAND_ROWS": 40, "FAN_IN": 2, "CELL_ROWS": 60, "BLOCK_SOURCES": 2, "MATRIX_TERMS": 7}.items():
        monkeypatch.setattr(divergence, name, value)
    assert run(spark, rows, min_docs=3, k=4) == brute(rows, 3, 4)


def test_empty_table(spark):
    assert run(spark, []) == []


def test_long_text(spark):
    text = "Aé1" * 1_500_000 + "b" * 3_000_000 + " c"
    rows = [(text, "en", "a"), ("aé b", "en", "b")]
    assert run(spark, rows, min_docs=1) == brute(rows, 1)


def test_skyband():
    rng = np.random.default_rng(1)
    for size, high in ((0, 5), (400, 4), (2000, 60), (2000, 10**6)):
        group, n, lang = rng.integers(0, 3, size), rng.integers(1, high + 1, size), rng.integers(1, high + 1, size)
        term = rng.permutation(size)
        over = (
            (group[:, None] == group) & (n[:, None] >= n) & (lang[:, None] <= lang) & (term[:, None] < term)
        ).sum(axis=0)
        assert sorted(divergence.skyband(group, n, lang, term, 5).tolist()) == np.flatnonzero(over < 5).tolist()


def test_shares_are_exact():
    for n, whole in ((0, 1), (10**15, 10**15 + 2), (7, 10**15), (123_456_789_012_345, 987_654_321_098_765)):
        assert divergence.shares(np.array([n]), np.array([whole]))[0] == 1 + 10**9 * (n + 2) // whole
