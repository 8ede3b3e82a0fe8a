"""Language identification: held-out accuracy, mixtures and odd input."""

import numpy as np
import pyarrow.dataset as ds
import pytest

from strataflow.llm import langid, queries

SF = "/root/testdata/sf0.01"
SCHEMA = "doc_id long, text string, lang string, score string"


def test_held_out_accuracy(spark):
    rows = ds.dataset(f"{SF}/documents.parquet").to_table(columns=["doc_id", "lang"]).to_pylist()
    truth = {r["doc_id"]: r["lang"] for r in rows}
    got = queries.QUERIES["op9_langid"](spark, SF).collect()
    assert len(got) == len(truth)
    judged = [r["lang_pred"] == truth[r["doc_id"]] for r in got if r["held_out"]]
    assert len(judged) > 150 and np.mean(judged) >= 0.97
    assert all(0 <= r["score"] <= 1 for r in got)


TEXTS = {
    "en": "the cat and the dog went to the house with the other animals of the town and there they were happy",
    "de": "der hund und die katze gingen zum haus mit den anderen tieren der stadt und dort waren sie zufrieden",
}


@pytest.fixture(scope="module")
def model(spark):
    rows = [(i, f"{text} {i}", lang, "s") for i in range(20) for lang, text in TEXTS.items()]
    rows += [(90, None, "en", "s"), (91, TEXTS["de"], None, "s"), (92, "", "de", None)]
    return langid.train(spark.createDataFrame(rows, SCHEMA))


def test_counts_cover_all_rows(model):
    names, logs = model
    assert names == ["de", "en"]
    counts = {lang: np.full(langid.SLOTS, 0.5) for lang in names}
    for i in range(20):
        for lang, text in TEXTS.items():
            np.add.at(counts[lang], langid.ngram_slots(f"{text} {i}"), 1)
    np.add.at(counts["de"], langid.ngram_slots(""), 1)
    for lang, own in zip(names, logs, strict=True):
        assert np.allclose(own, np.log(counts[lang] / counts[lang].sum()), atol=1e-4)


def test_mixture(model):
    names, logs = model
    assert [x[0] for x in langid.analyse(TEXTS["en"], names, logs)] == ["en"]
    both = langid.analyse(f"{TEXTS['en']} {TEXTS['de']} {TEXTS['de']}", names, logs)
    assert [x[0] for x in both] == ["de", "en"] and abs(both[0][1] - 2 / 3) < 0.1
    assert abs(sum(x[1] for x in both) - 1) < 1e-6


def test_em_raises_likelihood():
    like = np.random.default_rng(1).uniform(0.01, 1, (4, 50))
    weight = np.ones(50)
    fits = [langid.mixture(like, weight, rounds)[1] for rounds in range(1, 10)]
    assert all(b >= a - 1e-9 for a, b in zip(fits, fits[1:], strict=False))


def test_odd_rows(spark, model):
    rows = [(1, None, None, "s"), (2, "", "en", "s"), (3, "12 34 !?", "en", "s"), (4, "the dog " * 20_000, "zz", "s"), (4, "the dog " * 20_000, "zz", "s")]
    df = spark.createDataFrame(rows, SCHEMA)
    got = langid.predict(df, model).collect()
    assert [(r["doc_id"], r["lang_pred"], r["has_letters"]) for r in sorted(got, key=lambda r: r["doc_id"])] == [
        (1, "und", False), (2, "und", False), (3, "und", False), (4, "en", True), (4, "en", True)
    ]
    assert {r["score"] for r in got if r["doc_id"] < 4} == {0.0}
    assert langid.predict(df.limit(0), model).count() == 0
    nothing = langid.train(df.limit(0))
    assert [r["lang_pred"] for r in langid.predict(df, nothing).collect()] == ["und"] * 5
