"""The pipeline against a plain version of each stage."""

import random
import re

import public_tokenizers
import pytest
from tokenizers import Tokenizer

import corpus_pipeline
from strataflow.llm.components import stored
from test_minhash import brute as brute_components, sets_of
from test_pii import PATTERNS, good
from test_repeats import brute as brute_windows

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def corpus():
    rng = random.Random(11)
    word = lambda: "".join(rng.choices("abcdefghij", k=rng.randint(2, 9)))
    rows = [(100, None), (101, ""), (102, "123 !! 4111111111111111"), (103, "Kurz"), (103 + 1, "kurz")]
    shared = " ".join(word() for _ in range(90)) + " é"
    for i in range(30):
        base = [word() for _ in range(rng.randint(20, 160))]
        rows.append((200 + 3 * i, " ".join(base)))
        edited = list(base)
        edited[0] = "edit"
        rows.append((201 + 3 * i, " ".join(edited)))
        if i % 3 == 0:
            rows.append((202 + 3 * i, " ".join(base[:9] + [word(), "ééé" + shared] + [word() for _ in range(150)])))
    rows.append((300, "mail a.b@c.example and 10.1.2.3 or +49 (30) 123456-78 " + " ".join(word() for _ in range(40))))
    return [(i, t, rng.choice(["en", "de", None]), f"src{i % 3}", len(t or "")) for i, t in rows]


def text_without_repeats(texts):
    rows, masks = brute_windows(texts, corpus_pipeline.WINDOW, lambda b: list(b))
    out = []
    for text, mask in zip(texts, masks, strict=True):
        at, kept = 0, []
        for c in text:
            size = len(c.encode())
            if not any(mask[at : at + size]):
                kept.append(c)
            at += size
        out.append("".join(kept))
    return out


def redacted(text):
    spans = [(m.start(), m.end(), k) for k, p in PATTERNS.items() for m in re.finditer(p, text) if good(k, m[0])]
    out, at = "", 0
    for a, b, kind in sorted(spans, key=lambda s: (s[0], -s[1])):
        if a >= at:
            out += text[at:a] + f"[{kind.upper()}]"
        at = max(at, b)
    return out + text[at:]


@pytest.fixture(scope="module")
def stages(spark, tmp_path_factory):
    sf_dir = str(tmp_path_factory.mktemp("sf"))
    spark.createDataFrame(corpus(), SCHEMA).repartition(3).write.parquet(f"{sf_dir}/documents.parquet")
    docs, out = spark.read.parquet(f"{sf_dir}/documents.parquet"), []
    for name, stage in corpus_pipeline.STAGES:
        docs = stored(stage(spark, docs, sf_dir), name)
        out.append([r.asDict() for r in docs.collect()])
    return sf_dir, out


def test_each_stage(stages):
    _, (language, near, suffixes, private, packed) = stages
    rows = {r[0]: r for r in corpus()}
    kept = {i for i, r in rows.items() if any(map(str.isalpha, r[1] or ""))}
    assert {r["doc_id"] for r in language} == kept
    assert all(r["text"] == rows[r["doc_id"]][1] and r["lang"] == (rows[r["doc_id"]][2] or r["lang"]) for r in language)
    assert all(r["lang"] in ("en", "de") for r in language)
    ids = sorted(kept)
    _, components = brute_components(ids, [rows[i][1] for i in ids])
    first = sorted(i for i, c in zip(ids, components, strict=True) if i == c)
    assert sorted(r["doc_id"] for r in near) == first and len(first) < len(ids)
    texts = text_without_repeats([rows[i][1] for i in first])
    assert {r["doc_id"]: r["text"] for r in suffixes} == dict(zip(first, texts, strict=True))
    assert any(t != rows[i][1] for i, t in zip(first, texts, strict=True))
    clean = {i: redacted(t) for i, t in zip(first, texts, strict=True)}
    assert {r["doc_id"]: r["text"] for r in private} == clean
    assert all(r["n_chars"] == len(r["text"]) for r in private)
    model = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    lengths = {i: len(model.encode(t, add_special_tokens=False).ids) + 1 for i, t in clean.items()}
    found = {}
    for r in packed:
        found[r["doc_id"]] = found.get(r["doc_id"], 0) + r["length"]
    assert found == lengths


def test_columns_and_run(spark, stages):
    sf_dir, out = stages
    assert all(set(r) == set(corpus_pipeline.COLUMNS) for rows in out[:4] for r in rows)
    got = sorted((r["doc_id"], r["piece"], r["ids_crc32"]) for r in corpus_pipeline.run(spark, sf_dir).collect())
    assert got == sorted((r["doc_id"], r["piece"], r["ids_crc32"]) for r in out[-1])


def test_empty_table(spark, tmp_path):
    spark.createDataFrame([], SCHEMA).write.parquet(f"{tmp_path}/documents.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0


def test_repeated_rows_and_missing_ids_keep_one_text(spark, tmp_path):
    """Long texts that were loaded twice or have no id come out once, and whole."""
    rng = random.Random(23)
    texts = [" ".join("".join(rng.choices("abcdefghij", k=rng.randint(2, 9))) for _ in range(150)) for _ in range(6)]
    near = f"edit {texts[5]}"
    rows = [(1, texts[0]), (1, texts[0]), (None, texts[1]), (None, texts[1]), (2, texts[2]), (None, texts[2]), (3, texts[3]), (3, texts[4])]
    rows += [(None, near), (7, texts[5]), (None, near)]
    docs = spark.createDataFrame([(i, t, "en", "s", len(t)) for i, t in rows], SCHEMA).repartition(4)
    near_rows = stored(corpus_pipeline.near_duplicates(spark, docs, str(tmp_path)), "near")
    wanted = sorted([(1, texts[0]), (0, texts[1]), (2, texts[2]), (3, texts[3]), (3, texts[4]), (7, texts[5])])
    assert sorted((r["doc_id"] or 0, r["text"]) for r in near_rows.collect()) == wanted
    left = corpus_pipeline.suffix_dedup(spark, near_rows, str(tmp_path)).collect()
    assert sorted((r["doc_id"] or 0, r["text"]) for r in left) == wanted


def test_passages_of_over_50_words_go(spark, tmp_path):
    """Passages of 51 to 60 words in otherwise different documents are removed, clean documents stay as they are."""
    rng = random.Random(37)
    word = lambda: "".join(rng.choices("abcdefghij", k=rng.randint(4, 8)))
    passages = [" ".join(word() for _ in range(rng.randint(51, 60))) for _ in range(6)]
    clean = [" ".join(word() for _ in range(200)) for _ in range(10)]
    holding = [f"{word()} {word()} {passages[i % 6]} {' '.join(word() for _ in range(100))}" for i in range(18)]
    rows = [(i, t, "en", "s", len(t)) for i, t in enumerate(clean + holding)]
    got = {r["doc_id"]: r for r in corpus_pipeline.suffix_dedup(spark, spark.createDataFrame(rows, SCHEMA).repartition(4), "").collect()}
    assert all(got[i]["text"] == t for i, t in enumerate(clean))
    for i, text in enumerate(holding, len(clean)):
        left = got[i]["text"]
        assert passages[(i - len(clean)) % 6][20:-20] not in left and left.endswith(text[-300:]) and got[i]["n_chars"] == len(left)


def test_near_duplicates_from_80_on(spark, tmp_path):
    """Pairs on both sides of 0.8 and 0.85, the first documents of groups by brute force."""
    rng = random.Random(31)
    word = lambda: "".join(rng.choices("abcdefghij", k=6))
    docs = []
    for _ in range(40):
        base = [word() for _ in range(rng.choice([104, 204, 404]))]
        edited = list(base)
        for k in range(rng.randint(1, len(base) // 35)):
            edited[10 + 12 * k] = word()
        docs += [" ".join(base), " ".join(edited)]
    sets, linked, at = sets_of(docs), {}, set()
    for i in range(0, len(docs), 2):
        both = len(sets[i] & sets[i + 1])
        union = len(sets[i] | sets[i + 1])
        linked[i + 1] = 100 * both >= 80 * union
        at.add((100 * both >= 80 * union, 100 * both >= 85 * union))
    assert at == {(False, False), (True, False), (True, True)}
    rows = spark.createDataFrame([(i, t, "en", "s", len(t)) for i, t in enumerate(docs)], SCHEMA).repartition(4)
    got = {r["doc_id"] for r in corpus_pipeline.near_duplicates(spark, rows, str(tmp_path)).collect()}
    assert got == {i for i in range(len(docs)) if not linked.get(i)}
