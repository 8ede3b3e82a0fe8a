"""Registered queries of this subpackage and their oracle SQL."""

from __future__ import annotations

from functools import wraps

import public_tokenizers
from pyspark.sql import DataFrame, functions as F

from . import ann, bpe, divergence, langid, licenses, minhash, oracles, packing, pii, ranked, substring, suffix, topk, wrappers
from .common import read_table, sha256_hex, ship

QUERIES = {}
ORACLES = {}

HOLDOUT_FOLDS = 5


def query(fn=None, *, sql: str | None = None):
    """Register a query under its function's name, with SQL for its result where SQL can express it."""
    if fn is None:
        return lambda f: query(f, sql=sql)

    @wraps(fn)
    def run(spark, sf_dir: str) -> DataFrame:
        ship(spark)
        return fn(spark, sf_dir)

    QUERIES[fn.__name__] = run
    if sql:
        ORACLES[fn.__name__] = sql
    return run


@query(sql=oracles.SUFFIX_DEDUP)
def op1_suffix_dedup(spark, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    return suffix.remove_repeats(docs).select(
        "doc_id", "n_bytes", "n_removed", "n_spans", sha256_hex(F.col("kept")).alias("kept_sha256")
    )


@query
def op2_pii(spark, sf_dir: str) -> DataFrame:
    found = pii.find(read_table(spark, sf_dir, "documents").select("doc_id", "text"))
    return found.select(
        "doc_id", *[pii.count_of(F.col("pii"), k).alias(f"n_{k}") for k in pii.KINDS],
        sha256_hex(pii.span_text(F.col("pii"), pii.BASE_KINDS)).alias("base_sha256"),
        pii.span_text(F.col("pii"), pii.KINDS).alias("spans"),
    )


@query(sql=oracles.NEAR_DUPLICATES)
def op3_near_duplicates(spark, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    return minhash.near_duplicates(docs).select("doc_id", "n_shingles", "component_id", "kept")


@query
def op4_nearest(spark, sf_dir: str) -> DataFrame:
    return ann.nearest(read_table(spark, sf_dir, "embeddings"), F.col("id") % 20 == 0)


@query
def op5_bpe(spark, sf_dir: str) -> DataFrame:
    ranks, pattern = public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    encoded = bpe.encode(docs, ranks, pattern).select("doc_id", "ids")
    return bpe.decode(encoded, ranks, pattern).select(
        "doc_id", F.size("ids").cast("long").alias("n_tokens"),
        sha256_hex(F.array_join("ids", ",")).alias("ids_sha256"), sha256_hex(F.col("decoded")).alias("decoded_sha256"),
    )


@query(sql="""
    WITH usable AS (
        SELECT vec_id, list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS terms
        FROM embeddings
        WHERE vec_id IS NOT NULL AND len(embedding) > 0
          AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    ), scored AS (
        SELECT q.vec_id AS query_id, d.vec_id, CAST(list_inner_product(q.terms, d.terms) AS BIGINT) AS score
        FROM usable q JOIN usable d ON q.vec_id % 50 = 0 AND q.vec_id <> d.vec_id
    ), ranked AS (
        SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank FROM scored
    )
    SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 5
""")
def op6_top_k(spark, sf_dir: str) -> DataFrame:
    return topk.top_k(read_table(spark, sf_dir, "embeddings"), F.col("id") % 50 == 0)


@query
def op7_packing(spark, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    return packing.pack(packing.pieces(docs, public_tokenizers.path("word_bpe_49k.json")))


@query(sql=licenses.documents_sql())
def op8_licenses(spark, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    # Documents have no file names, so every one that holds a licence notice speaks for its directory.
    return licenses.scan(docs, licenses.documents_path(), F.lit(True)).select(
        "doc_id", "license", "origin", "similarity"
    )


def held_out(id_col: str = "doc_id"):
    return F.pmod(F.crc32(F.col(id_col).cast("string").cast("binary")), F.lit(HOLDOUT_FOLDS)) == 0


@query
def op9_langid(spark, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    model = langid.train(docs.where(~F.coalesce(held_out(), F.lit(False))))
    return langid.predict(docs.select("doc_id", "text"), model).select(
        "doc_id", F.coalesce(held_out(), F.lit(False)).alias("held_out"), "lang_pred", "score"
    )


@query(sql=oracles.SUBSTRING_DEDUP)
def op10_substring_dedup(spark, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    return substring.remove_repeats(docs).select(
        "doc_id", "n_words", "n_removed", sha256_hex(F.col("kept")).alias("kept_sha256")
    )


@query(sql=oracles.SOURCE_DIVERGENCE)
def op12_source_divergence(spark, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("text", "lang", "source")
    return divergence.audit(docs).select("lang", "source", "part", "item", "value", "rank")


@query(sql=oracles.RANKED_SEARCH)
def op13_ranked_search(spark, sf_dir: str) -> DataFrame:
    docs, items = (read_table(spark, sf_dir, name) for name in ("documents", "benchmark"))
    return ranked.rank_documents(docs.select("doc_id", "text"), items.select("item_id", "text"))


@query
def op11_main_text(spark, sf_dir: str) -> DataFrame:
    pages = read_table(spark, sf_dir, "pages").select("page_id", "url", "html")
    return wrappers.extract(pages).select("page_id", "url", "text", "n_chars")
