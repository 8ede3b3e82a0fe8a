"""A corpus pipeline of the training-data operators: each stage works on all that the one before kept.

1. language: documents without a letter are rejected; a missing language is filled in with the predicted one.
2. near_duplicates: documents are linked from a similarity of 0.8 on, and of each group one row stays, that with the smallest
   id. Rows count by themselves: repeated rows and rows without id are grouped by their text like any other.
3. suffix_dedup: every byte of a 256-byte string that occurs more than once is removed; a character that lost some of its bytes
   goes with them. 51 words of four letters and the spaces between them take 254 bytes, so the window reaches passages of over 50
   words (op1 has a contract of its own, 400). A document may end up empty and then stays as an empty one.
4. personal_data: spans are replaced by their kind.
5. packing: the documents' tokens are packed into sequences.

Stages 1 to 4 return the columns of documents, with n_chars counted anew where the text changed.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from strataflow.llm import langid, minhash, packing, pii, suffix
from strataflow.llm.common import fresh, ship
from strataflow.llm.components import stored
from strataflow.llm.queries import held_out

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")
# Hundredths of their common shingles from which documents are linked; op3 has a contract of its own, 85.
SIMILAR = 80
# Bytes of the repeated strings that stage 3 removes.
WINDOW = 256


def _with_text(docs: DataFrame, text) -> DataFrame:
    """The columns of documents with another text; a null text stays null and keeps its count."""
    changed = docs.withColumn("text", text)
    return changed.withColumn("n_chars", F.coalesce(F.length("text").cast("long"), F.col("n_chars"))).select(*COLUMNS)


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    ship(spark)
    model = langid.train(docs.where(~F.coalesce(held_out(), F.lit(False))))
    judged = langid.predict(docs, model).where("has_letters")
    known = F.when(F.col("lang_pred") != langid.UNKNOWN, F.col("lang_pred"))
    return judged.withColumn("lang", F.coalesce("lang", known)).select(*COLUMNS)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    ship(spark)
    row = fresh(docs, "row")
    # Ids may be missing or repeat, so rows are numbered; the numbers are written, as a second reading could give others.
    numbered = stored(docs.withColumn(row, F.monotonically_increasing_id()), "numbered")
    order = F.struct(F.col("doc_id").isNull(), "doc_id", F.xxhash64(*COLUMNS), row)
    grouped = minhash.near_duplicates(numbered.withColumn("order", order), row, threshold=SIMILAR)
    first = grouped.groupBy("component_id").agg(F.min("order").alias("order")).select(F.col(f"order.{row}").alias(row))
    return numbered.join(first, row, "left_semi").select(*COLUMNS)


def suffix_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    ship(spark)
    return _with_text(suffix.remove_from_text(docs, window=WINDOW), F.when(F.col("text").isNotNull(), F.col("kept_text")))


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    ship(spark)
    redacted = pii.redact(docs)
    return _with_text(redacted, F.col("text"))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    ship(spark)
    return packing.pack(packing.pieces(docs, public_tokenizers.path("word_bpe_49k.json")))


STAGES = [
    ("language", language), ("near_duplicates", near_duplicates), ("suffix_dedup", suffix_dedup),
    ("personal_data", personal_data), ("packing", pack),
]

# Language models, token ids and the packing plan are beyond SQL; tests compare each stage with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
