"""Vector tables as blocks: bounded groups of rows whose vectors are one binary value, for numpy work inside tasks."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

BLOCK = "{key} int, ids binary, vectors binary, width int"


def finite(col: Column, kind: str = "double") -> Column:
    """Whether a vector of ``kind`` (float or double) is there, has components, and holds no null, NaN or infinity."""
    most = F.lit(float("inf")).cast(kind)
    # The last is NULL where a component is; NaN is above infinity.
    good = (F.array_max(col) < most) & (F.array_min(col) > -most) & ~F.array_contains(col, most)
    return F.coalesce(col.isNotNull() & (F.size(col) > 0) & good, F.lit(False))


def taking_part(df: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """(id, vector) of the rows that take part, ids as often as they come; the vector is of floats as it is, else of doubles."""
    kind = df.select(vector_col).schema[0].dataType.elementType.simpleString()
    vector = F.col(vector_col)
    if kind not in ("float", "double"):
        kind, vector = "double", F.transform(vector, lambda x: x.cast("double"))
    return df.where(F.col(id_col).isNotNull()).select(F.col(id_col).cast("long").alias("id"), vector.alias("vector")).where(
        finite(F.col("vector"), kind)
    )


def smallest(rows: DataFrame) -> DataFrame:
    """One row per id, with its smallest vector."""
    return rows.groupBy("id").agg(F.min("vector").alias("vector"))


def usable(df: DataFrame, id_col: str, vector_col: str, nonzero: bool) -> DataFrame:
    """(id, vector of doubles) of the rows that take part; of rows with one id the smallest vector counts."""
    rows = taking_part(df, id_col, vector_col).withColumn("vector", F.transform("vector", lambda x: x.cast("double")))
    if nonzero:
        rows = rows.where(F.exists("vector", lambda x: x != 0))
    return smallest(rows)


def blocks(rows: DataFrame, key: str, number: int, kind: str = "f8") -> DataFrame:
    """Deal (id, vector) rows into ``number`` blocks by a hash of the id; rows of a block are ordered by id.

    Shorter vectors are filled with zeros to the longest one of the block.
    """

    def pack(table: pa.Table) -> pa.Table:
        ids = table.column("id").to_numpy()
        order = np.argsort(ids, kind="stable")
        lists = table.column("vector").combine_chunks()
        sizes = np.diff(lists.offsets.to_numpy())
        width = int(sizes.max())
        dense = np.zeros((len(ids), width), kind)
        dense[np.arange(width) < sizes[:, None]] = lists.flatten().to_numpy()
        return pa.table([
            pa.array([table.column(key)[0].as_py()], pa.int32()), pa.array([ids[order].astype("<i8").tobytes()], pa.binary()),
            pa.array([dense[order].tobytes()], pa.binary()), pa.array([width], pa.int32()),
        ], names=[key, "ids", "vectors", "width"])

    dealt = rows.withColumn(key, F.pmod(F.xxhash64("id"), F.lit(number)).cast("int"))
    return dealt.groupBy(key).applyInArrow(lambda table: pack(table), BLOCK.format(key=key))


def read_block(ids: bytes, vectors: bytes, width: int, kind: str = "f8") -> tuple[np.ndarray, np.ndarray]:
    return np.frombuffer(ids, "<i8"), np.frombuffer(vectors, kind).reshape(-1, width)


def same_width(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Fill the narrower of two blocks with zeros."""
    width = max(a.shape[1], b.shape[1])
    return tuple(x if x.shape[1] == width else np.pad(x, ((0, 0), (0, width - x.shape[1]))) for x in (a, b))


def meet(parts: DataFrame, queries: DataFrame, key: str, number: int) -> DataFrame:
    """Every query block beside every part: the queries are copied to each of the ``number`` parts and joined there."""
    spread = queries.select(
        F.col("ids").alias("query_ids"), F.col("vectors").alias("query_vectors"), F.col("width").alias("query_width"),
        F.explode(F.sequence(F.lit(0), F.lit(number - 1))).alias(key),
    )
    return parts.join(spread, key)


def best(found: DataFrame, k: int, score_type: str) -> DataFrame:
    """The ``k`` highest scores of each query, ties to the smaller id, ranked from 1."""
    order = Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select(
        "query_id", F.col("rank").cast("int").alias("rank"), "vec_id", F.col("score").cast(score_type).alias("score")
    )

