"""Connected components of a link table, with large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..session import scratch_path


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write a table to the shared folder and read it back, so that later steps start from there."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)


def _least(edges: DataFrame) -> DataFrame:
    return edges.groupBy("a").agg(F.min("b").alias("m"))


def _large_star(edges: DataFrame) -> DataFrame:
    """Each larger neighbour of a node is linked to the least of the node and its neighbours."""
    both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = _least(both).withColumn("m", F.least("a", "m"))
    return both.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """Each smaller neighbour of a node, and the node, are linked to the least of them."""
    down = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a > b")
    moved = down.join(_least(down), "a")
    return (
        moved.select(F.col("b").alias("a"), F.col("m").alias("b")).where("a > b")
        .unionByName(moved.select("a", F.col("m").alias("b"))).distinct()
    )


def components(links: DataFrame) -> DataFrame:
    """(node, component) for all ends of links (a, b); the component is its smallest node.

    A node keeps its links in rows, so large components are spread; each round is written, and rounds end when nothing
    changes, after a number that grows with the logarithm of the largest component.
    """
    edges, before = links.where("a <> b").select("a", "b").distinct(), None
    while True:
        edges = stored(_small_star(_large_star(edges)), "links")
        now = edges.agg(F.count("*").alias("n"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")).alias("s")).first()
        if now == before:
            break
        before = now
    return edges.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(
        edges.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
    )
