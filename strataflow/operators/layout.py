"""File layout: clustering, Z-order and bucketing."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F, types as T


# Rows that the borders of text columns are taken from.
SAMPLE_ROWS = 10_000


def cluster_by(df: DataFrame, cols, n_files: int, spread: str | None = None) -> DataFrame:
    """Sort rows into ``n_files`` ranges of ``cols``. ``spread`` (a unique column) splits equal values."""
    keys = [*cols, *([spread] if spread else [])]
    return df.repartitionByRange(n_files, *keys).sortWithinPartitions(*keys)


def _numeric(df: DataFrame, col: str) -> Column:
    kind = df.schema[col].dataType
    if isinstance(kind, T.TimestampType):
        return F.unix_micros(col)
    if isinstance(kind, T.DateType):
        return F.unix_date(col).cast("long")
    if isinstance(kind, T.BooleanType):
        return F.col(col).cast("int")
    return F.col(col)


def zorder_key(df: DataFrame, cols, bits: int = 6) -> Column:
    """One integer that interleaves the quantile ranks of ``cols``.

    The 2**bits - 1 borders per column come from one sketch aggregation, so skewed values still fill
    all ranks; the borders are literals of fixed number. Text is compared whole: its borders are quantiles
    of a random sample of SAMPLE_ROWS rows.
    """
    steps = [i / 2**bits for i in range(1, 2**bits)]
    texts = [c for c in cols if isinstance(df.schema[c].dataType, T.StringType)]
    numbers = [c for c in cols if c not in texts]
    found = df.agg(*[F.percentile_approx(_numeric(df, c), steps, 1000).alias(c) for c in numbers]).first() if numbers else {}
    sketch = {c: found[c] for c in numbers} | _text_borders(df, texts, steps)
    ranks = []
    for col in cols:
        borders = sorted(set(sketch[col] or []), key=lambda v: v.encode() if isinstance(v, str) else v)
        value = F.col(col) if col in texts else _numeric(df, col)
        # Halving search over literal borders: at most ``bits`` comparisons per row.
        ranks.append(F.coalesce(_rank(value, borders, 0), F.lit(0)))
    parts = [
        F.shiftleft(F.shiftright(rank, bit).bitwiseAND(1).cast("long"), bit * len(cols) + i)
        for i, rank in enumerate(ranks)
        for bit in range(bits)
    ]
    return reduce(lambda a, b: a.bitwiseOR(b), parts)


def _text_borders(df: DataFrame, cols, steps) -> dict[str, list[str]]:
    """Quantiles of text columns from one bounded sample: the rows with the smallest random numbers."""
    if not cols:
        return {}
    sample = df.select(*cols).orderBy(F.rand(7)).limit(SAMPLE_ROWS).collect()
    borders = {}
    for col in cols:
        values = sorted((r[col] for r in sample if r[col] is not None), key=lambda v: v.encode())
        borders[col] = [values[int(s * len(values))] for s in steps] if values else []
    return borders


def _rank(value: Column, borders: list, offset: int) -> Column:
    if not borders:
        return F.lit(offset)
    mid = len(borders) // 2
    return F.when(value < F.lit(borders[mid]), _rank(value, borders[:mid], offset)).otherwise(
        _rank(value, borders[mid + 1 :], offset + mid + 1)
    )


def zorder_by(df: DataFrame, cols, n_files: int, spread: str | None = None, bits: int = 6) -> DataFrame:
    """Rows in ``n_files`` ranges of the Z-order key, so that each column alone prunes files."""
    keyed = df.withColumn("_z", zorder_key(df, cols, bits))
    keys = ["_z", *([spread] if spread else [])]
    return keyed.repartitionByRange(n_files, *keys).sortWithinPartitions(*keys).drop("_z")


def write_bucketed(df: DataFrame, table: str, path: str, col: str, buckets: int) -> None:
    """Hash-distribute a table by ``col`` so that joins and groupings on it need no shuffle.

    Rows are brought to their bucket first; otherwise every task would write a file into every bucket.
    """
    (
        df.repartition(buckets, col).write.bucketBy(buckets, col).sortBy(col)
        .option("path", path).mode("overwrite").format("parquet").saveAsTable(table)
    )
