"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import os
from collections.abc import Callable, Iterator
from pathlib import Path

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, functions as F, types as T
from pyspark.sql.pandas.types import to_arrow_type

# Rows and text bytes that a task works on at once.
SLICE_ROWS = 500
SLICE_BYTES = 2 << 20
# Rows that Spark hands to Python at once: texts may be long.
BATCH_ROWS = 1_000


def ship(spark) -> None:
    """Let Python workers on this machine import the package from where the driver has it, and bound their batches.

    On a cluster the package is installed or given as --py-files; the path is then one that is not there.
    """
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    root, env = str(Path(__file__).resolve().parents[2]), spark.sparkContext.environment
    known = env.get("PYTHONPATH", "").split(os.pathsep)
    if root not in known:
        env["PYTHONPATH"] = os.pathsep.join(filter(None, [root, *known]))


def read_table(spark, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def fresh(df: DataFrame, name: str) -> str:
    """A column name that ``df`` does not have yet."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = f"_{name}"
    return name


def texts_of(column: pa.Array) -> list[str]:
    """Values as text; a null counts as empty."""
    return ["" if v is None else v for v in column.to_pylist()]


def slices(batch: pa.RecordBatch, column: str) -> Iterator[pa.RecordBatch]:
    """Cut a batch so that no piece holds much over SLICE_BYTES of ``column``."""
    values, start, held = batch.column(column), 0, 0
    sizes = pc.fill_null(pc.binary_length(values), 0).to_pylist()
    for i, size in enumerate(sizes):
        if i > start and (held + size > SLICE_BYTES or i - start >= SLICE_ROWS):
            yield batch.slice(start, i - start)
            start, held = i, 0
        held += size
    if start < len(sizes):
        yield batch.slice(start)


def add_columns(
    df: DataFrame, text_col: str, fields: list[T.StructField], work: Callable[[pa.RecordBatch], list[pa.Array]],
) -> DataFrame:
    """Append ``fields``, computed from each slice of rows by ``work``; same-named columns are replaced."""
    new = {f.name.lower() for f in fields}
    kept = [f for f in df.schema.fields if f.name.lower() not in new]
    names = [f.name for f in kept]
    types = [to_arrow_type(f.dataType) for f in fields]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, text_col):
                made = [a.cast(t) for a, t in zip(work(part), types, strict=True)]
                yield pa.RecordBatch.from_arrays(
                    [part.column(n) for n in names] + made, names=names + [f.name for f in fields]
                )

    return df.mapInArrow(run, T.StructType(kept + fields))


def list_array(lengths, values: pa.Array) -> pa.Array:
    """An array of lists from the lists' lengths and their joined values."""
    offsets = [0]
    for n in lengths:
        offsets.append(offsets[-1] + n)
    return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), values)


def sha256_hex(col: Column) -> Column:
    return F.sha2(col, 256)
