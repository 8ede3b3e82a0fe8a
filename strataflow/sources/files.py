"""File scans under a declared schema."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from ..contracts import text_contract
from ..functions.masking import mask_columns
from .split import read_csv_split, read_json_split
from .tables import read_current


# Holds the text of a CSV row with too many or too few fields; NULL in a sound row.
CORRUPT = "_corrupt_record"


def read_csv(
    spark: SparkSession, path: str | list[str], contract: T.StructType, multi_line: bool = False, **sizes: int,
) -> DataFrame:
    """CSV with header as CSV writers write it, every column as text. Type it with functions.parsing.parse_text.

    Quotes inside a quoted field are doubled. Fields that hold line breaks need ``multi_line``: see split.read_csv_split,
    which reads a file in many tasks all the same, at the cost of one written copy. A row with surplus or missing fields
    keeps its text in CORRUPT, for quality.well_formed(). A header that differs from the contract is an error; without that
    check Spark would take the columns by position.
    """
    if multi_line:
        return read_csv_split(spark, path, contract, CORRUPT, **sizes)
    schema = T.StructType([*text_contract(contract), T.StructField(CORRUPT, T.StringType())])
    return spark.read.schema(schema).options(
        header=True, enforceSchema=False, quote='"', escape='"', mode="PERMISSIVE", columnNameOfCorruptRecord=CORRUPT,
    ).csv(path)


def read_json_lines(spark: SparkSession, path: str | list[str], contract: T.StructType, **options) -> DataFrame:
    return spark.read.schema(contract).options(**options).json(path)


def read_json_array(spark: SparkSession, path: str | list[str], contract: T.StructType, **options) -> DataFrame:
    """Documents that span lines, such as one array, indented or not; see split.read_json_split for how a file is shared
    by many tasks. ``split_bytes`` and ``chunk_chars`` are its sizes, other options those of Spark's JSON parser."""
    return read_json_split(spark, path, contract, **options)


def read_table(spark: SparkSession, path: str, schema: T.StructType | None = None, fmt: str = "parquet") -> DataFrame:
    reader = spark.read.format(fmt)
    return (reader.schema(schema) if schema is not None else reader).load(path)


def read_evolving(spark: SparkSession, path: str) -> DataFrame:
    """A folder whose files gained columns over time; older files give NULL."""
    return spark.read.option("mergeSchema", True).parquet(path)


def read_files(spark: SparkSession, folder: str) -> DataFrame:
    """All files below a folder, whatever their format. ``content`` is only read if selected."""
    return spark.read.format("binaryFile").option("recursiveFileLookup", True).load(folder)


def list_files(spark: SparkSession, folder: str) -> DataFrame:
    """Path, modification time and URI (as rows have it in _source_file) of all files below a folder; no content is read."""
    return read_files(spark, folder).select("path", "modificationTime", F.col("_metadata.file_path").alias("uri"))


def read_text(spark: SparkSession, folder: str) -> DataFrame:
    """All lines below a folder, splittable."""
    return spark.read.option("recursiveFileLookup", True).text(folder)


def with_provenance(df: DataFrame, source_system: str) -> DataFrame:
    """File, load time and source system of a Bronze row."""
    return df.withColumns(
        {
            "_source_file": F.col("_source_file" if "_source_file" in df.columns else "_metadata.file_path"),
            "_ingested_at": F.current_timestamp(),
            "_source_system": F.lit(source_system),
        }
    )


def serve_current(
    spark: SparkSession, root: str, view: str, table: str | None = None, phi: str | None = "mask", secret: bytes | None = None,
) -> None:
    """Expose the version of a published table that is current now. Call it again after a publish: a view
    keeps to the version it was made from, so that a query never changes under its reader."""
    serve(read_current(spark, root, table=table), view, phi, secret)


def serve(df: DataFrame, view: str, phi: str | None = "mask", secret: bytes | None = None) -> None:
    """Expose a table as a view. Personal columns are masked unless ``phi`` is None; "keyed" needs a secret."""
    (mask_columns(df, policy=phi, secret=secret) if phi else df).createOrReplaceTempView(view)
