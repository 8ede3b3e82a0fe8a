"""Text to typed values. Bad text becomes NULL here and a rule failure later, never an error."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F, types as T

TIMESTAMP_FORMAT = "yyyy-MM-dd HH:mm:ss"


def timestamp_text(col: Column | str, fmt: str = TIMESTAMP_FORMAT) -> Column:
    return F.try_to_timestamp(F.col(col) if isinstance(col, str) else col, F.lit(fmt))


def parse(col: Column, kind: T.DataType) -> Column:
    """Text to ``kind``; timestamps use the fixed source format."""
    if isinstance(kind, T.TimestampType):
        return timestamp_text(F.nullif(F.trim(col), F.lit("")))
    if isinstance(kind, T.StringType):
        return col
    return F.nullif(F.trim(col), F.lit("")).try_cast(kind)


def parse_text(df: DataFrame, contract: T.StructType, keep_text: bool = False) -> DataFrame:
    """Type every contract column of an all-text table in one projection.

    ``_unparsed`` lists the columns whose text was present but did not parse, with that text.
    """
    typed = [parse(F.col(f.name), f.dataType).alias(f.name) for f in contract]
    if not keep_text:
        return df.select(*typed, *[c for c in df.columns if c not in contract.names])
    broken = [
        F.when(
            F.nullif(F.trim(F.col(f.name)), F.lit("")).isNotNull()
            & parse(F.col(f.name), f.dataType).isNull(),
            F.concat(F.lit(f.name + "="), F.col(f.name)),
        )
        for f in contract
        if not isinstance(f.dataType, T.StringType)
    ]
    unparsed = F.nullif(F.concat_ws("; ", *broken), F.lit("")).alias("_unparsed")
    extra = [c for c in df.columns if c not in contract.names]
    return df.select(*typed, *extra, unparsed)


def decode_json(col: Column, payload: T.StructType) -> Column:
    """A JSON text column as a struct, with ``_corrupt_record`` set when it does not fit."""
    schema = T.StructType([*payload.fields, T.StructField("_corrupt_record", T.StringType())])
    return F.from_json(
        col, schema, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_corrupt_record"}
    )
