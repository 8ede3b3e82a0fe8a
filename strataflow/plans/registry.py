"""Name -> query and name -> oracle SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from .bindings import ORACLE_TABLES

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    """Register a query; ``sql`` may use the tables of ORACLE_TABLES next to the driver's views."""

    def register(fn: Query) -> Query:
        if name in QUERIES:
            raise ValueError(f"{name} is registered twice")
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = f"WITH {ORACLE_TABLES}\n{sql}"
        return fn

    return register


TS_TEXT = "yyyy-MM-dd HH:mm:ss.SSSSSS"


def plain(df: DataFrame) -> DataFrame:
    """Columns in types that compare alike everywhere: times as text, decimals as double."""
    cols = []
    for field in df.schema:
        col = F.col(field.name)
        if isinstance(field.dataType, (T.TimestampType, T.TimestampNTZType)):
            col = F.date_format(col, TS_TEXT)
        elif isinstance(field.dataType, T.DateType):
            col = F.date_format(col, "yyyy-MM-dd")
        elif isinstance(field.dataType, T.DecimalType):
            col = col.cast("double")
        cols.append(col.alias(field.name))
    return df.select(*cols)


def ts(col: str, alias: str | None = None) -> str:
    """The SQL of plain() for a timestamp column."""
    return f"strftime({col}, '%Y-%m-%d %H:%M:%S.%f') AS {alias or col}"


def day(col: str, alias: str | None = None) -> str:
    return f"strftime({col}, '%Y-%m-%d') AS {alias or col}"


def num(*cols: str) -> str:
    return ", ".join(f"CAST({c} AS DOUBLE) AS {c}" for c in cols)
