"""Control and audit tables in a database. The driver jar is the caller's; Parquet is the default."""

from __future__ import annotations

from urllib.parse import quote

from pyspark.sql import DataFrame, SparkSession

from .tables import append


def jdbc_options(url: str, table: str | None = None, query: str | None = None, **extra: str) -> dict[str, str]:
    """Options for one table or one query, never both."""
    if (table is None) == (query is None):
        raise ValueError("name either a table or a query")
    target = {"dbtable": table} if table else {"query": query}
    return {"url": url, **target, **extra}


def read_control(spark: SparkSession, source: str | dict) -> DataFrame:
    """The control table from a Parquet path or from JDBC options."""
    if isinstance(source, dict):
        return spark.read.format("jdbc").options(**source).load()
    return spark.read.parquet(source)


def batch_name(*parts: str) -> str:
    """Parts of a name in one path component, whatever characters they hold."""
    return "--".join(quote(p, safe="") for p in parts)


# The column that names the load a log row belongs to, in both logs.
EXECUTION = "ExecutionID"


def delete_statement(table: str, key: str, n: int) -> str:
    """Deletes the rows of ``n`` keys, given as parameters."""
    if n < 1:
        raise ValueError("no keys to delete")
    return f"DELETE FROM {table} WHERE {key} IN ({', '.join('?' * n)})"


def _run(spark: SparkSession, sink: dict, statement: str, values: list[str]) -> None:
    """Run one statement over a connection of the driver's own, with the options of the sink."""
    jvm, properties = spark._jvm, spark._jvm.java.util.Properties()
    for name, value in sink.items():
        if name not in ("url", "dbtable", "query", "driver"):
            properties.setProperty(name, str(value))
    if "driver" in sink:
        jvm.java.lang.Class.forName(sink["driver"])
    connection = jvm.java.sql.DriverManager.getConnection(sink["url"], properties)
    try:
        prepared = connection.prepareStatement(statement)
        for i, value in enumerate(values, 1):
            prepared.setString(i, value)
        prepared.executeUpdate()
    finally:
        connection.close()


def _insert(df: DataFrame, sink: dict) -> None:
    df.write.format("jdbc").options(**sink).mode("append").save()


def append_audit(df: DataFrame, sink: str | dict, batch: str | None = None) -> None:
    """Append log rows; rows under an equal ``batch`` name are replaced.

    A name has to say whose rows they are, such as run, layer and entity: see batch_name. In a database the rows of
    the same executions are deleted first, so that a load that is repeated has one set of rows there as well; if the
    insert then fails, the next repeat brings them.
    """
    if isinstance(sink, dict):
        if batch:
            ids = sorted(r[EXECUTION] for r in df.select(EXECUTION).distinct().collect() if r[EXECUTION])  # one per load
            if ids:
                _run(df.sparkSession, sink, delete_statement(sink["dbtable"], EXECUTION, len(ids)), ids)
        _insert(df, sink)
    elif batch:
        df.write.mode("overwrite").parquet(f"{sink}/batch={batch}")
    else:
        append(df, sink)
