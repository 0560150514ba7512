"""Rows from a relational database.

Two ways in.  ``jdbc_table`` reads a table in parallel ranges and lets Spark push filters and
columns; ``jdbc_query`` runs SQL text in the database, in its own dialect, with the time bounds
written in as JDBC escapes.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession

from docsync.functions.times import as_utc
from docsync.sources.params import fill

# Rows per round trip; drivers default to as few as 10.
FETCH_SIZE = 100


def connection_options(connection: Mapping[str, str]) -> dict[str, str]:
    if "url" not in connection:
        raise ValueError("a JDBC connection needs a url")
    return {"fetchsize": str(FETCH_SIZE), **{k: str(v) for k, v in connection.items()}}


def range_options(column: str, lower, upper, partitions: int) -> dict[str, str]:
    """Options that split a read into ranges of one column, one task each.

    The bounds only place the cuts: rows outside them are read by the first and last range.
    """
    if partitions < 1:
        raise ValueError("partitions must be at least 1")
    return {"partitionColumn": column, "lowerBound": str(lower), "upperBound": str(upper),
            "numPartitions": str(partitions)}


def jdbc_time(value) -> str:
    """A timestamp as the JDBC escape every driver understands."""
    return "{ts '" + as_utc(value).isoformat(sep=" ") + "'}"


def jdbc_table(spark: SparkSession, connection: Mapping[str, str], table: str,
               split: Mapping | None = None) -> DataFrame:
    """A table; ``split`` holds column, lower, upper and partitions for a parallel read."""
    options = connection_options(connection) | {"dbtable": table}
    if split:
        options |= range_options(**split)
    return spark.read.format("jdbc").options(**options).load()


def jdbc_query(spark: SparkSession, connection: Mapping[str, str], sql: str, times=(),
               split: Mapping | None = None) -> DataFrame:
    """The rows of a SQL text whose ``?`` are bound to ``times`` in order.

    One task reads a plain query.  With ``split`` the text becomes a derived table and is read in
    ranges, so a large load is spread over the cluster.
    """
    text = fill(sql, [jdbc_time(t) for t in times]).strip().rstrip(";").rstrip()
    options = connection_options(connection)
    if split:
        options |= {"dbtable": f"({text}) docsync_rows"} | range_options(**split)
    else:
        options |= {"query": text}
    return spark.read.format("jdbc").options(**options).load()
