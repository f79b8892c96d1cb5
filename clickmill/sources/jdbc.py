"""JDBC scans and report tables. URL, user and driver are arguments; nothing is stored here."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession


@dataclass(frozen=True)
class JdbcTarget:
    url: str
    properties: dict[str, str] = field(default_factory=dict)


def read_jdbc(spark: SparkSession, target: JdbcTarget, table: str, split_column: str | None = None,
              lower: int | None = None, upper: int | None = None, partitions: int = 1) -> DataFrame:
    """Scan a table. With ``split_column`` the scan runs as ``partitions`` parallel range queries.

    The bounds only place the cuts: rows outside them, and null keys, still arrive.
    """
    if split_column is None:
        return spark.read.jdbc(target.url, table, properties=dict(target.properties))
    if lower is None or upper is None:
        raise ValueError("a split scan needs lower and upper bounds of the split column")
    return spark.read.jdbc(target.url, table, column=split_column, lowerBound=lower, upperBound=upper,
                           numPartitions=partitions, properties=dict(target.properties))


def read_jdbc_query(spark: SparkSession, target: JdbcTarget, query: str, alias: str = "q", **split) -> DataFrame:
    """Scan the result of a query that the source evaluates, so that only its columns travel."""
    return read_jdbc(spark, target, f"({query}) {alias}", **split)


def overwrite_jdbc(df: DataFrame, target: JdbcTarget, table: str, connections: int = 8,
                   keep_table: bool = False) -> None:
    """Replace a report table. ``keep_table`` empties it and keeps its definition instead of dropping it.

    ``connections`` bounds the load on the database; the work before the write keeps its own parallelism.
    """
    writer = df.repartition(connections).write.option("truncate", str(keep_table).lower())
    writer.jdbc(target.url, table, mode="overwrite", properties=dict(target.properties))


def append_jdbc(df: DataFrame, target: JdbcTarget, table: str, connections: int = 8) -> None:
    """Insert rows; every partition is one transaction."""
    df.repartition(connections).write.jdbc(target.url, table, mode="append", properties=dict(target.properties))
