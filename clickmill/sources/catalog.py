"""Catalog schemas and external partitioned tables."""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from clickmill.schemas import LAKE_TABLES
from clickmill.session import make_folder, remove_paths
from clickmill.sources.lake import partition_folders
from clickmill.sources.sinks import overwrite_partitions

_SYNC = {"ADD": "ADD", "DROP": "DROP", "FULL": "SYNC"}


def create_schema(spark: SparkSession, name: str, location: str) -> None:
    spark.sql(f"CREATE DATABASE IF NOT EXISTS `{name}` LOCATION '{location}'")


def create_table(spark: SparkSession, table: str, contract: T.StructType, location: str,
                 partition_by: Sequence[str] = (), if_not_exists: bool = True) -> None:
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in contract)
    partitions = f" PARTITIONED BY ({', '.join(partition_by)})" if partition_by else ""
    guard = "IF NOT EXISTS " if if_not_exists else ""
    spark.sql(f"CREATE TABLE {guard}{table} ({columns}) USING parquet{partitions} LOCATION '{location}'")


def drop_table(spark: SparkSession, table: str) -> None:
    spark.sql(f"DROP TABLE IF EXISTS {table}")


def sync_partitions(spark: SparkSession, table: str, mode: str = "ADD") -> None:
    """ADD registers folders the catalog does not know, DROP forgets vanished ones, FULL does both."""
    spark.sql(f"MSCK REPAIR TABLE {table} {_SYNC[mode]} PARTITIONS")


def truncate_tables(spark: SparkSession, tables: Sequence[str]) -> None:
    """Empty managed tables before a reload."""
    for table in tables:
        spark.sql(f"TRUNCATE TABLE {table}")


def replace_table_partition(spark: SparkSession, source_view: str, table: str, spec: dict[str, str],
                            columns: Sequence[str]) -> None:
    """One statement for delete-and-insert of a catalog partition; an empty source empties the partition."""
    values = ", ".join(f"{key} = '{value}'" for key, value in spec.items())
    body = ", ".join(f"`{c}`" for c in columns if c not in spec)
    spark.sql(f"INSERT OVERWRITE TABLE {table} PARTITION ({values}) SELECT {body} FROM {source_view}")


def write_version(df: DataFrame, root: str, partition_by: Sequence[str], sort: Sequence[str] = ()) -> str:
    """Write ``df`` into a new folder of its own under ``root``; nobody sees it before ``show_version``."""
    version = f"{root.rstrip('/')}/version={uuid.uuid4().hex}"
    overwrite_partitions(df, version, partition_by, sort)
    return version


def show_version(spark: SparkSession, table: str, version: str, partition_by: Sequence[str]) -> list[tuple]:
    """Point the partitions of a catalog table to those of ``version``; returns their values.

    One statement switches one partition: who reads the table by name finds the old or the new files of a partition,
    never none and never both, and the old ones stay until ``drop_versions``. A run that stops in between has switched some
    partitions; showing the version again switches the rest. Partitions that the version lacks keep what they show.
    """
    found = partition_folders(spark, version, *partition_by)
    known = set(_partitions(spark, table, partition_by))
    for values in found:
        spec = _spec(partition_by, values)
        leaf = version + "".join(f"/{key}={value}" for key, value in zip(partition_by, values))
        if values in known:
            spark.sql(f"ALTER TABLE {table} PARTITION ({spec}) SET LOCATION '{leaf}'")
        else:
            spark.sql(f"ALTER TABLE {table} ADD PARTITION ({spec}) LOCATION '{leaf}'")
    return found


def publish_version(df: DataFrame, table: str, root: str, partition_by: Sequence[str], sort: Sequence[str] = ()) -> str:
    """Write the partitions of ``df`` aside and show them; a failure before the end of the write changes nothing."""
    version = write_version(df, root, partition_by, sort)
    show_version(df.sparkSession, table, version, partition_by)
    return version


def drop_versions(spark: SparkSession, table: str, root: str, partition_by: Sequence[str], keep: Sequence[str] = ()) -> int:
    """Delete the partition folders of versions that the table no longer shows; returns how many.

    Run it when no reader is left that began before the last switch, and not beside a writer: a version that is written but not
    shown yet must be named in ``keep``.
    """
    root = root.rstrip("/")
    listed = _partitions(spark, table, partition_by)
    shown = {_location(spark, table, _spec(partition_by, values)).split("/version=", 1)[-1] for values in listed}
    kept = {version.split("/version=", 1)[-1] for version in keep}
    stale = []
    for version, *values in partition_folders(spark, root, "version", *partition_by):
        leaf = version + "".join(f"/{key}={value}" for key, value in zip(partition_by, values))
        if leaf not in shown and version not in kept:
            stale.append(f"{root}/version={leaf}")
    return remove_paths(spark, stale)


def _partitions(spark: SparkSession, table: str, partition_by: Sequence[str]) -> list[tuple]:
    """Values of the partitions that the catalog lists."""
    rows = spark.sql(f"SHOW PARTITIONS {table}").collect()  # one row per partition
    parts = (dict(cell.split("=", 1) for cell in row[0].split("/")) for row in rows)
    return [tuple(part[key] for key in partition_by) for part in parts]


def _spec(partition_by: Sequence[str], values: tuple) -> str:
    return ", ".join(f"{key} = '{value}'" for key, value in zip(partition_by, values))


def _location(spark: SparkSession, table: str, spec: str) -> str:
    """Folder that the catalog names for a partition."""
    rows = spark.sql(f"DESCRIBE TABLE EXTENDED {table} PARTITION ({spec})").collect()
    return next(row["data_type"] for row in rows if row["col_name"] == "Location")


def write_bucketed(df: DataFrame, table: str, folder: str, key: str, buckets: int) -> None:
    """Write a dimension as a table that is hashed on ``key`` into ``buckets`` and sorted inside them."""
    dealt = df.repartition(buckets, key)  # one file per bucket
    dealt.write.mode("overwrite").format("parquet").option("path", folder).bucketBy(buckets, key).sortBy(key).saveAsTable(table)


def register_lake(spark: SparkSession, root: str, prefix: str = "") -> list[str]:
    """Create the metadata, silver and gold schemas and their ten tables over a lake folder."""
    names = []
    for full_name, (contract, partition_by) in LAKE_TABLES.items():
        schema, table = full_name.split(".")
        folder = table_folder(root, full_name)
        create_schema(spark, f"{prefix}{schema}", folder.rsplit("/", 1)[0])
        target = f"`{prefix}{schema}`.`{table}`"
        create_table(spark, target, contract, folder, partition_by)
        make_folder(spark, folder)  # a repair of a table without a folder is an error
        sync_partitions(spark, target, "ADD")
        names.append(target)
    return names


def table_folder(root: str, full_name: str) -> str:
    """Folder of a lake table: events and dimensions lie in bronze, the rest under its own schema."""
    schema, table = full_name.split(".")
    root = root.rstrip("/")
    if full_name == "metadata.events":
        return f"{root}/bronze/events"
    return f"{root}/bronze/metadata/{table}" if schema == "metadata" else f"{root}/{schema}/{table}"
