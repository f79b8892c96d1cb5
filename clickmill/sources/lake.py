"""Reading partitioned Parquet folders with their contract."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from urllib.parse import unquote

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def empty(spark: SparkSession, contract: T.StructType) -> DataFrame:
    return spark.createDataFrame([], contract)


def read_table(spark: SparkSession, root: str, contract: T.StructType) -> DataFrame:
    """The whole table; an absent folder is an empty table. The contract keeps date and hour as text."""
    return _tolerant(spark, root, root, contract)


def read_partition(spark: SparkSession, root: str, contract: T.StructType, date: str,
                   hour: str | None = None) -> DataFrame:
    """One hour, or one day without ``hour``. Only that folder is listed; if it is absent the result is empty."""
    leaf = f"{root.rstrip('/')}/date={date}" + ("" if hour is None else f"/hour={hour}")
    return _tolerant(spark, leaf, root, contract)


def read_range(spark: SparkSession, root: str, contract: T.StructType, first: str, last: str) -> DataFrame:
    """Days ``first`` to ``last``, both included, by partition pruning."""
    return read_table(spark, root, contract).where(F.col("date").between(first, last))


def read_hours(spark: SparkSession, root: str, contract: T.StructType, hours: Sequence[tuple[str, str]]) -> DataFrame:
    """The given (date, hour) partitions, by partition pruning."""
    wanted = F.concat_ws(" ", "date", "hour").isin([f"{date} {hour}" for date, hour in hours])
    return read_table(spark, root, contract).where(wanted)


#: Longest list that Spark hands to the Parquet reader value by value, see ``find_rows``.
POINT_VALUES = "spark.sql.parquet.pushdown.inFilterThreshold"


def find_rows(spark: SparkSession, root: str, contract: T.StructType, column: str, values: Sequence) -> DataFrame:
    """The rows whose ``column`` holds one of a few values, wherever they lie.

    Up to ``POINT_VALUES`` values (10 unless set) reach the Parquet reader one by one, which then skips each row group whose
    statistics, dictionary or Bloom filter rule all of them out. Longer lists are cut into such groups, and the groups' rows
    put together, so pass few: each group opens the footers anew. A value given twice counts once; null finds nothing.
    """
    wanted = list(dict.fromkeys(v for v in values if v is not None))
    step = int(spark.conf.get(POINT_VALUES))
    table = read_table(spark, root, contract)
    parts = [table.where(F.col(column).isin(wanted[i:i + step])) for i in range(0, len(wanted), step)]
    return reduce(DataFrame.unionByName, parts) if parts else table.where(F.lit(False))


def _tolerant(spark: SparkSession, path: str, root: str, contract: T.StructType) -> DataFrame:
    # Only a missing folder is an empty table. Every other error, such as a broken file, must reach the caller.
    try:
        return spark.read.schema(contract).option("basePath", root).parquet(path).select(*contract.names)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return empty(spark, contract)


def partition_values(df: DataFrame, *keys: str) -> list[tuple]:
    """Distinct partition keys in order. Keep it to partition columns: their number is bounded by the hours kept."""
    return [tuple(row) for row in df.select(*keys).distinct().orderBy(*keys).collect()]


def folders_read(df: DataFrame, *keys: str) -> list[tuple]:
    """Partition values in order of the files that a table read has listed, by their names: no job, and no later file."""
    found = set()
    for name in df.inputFiles():
        parts = dict(part.split("=", 1) for part in unquote(name).split("/") if "=" in part)
        found.add(tuple(parts[key] for key in keys))
    return sorted(found)


def list_files(spark: SparkSession, folder: str) -> list[str]:
    """Visible files of a folder, in order."""
    pattern = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{folder.rstrip('/')}/[!._]*")
    files = pattern.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return sorted(str(f.getPath()) for f in files.globStatus(pattern) or [])


def partition_folders(spark: SparkSession, root: str, *keys: str) -> list[tuple]:
    """Partition values in order, from the folder names alone; no file is opened."""
    pattern = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(root.rstrip("/") + "".join(f"/{key}=*" for key in keys))
    files = pattern.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    found = files.globStatus(pattern) or []
    return sorted(tuple(part.split("=", 1)[1] for part in str(f.getPath()).split("/")[-len(keys):]) for f in found)
