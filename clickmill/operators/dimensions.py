"""Dimension snapshots: conform, write once per day, pick the right one."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from clickmill.session import materialize, path_exists


def conform(df: DataFrame, contract: T.StructType, **fixed: Column) -> DataFrame:
    """Cast to the contract's columns by name; columns the source lacks become null, ``fixed`` ones are set."""
    def column(field: T.StructField) -> Column:
        if field.name in fixed:
            value = fixed[field.name]
        elif field.name in df.columns:
            value = F.col(f"`{field.name}`")
        else:
            value = F.lit(None)
        return value.cast(field.dataType).alias(field.name)
    return df.select(*[column(f) for f in contract])


def write_snapshot(df: DataFrame, root: str, date: str, contract: T.StructType, overwrite: bool = False,
                   key: str | None = None) -> str:
    """Write a full copy of a dimension under ``date=``; returns written, skipped or empty.

    A date that is there already is left alone unless ``overwrite``; an empty source writes nothing. With ``key`` a
    source that repeats a key is refused.
    """
    leaf = f"{root.rstrip('/')}/date={date}"
    if not overwrite and path_exists(df.sparkSession, leaf):
        return "skipped"
    # The source is read once: what is checked is what is written.
    rows = materialize(conform(df, contract).drop("date"), "snapshot")
    if rows.isEmpty():
        return "empty"
    if key:
        require_unique(rows, [key])
    # "ignore" settles the race of two writers that both saw the date missing.
    rows.write.mode("overwrite" if overwrite else "ignore").parquet(leaf)
    return "written"


def latest_snapshot(dimension: DataFrame, as_of: str | None = None) -> DataFrame:
    """All rows of the newest snapshot date not after ``as_of``.

    Snapshots are full copies, so deleted keys must not come back from older dates. The date is a scalar subquery over
    the partition column: Spark evaluates it first and then lists only that partition.
    """
    known = dimension if as_of is None else dimension.where(F.col("date") <= as_of)
    newest = known.select(F.max("date")).scalar()
    return known.where(F.col("date") == newest)


def duplicate_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys that occur more than once, with their number of rows."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("rows")).where(F.col("rows") > 1)


def require_unique(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """``df`` itself, after checking that ``keys`` identify its rows."""
    broken = duplicate_keys(df, keys).head(1)
    if broken:
        raise ValueError(f"dimension is not unique on {list(keys)}: {broken[0].asDict()}")
    return df


def loaded(dimension: DataFrame) -> DataFrame:
    """One row with the column ``loaded``, false for an empty dimension; stops at the first row."""
    return dimension.limit(1).agg((F.count(F.lit(1)) > 0).alias("loaded"))


def is_loaded(dimension: DataFrame) -> bool:
    return loaded(dimension).first()["loaded"]


def require_ready(dimensions: dict[str, DataFrame], keys: dict[str, str], optional: Sequence[str] = ()) -> None:
    """Refuse dimensions that are empty or repeat a key; one job for all of them."""
    rows = [df.select(F.lit(name).alias("name"), F.col(keys[name]).cast("string").alias("key")) for name, df in dimensions.items()]
    counts = reduce(DataFrame.unionByName, rows).groupBy("name", "key").agg(F.count(F.lit(1)).alias("n"))
    most = {row["name"]: row["most"] for row in counts.groupBy("name").agg(F.max("n").alias("most")).collect()}
    missing = [name for name in dimensions if name not in most and name not in optional]
    if missing:
        raise ValueError(f"dimensions are not loaded: {missing}")
    broken = [name for name, n in most.items() if n > 1]
    if broken:
        raise ValueError(f"a dimension key repeats in {broken}")
