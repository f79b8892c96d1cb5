"""Dimension snapshots as validity intervals, and joining events to the version of their day.

Snapshots are full copies, mostly equal to the one before. Folded, a key has one row per version with the days it held: from
the snapshot that brought it to the one that changed or dropped it. So events of many days need one join, not one per run of days
that see the same snapshots.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from clickmill.operators.lookup import BROADCAST_BYTES, HEAVY_PARTS, stored
from clickmill.session import materialize

PERIOD = "__period"


class Period(NamedTuple):
    """Days in which every dimension shows one snapshot: from ``start`` to the start of the next period."""
    number: int
    start: str
    shown: dict[str, str | None]  # the snapshot of each dimension; None if it has none yet


def cut_periods(dates: Mapping[str, Sequence[str]], first: str, last: str) -> list[Period]:
    """The periods of the days ``first`` to ``last``, given the snapshot dates of each dimension."""
    starts = sorted({first} | {d for known in dates.values() for d in known if first < d <= last})
    return [Period(i, start, {name: max((d for d in known if d <= start), default=None) for name, known in dates.items()})
            for i, start in enumerate(starts)]


def by_period(snapshots: DataFrame, name: str, periods: Sequence[Period]) -> DataFrame:
    """All rows of a dimension that some period shows, once per period, with its number; snapshots not shown are not read."""
    shown = [(p.shown[name], p.number) for p in periods if p.shown[name] is not None]
    numbers = snapshots.sparkSession.createDataFrame(shown, f"date string, {PERIOD} int")  # one row per period
    wanted = snapshots.where(F.col("date").isin(sorted({date for date, _ in shown})))
    return wanted.join(F.broadcast(numbers), "date").drop("date")


def fold_versions(rows: DataFrame, key: str, periods: Sequence[Period]) -> DataFrame:
    """Rows per key and period to one row per version, with ``valid_from`` and ``valid_to`` (exclusive; null: still valid).

    A key has at most one row per period. Versions that come back after a change, or after the key was gone, count anew.
    """
    columns = [c for c in rows.columns if c not in (key, PERIOD)]
    if len(periods) == 1:  # nothing to compare
        return rows.where(F.col(key).isNotNull()).dropDuplicates([key]).select(
            key, *columns, F.lit(periods[0].start).alias("valid_from"), F.lit(None).cast("string").alias("valid_to"))
    in_order = Window.partitionBy(key).orderBy(PERIOD)
    content = F.struct(*columns)
    goes_on = content.eqNullSafe(F.lag(content).over(in_order)) & (F.lag(PERIOD).over(in_order) == F.col(PERIOD) - 1)
    numbered = rows.where(F.col(key).isNotNull()).withColumn("__new", F.when(goes_on, 0).otherwise(1))
    runs = numbered.withColumn("__run", F.sum("__new").over(in_order)).groupBy(key, "__run").agg(
        F.first(F.struct(*columns)).alias("content"), F.min(PERIOD).alias("low"), F.max(PERIOD).alias("high"))
    starts = F.array(*[F.lit(p.start) for p in periods])
    return runs.select(key, "content.*", F.get(starts, F.col("low")).alias("valid_from"),
                       F.get(starts, F.col("high") + 1).alias("valid_to"))


def _holds(day, low, high):
    return (day >= low) & (high.isNull() | (day < high))


def attach_as_of(fact: DataFrame, versions: DataFrame, key: str, day: str = "date", broadcast_bytes: int = BROADCAST_BYTES,
                 weigh: DataFrame | None = None) -> DataFrame:
    """Left join of the version that holds on the day of each row; days are text that sorts by time.

    The versions of the keys that occur are written once, which also tells their size; Spark drops the other keys before it folds.
    If they fit, they are broadcast. Otherwise both sides are shuffled by key, where a key meets its few versions. Keys that own
    much of the rows get theirs by broadcast (see ``attach``) and, like the rows with a null key, are spread evenly over the shuffle.
    ``weigh`` has the same keys.
    """
    counted = materialize((fact if weigh is None else weigh).where(F.col(key).isNotNull()).groupBy(F.col(key).alias("__key")).agg(
        F.count(F.lit(1)).alias("__n")), "weights")
    table, size = stored(versions.join(counted, F.col(key) == F.col("__key"), "left_semi"), "versions")
    extra = [c for c in table.columns if c not in (key, "valid_from", "valid_to")]
    named = table.select(F.col(key).alias("__key"), *extra, F.col("valid_from").alias("__from"), F.col("valid_to").alias("__to"))
    if size <= broadcast_bytes:
        held = _holds(F.col(day), F.col("__from"), F.col("__to"))
        return fact.join(F.broadcast(named), (F.col(key) == F.col("__key")) & held, "left").select(*fact.columns, *extra)
    return _attach_shuffled(fact, named, counted, key, day, extra)


def _attach_shuffled(fact: DataFrame, named: DataFrame, counted: DataFrame, key: str, day: str, extra: Sequence[str]) -> DataFrame:
    most = HEAVY_PARTS * int(fact.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    heavy = F.broadcast(counted.where(F.col("__n") * most > counted.select(F.sum("__n")).scalar()).select(F.col("__key").alias("__heavy")))
    flagged = fact.join(heavy, F.col(key) == F.col("__heavy"), "left")
    cold = F.col("__heavy").isNull() & F.col(key).isNotNull()
    spread = F.xxhash64(F.spark_partition_id(), *[F.col(c) for c in fact.columns])
    routed = flagged.select("*", F.when(cold, F.xxhash64(key)).otherwise(spread).alias("__route"), F.when(cold, F.col(key)).alias("__cold"))

    def versions_as(prefix: str, rows: DataFrame) -> tuple[DataFrame, Column]:
        rows = rows.select(*[F.col(c).alias(f"{prefix}{c}") for c in rows.columns])
        return rows, _holds(F.col(day), F.col(f"{prefix}__from"), F.col(f"{prefix}__to"))

    target, held = versions_as("__c_", named.withColumn("__route", F.xxhash64("__key")))
    joined = routed.join(
        target, (F.col("__route") == F.col("__c___route")) & (F.col("__cold") == F.col("__c___key")) & held, "left")
    few, held = versions_as("__h_", named.join(heavy, F.col("__key") == F.col("__heavy"), "left_semi"))
    joined = joined.join(F.broadcast(few), (F.col("__heavy") == F.col("__h___key")) & held, "left")
    return joined.select(*fact.columns, *[
        F.when(F.col("__heavy").isNotNull(), F.col(f"__h_{c}")).otherwise(F.col(f"__c_{c}")).alias(c) for c in extra])


def require_snapshots(snapshots: Mapping[str, DataFrame], keys: Mapping[str, str], periods: Sequence[Period],
                      optional: Sequence[str] = ()) -> None:
    """Refuse a period without a snapshot of a dimension, an empty snapshot and one that repeats a key; one job for all."""
    late = sorted({name for p in periods for name, date in p.shown.items() if date is None and name not in optional})
    if late:
        raise ValueError(f"dimensions are not loaded: {late}")
    counts = None
    for name, rows in snapshots.items():
        shown = sorted({p.shown[name] for p in periods if p.shown[name] is not None})
        part = rows.where(F.col("date").isin(shown)).select(
            F.lit(name).alias("name"), "date", F.col(keys[name]).cast("string").alias("key"))
        counts = part if counts is None else counts.unionByName(part)
    most = counts.groupBy("name", "date", "key").agg(F.count(F.lit(1)).alias("n")).groupBy("name", "date").agg(F.max("n").alias("most"))
    found = {(row["name"], row["date"]): row["most"] for row in most.collect()}  # one row per snapshot
    broken = sorted({name for (name, _), n in found.items() if n > 1})
    if broken:
        raise ValueError(f"a dimension key repeats in {broken}")
    empty = sorted({name for p in periods for name, date in p.shown.items()
                    if date is not None and (name, date) not in found and name not in optional})
    if empty:
        raise ValueError(f"dimensions are not loaded: {empty}")
