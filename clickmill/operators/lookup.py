"""Lookup joins that hold up when one key owns a large share of the fact rows."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from clickmill.functions.columns import all_set
from clickmill.session import materialize

BROADCAST_BYTES = 64 * 1024 * 1024
# A key is heavy with more than this share of a shuffle partition's mean load, so there are at most
# HEAVY_PARTS * shuffle partitions of them.
HEAVY_PARTS = 4


class Size(NamedTuple):
    rows: int
    bytes: int
    widest: int  # bytes of the largest row


def row_bytes(df: DataFrame) -> Column:
    """Text length plus 16 bytes per cell."""
    cells = [
        F.coalesce(F.octet_length(F.col(f"`{name}`")), F.lit(0)) + 16 if dtype == "string" else F.lit(16)
        for name, dtype in df.dtypes
    ]
    return reduce(lambda a, b: a + b, cells).cast("bigint")


def measure(frames: Sequence[DataFrame]) -> list[Size]:
    """Size of each frame from its own values. One job, map-side summed."""
    sums = []
    for position, df in enumerate(frames):
        sums.append(df.select(row_bytes(df).alias("width")).agg(
            F.lit(position).alias("position"), F.count("width").alias("rows"),
            F.coalesce(F.sum("width"), F.lit(0)).alias("bytes"), F.coalesce(F.max("width"), F.lit(0)).alias("widest")))
    rows = reduce(DataFrame.unionByName, sums).collect()  # one row per frame
    return [Size(row["rows"], row["bytes"], row["widest"]) for row in sorted(rows)]


def measured_bytes(df: DataFrame) -> int:
    return measure([df])[0].bytes


def stored(df: DataFrame, purpose: str) -> tuple[DataFrame, int]:
    """``df`` written once, and its size, which the write itself counts."""
    seen = Observation()
    table = materialize(df.observe(seen, F.coalesce(F.sum(row_bytes(df)), F.lit(0)).alias("bytes")), purpose)
    return table, seen.get["bytes"]


def broadcast_if_small(df: DataFrame, limit_bytes: int = BROADCAST_BYTES) -> DataFrame:
    return F.broadcast(df) if measured_bytes(df) <= limit_bytes else df


def attach(fact: DataFrame, lookup: DataFrame, on: str | Sequence[str], how: str = "left",
           broadcast_bytes: int = BROADCAST_BYTES, heavy_parts: int = HEAVY_PARTS,
           weigh: DataFrame | None = None, lookup_bytes: int | None = None) -> DataFrame:
    """Join ``lookup`` (unique on ``on``) to ``fact``, keeping the fact's rows whole.

    The lookup is measured first. If it fits, it is broadcast and the fact does not move. Otherwise the fact is
    shuffled, except that heavy keys get their lookup rows by broadcast, and those rows, like the rows with a null key, are spread evenly over the shuffle instead of meeting on
    one task. ``weigh`` names a cheaper frame with the same keys to count in, such as the fact before other joins, or, with a
    column ``__n``, holds the fact's rows per key already;
    ``lookup_bytes`` is the lookup's size, or an upper bound of it, if that is known already.
    """
    keys = [on] if isinstance(on, str) else list(on)
    size = measured_bytes(lookup) if lookup_bytes is None else lookup_bytes
    if size <= broadcast_bytes:
        return fact.join(F.broadcast(lookup), keys, how)
    return _attach_shuffled(fact, lookup, keys, how, heavy_parts, fact if weigh is None else weigh)


def _attach_shuffled(fact: DataFrame, lookup: DataFrame, keys: list[str], how: str, heavy_parts: int,
                     weigh: DataFrame) -> DataFrame:
    if how not in ("left", "inner"):
        raise ValueError(f"attach supports left and inner joins, not {how}")
    extra = [c for c in lookup.columns if c not in keys]

    counted = weigh.where(all_set(keys))
    if "__n" not in weigh.columns:
        counted = counted.groupBy(*keys).agg(F.count(F.lit(1)).alias("__n"))
    # Bounded by arithmetic: fewer than ``most`` keys can each own more than one part in ``most`` of the rows.
    most = heavy_parts * int(fact.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    counted = materialize(counted.groupBy(*keys).agg(F.sum("__n").alias("__n")), "weights")
    heavy = counted.where(F.col("__n") * most > counted.select(F.sum("__n")).scalar()).select(*keys)
    heavy_rows = lookup.join(F.broadcast(heavy), keys, "left_semi").withColumn("__found", F.lit(True))
    heavy_lookup = (heavy.join(F.broadcast(heavy_rows), keys, "left")
                    .select(*keys, F.lit(True).alias("__heavy"), F.col("__found").alias("__heavy_found"),
                            *[F.col(c).alias(f"__heavy_{c}") for c in extra]))

    flagged = fact.join(F.broadcast(heavy_lookup), keys, "left")
    cold = F.col("__heavy").isNull() & all_set(keys)
    # Rows that need no shuffled lookup hash over their own values and the map partition: even spread, also for
    # identical copies, and the same value again when a lost task is repeated.
    spread = F.xxhash64(F.spark_partition_id(), *[F.col(c) for c in fact.columns])
    routed = flagged.select(
        "*",
        F.when(cold, F.xxhash64(*keys)).otherwise(spread).alias("__route"),
        *[F.when(cold, F.col(k)).alias(f"__cold_{k}") for k in keys])
    target = lookup.select(
        F.xxhash64(*keys).alias("__route"),
        *[F.col(k).alias(f"__cold_{k}") for k in keys],
        F.lit(True).alias("__cold_found"),
        *[F.col(c).alias(f"__cold_{c}") for c in extra])

    joined = routed.join(target, ["__route", *[f"__cold_{k}" for k in keys]], "left")
    if how == "inner":
        joined = joined.where(F.col("__heavy_found") | F.col("__cold_found"))
    return joined.select(
        *[F.col(c) for c in fact.columns],
        *[_either(f"__heavy_{c}", f"__cold_{c}").alias(c) for c in extra])


def attach_bucketed(fact: DataFrame, lookup: DataFrame, key: str, heavy_parts: int = HEAVY_PARTS) -> DataFrame:
    """Left join of a lookup that lies in a table bucketed on ``key`` (unique there): only the fact moves.

    The buckets take the place of the lookup's shuffle, so a dimension written once serves every join on its key. As in
    ``attach``, heavy keys get their rows by broadcast and, with the rows of a null key, stay where they are; arithmetic bounds
    their number. The fact is scanned three times: to count, for its light keys and for its heavy ones.
    """
    most = heavy_parts * int(fact.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    counted = materialize(fact.where(all_set([key])).groupBy(key).agg(F.count(F.lit(1)).alias("__n")), "weights")
    heavy = F.broadcast(counted.where(F.col("__n") * most > counted.select(F.sum("__n")).scalar()).select(key))
    light = fact.where(all_set([key])).join(heavy, key, "left_anti").join(lookup.hint("merge"), key, "left")
    rows = F.broadcast(lookup.join(heavy, key, "left_semi"))
    rest = fact.join(heavy, key, "left_semi").unionByName(fact.where(~all_set([key]))).join(rows, key, "left")
    columns = [*fact.columns, *[c for c in lookup.columns if c != key]]
    return light.select(*columns).unionByName(rest.select(*columns))


def _either(heavy: str, cold: str) -> Column:
    return F.when(F.col("__heavy"), F.col(heavy)).otherwise(F.col(cold))
