"""Exact row numbers over groups of any size."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from clickmill.operators.lookup import broadcast_if_small
from clickmill.session import materialize

_ROW_BITS = 33  # monotonically_increasing_id keeps the row index in the low 33 bits


def number_rows(df: DataFrame, order: Sequence[Column], by: Sequence[str] = (),
                partitions: int | None = None) -> DataFrame:
    """Add ``__rn`` (1-based position in the group) and ``__rows`` (group size) without one task per group.

    ``order`` must be total, so end it with a unique column. Rows are range-partitioned on group and order, so a group,
    or a run of tied values, spreads over as many tasks as it needs. The placed rows are written once to the shared
    folder; positions follow from one small count per (partition, group).
    """
    keys = [F.col(c) for c in by]
    # Without a number adaptive execution may merge neighbouring ranges, which keeps their order.
    ranged = (df.repartitionByRange(partitions, *keys, *order) if partitions
              else df.repartitionByRange(*keys, *order))
    placed = materialize(
        ranged.sortWithinPartitions(*keys, *order)
        .withColumn("__pos", F.monotonically_increasing_id()), "ranked")
    placed = placed.select(
        *df.columns, F.shiftright("__pos", _ROW_BITS).alias("__part"),
        F.col("__pos").bitwiseAND(F.lit((1 << _ROW_BITS) - 1)).alias("__idx"))

    # At most one row per range partition and one more per group boundary.
    runs = placed.groupBy(*by, "__part").agg(F.min("__idx").alias("__first"), F.count(F.lit(1)).alias("__n"))
    group = Window.partitionBy(*by)
    before = group.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    runs = runs.select(
        *[F.col(c).alias(f"__by_{c}") for c in by], F.col("__part").alias("__run_part"), "__first",
        F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__before"), F.sum("__n").over(group).alias("__rows"))

    same = reduce(lambda a, b: a & b, [F.col(c).eqNullSafe(F.col(f"__by_{c}")) for c in by],
                  F.col("__part") == F.col("__run_part"))
    return placed.join(broadcast_if_small(runs), same, "inner").select(
        *df.columns, (F.col("__before") + F.col("__idx") - F.col("__first") + 1).alias("__rn"), "__rows")
