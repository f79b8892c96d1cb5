"""Duplicate removal and the hot plus cold view."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clickmill.functions.columns import all_set
from clickmill.sources.lake import partition_values


def dedup(df: DataFrame, keys: Sequence[str] = ("event_id",), prefer: Sequence[str] = ("occurred_at",)) -> DataFrame:
    """One row per key: the smallest by ``prefer``, then by the other columns, so reruns agree.

    The minimum is kept on the map side, so any number of copies of one key shrinks to one row per task before it
    is shuffled. Rows with a null key are compared as whole rows.
    """
    rest = [c for c in df.columns if c not in keys]
    if not rest:
        return df.distinct()
    ordered = [*[c for c in prefer if c in rest], *[c for c in rest if c not in prefer]]
    row = F.struct(*ordered)
    return (df.groupBy(*keys, F.when(~all_set(keys), row).alias("__unkeyed"))
            .agg(F.min(row).alias("__row"))
            .select(*keys, "__row.*").select(*df.columns))


def unified_events(cold: DataFrame, hot: DataFrame, keys: Sequence[str] = ("event_id",),
                   live_hours: Sequence[tuple[str, str]] | None = None) -> DataFrame:
    """One logical events table over both tiers; an event present in both is returned once.

    Copies of an event share its hour, and an archived hour holds none, so only the hours that are hot are compared. The
    rest of the cold tier passes through: it is neither shuffled nor sorted. Hours in the hot tier are few and bounded.
    Tables without the columns ``date`` and ``hour`` are compared as a whole. ``live_hours`` names the (date, hour) pairs of the
    hot tier, as ``folders_read`` gives them; without it a job reads them from the rows.
    """
    if not {"date", "hour"} <= set(cold.columns) & set(hot.columns):
        return dedup(cold.unionByName(hot.select(*cold.columns)), keys)
    if live_hours is None:
        live_hours = partition_values(hot, "date", "hour")
    hours = [f"{date} {hour}" for date, hour in live_hours]
    live = F.coalesce(F.concat_ws(" ", "date", "hour").isin(hours), F.lit(False)) if hours else F.lit(False)
    return cold.where(~live).unionByName(dedup(cold.where(live).unionByName(hot.select(*cold.columns)), keys))
