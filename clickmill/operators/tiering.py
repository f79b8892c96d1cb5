"""Hot to cold tiering by event hour."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clickmill.functions.columns import date_key, epoch_seconds, hour_key, in_interval
from clickmill.operators.dedup import dedup
from clickmill.schemas import BRONZE_EVENTS


def archive_split(df: DataFrame, start: str, end: str, column: str = "occurred_at") -> tuple[DataFrame, DataFrame]:
    """Rows inside ``[start, end)`` and all other rows, those without a time included."""
    inside = in_interval(F.col(column), start, end)
    return df.where(inside), df.where(~F.coalesce(inside, F.lit(False)))


def to_bronze(hot: DataFrame) -> DataFrame:
    """The archive layout: text ids, bigint keys, epoch seconds; partition keys from the event's own time."""
    ts = F.col("occurred_at").cast("timestamp")
    return hot.select(
        F.col("event_id").cast("string").alias("event_id"), F.col("user_id").cast("bigint").alias("user_id"),
        F.col("product_id").cast("bigint").alias("product_id"),
        F.col("event_type").cast("string").alias("event_type"), F.col("platform").cast("string").alias("platform"),
        epoch_seconds(ts).alias("occurred_at"), date_key(ts).alias("date"), hour_key(ts).alias("hour")
    ).select(*BRONZE_EVENTS.names)


def merge_archive(existing: DataFrame, arriving: DataFrame) -> DataFrame:
    """Archive content after adding ``arriving``: late rows join in, repeated rows and reruns change nothing."""
    return dedup(existing.unionByName(arriving.select(*existing.columns)))
