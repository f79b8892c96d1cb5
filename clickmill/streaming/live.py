"""Sessions and funnels on a stream of decoded events, in append mode."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from clickmill.functions.columns import safe_ratio
from clickmill.plans.funnel import STEP_COLUMNS, users_per_step
from clickmill.schemas import FUNNEL_STEPS


def live_sessions(events: DataFrame, lateness: str, gap: str = "30 minutes") -> DataFrame:
    """Sessions per user, cut at midnight like the daily mart; emitted once the watermark has passed their end.

    Events are truncated to whole seconds, so a gap of exactly ``gap`` does not split. Null users have no sessions.
    """
    timed = events.where(F.col("user_id").isNotNull()).withColumn(
        "occurred_at", F.date_trunc("second", "occurred_at"))
    sessions = timed.withWatermark("occurred_at", lateness).groupBy(
        F.session_window("occurred_at", gap), "date", "user_id").agg(
        F.max("occurred_at").alias("session_end"), F.count("event_id").alias("events"))
    return sessions.select("date", "user_id", F.col("session_window.start").alias("session_start"),
                           "session_end", "events")


def live_funnel(events: DataFrame, lateness: str, approximate: bool = False, span: str = "1 hour") -> DataFrame:
    """Distinct users per step, platform and hour, emitted when the hour is complete.

    The exact form chains two aggregations, first to one row per (hour, platform, user) and then to counts, with state
    that ends with the hour; the approximate form keeps one sketch per step instead.
    """
    hours = events.withWatermark("occurred_at", lateness).select(
        F.window("occurred_at", span).alias("span"), "platform", "user_id", "event_type")
    if approximate:
        counts = hours.groupBy("span", "platform").agg(*[
            F.approx_count_distinct(F.when(F.col("event_type") == step, F.col("user_id"))).alias(name)
            for step, name in zip(FUNNEL_STEPS, STEP_COLUMNS)])
    else:
        counts = users_per_step(hours, ["span", "platform"])
    return counts.select(
        F.date_format("span.start", "yyyy-MM-dd").alias("log_date"), F.col("platform").alias("device_type"),
        *STEP_COLUMNS,
        safe_ratio(F.col(STEP_COLUMNS[-1]), F.col(STEP_COLUMNS[0]), 4).alias("conversion_rate_overall"),
        F.date_format("span.start", "yyyy-MM-dd").alias("date"), F.date_format("span.start", "HH").alias("hour"))


def append_to_files(df: DataFrame, root: str, checkpoint: str, every: str | None = None,
                    partition_by: tuple[str, ...] = ()) -> StreamingQuery:
    """Exactly-once Parquet sink; without ``every`` the query takes what is there and ends."""
    writer = (df.writeStream.format("parquet").outputMode("append").option("path", root)
              .option("checkpointLocation", checkpoint))
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer = writer.trigger(processingTime=every) if every else writer.trigger(availableNow=True)
    return writer.start()
