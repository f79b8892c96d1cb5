"""Hourly summaries of silver that merge to exact daily marts.

An hour is summarised once, from its own silver. A day is put together from the summaries of its hours, in any order, so a new
hour extends the day and a late one changes it without reading the silver of other hours again:

* ``session_pieces``: per user, gap-sized block and platform the first and last second and the events. A session breaks only
  between blocks, so a user has two blocks an hour at most with the default gap, and an open session needs no state of its own.
* ``funnel_bitmaps``: per platform and step the users as bitmaps of 32,768 ids each. Distinct users of a day are the bits
  of the hours or-ed, which no sum of hourly counts can give.
* ``user_sketches``: per platform the users as one sketch, for counts within a few per cent at a few kilobytes an hour.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from clickmill import schemas
from clickmill.functions.columns import safe_ratio
from clickmill.operators.sessions import SESSION_GAP_SECONDS, session_pieces, sessions_of_pieces
from clickmill.plans.funnel import STEP_COLUMNS, step_bit
from clickmill.plans.session_performance import performance_of_sessions
from clickmill.sources import sinks
from clickmill.sources.lake import partition_folders, read_hours, read_table

HOUR = ("date", "hour")
SKETCH_LG = 12  # standard error of about 1.6 %


def summarise_sessions(silver: DataFrame, gap: int = SESSION_GAP_SECONDS) -> DataFrame:
    return session_pieces(silver, gap, HOUR)


def sessions_by_day(pieces: DataFrame, gap: int = SESSION_GAP_SECONDS) -> DataFrame:
    """The session mart per day. A block that two hours share, with a gap that does not divide the hour, is summed up first."""
    whole = pieces.groupBy("date", "user_id", "block", "platform").agg(
        F.min("first_second").alias("first_second"), F.max("last_second").alias("last_second"), F.sum("events").alias("events"))
    return performance_of_sessions(sessions_of_pieces(whole, gap))


def summarise_funnel(silver: DataFrame) -> DataFrame:
    """Bitmaps of the users of each step. Events outside the funnel leave one row without users, so their platform stays."""
    bit = step_bit()
    steps = silver.select(*HOUR, "platform", bit.alias("step"), F.when(bit != 0, F.col("user_id")).alias("user_id"))
    return steps.groupBy(*HOUR, "platform", "step", F.bitmap_bucket_number("user_id").alias("bucket")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position("user_id")).alias("users"))


def funnel_from_bitmaps(bitmaps: DataFrame, grain: Sequence[str] = ("date",)) -> DataFrame:
    """The funnel of a longer grain: bitmaps of the same bucket are or-ed, then their bits counted."""
    merged = bitmaps.groupBy(*grain, "platform", "step", "bucket").agg(
        F.bitmap_count(F.bitmap_or_agg("users")).alias("users"))
    counts = merged.groupBy(*grain, "platform").agg(*[
        F.coalesce(F.sum(F.when((F.col("step") == 1 << position) & F.col("bucket").isNotNull(), F.col("users"))), F.lit(0)).alias(name)
        for position, name in enumerate(STEP_COLUMNS)])
    return counts.select(
        *[F.col("date").alias("log_date") for key in grain if key == "date"],
        F.col("platform").alias("device_type"), *STEP_COLUMNS,
        safe_ratio(F.col(STEP_COLUMNS[-1]), F.col(STEP_COLUMNS[0]), 4).alias("conversion_rate_overall"), *grain)


def summarise_users(silver: DataFrame) -> DataFrame:
    return silver.groupBy(*HOUR, "platform").agg(F.hll_sketch_agg("user_id", F.lit(SKETCH_LG)).alias("users"))


def users_from_sketches(sketches: DataFrame, grain: Sequence[str] = ("date",)) -> DataFrame:
    return sketches.groupBy(*grain, "platform").agg(F.hll_sketch_estimate(F.hll_union_agg("users")).alias("users"))


@dataclass(frozen=True)
class Summary:
    table: str
    contract: T.StructType
    summarise: Callable[[DataFrame], DataFrame]


SUMMARIES = {
    "session_pieces": Summary("silver.session_pieces", schemas.SESSION_PIECES, summarise_sessions),
    "funnel_bitmaps": Summary("silver.funnel_bitmaps", schemas.FUNNEL_BITMAPS, summarise_funnel),
    "user_sketches": Summary("silver.user_sketches", schemas.USER_SKETCHES, summarise_users),
}


def silver_hours(spark: SparkSession, lake, hours: Sequence[tuple[str, str]]) -> DataFrame:
    """Silver of some hours; only their folders are read."""
    return read_hours(spark, lake.folder("silver.wide_table_events"), schemas.SILVER_EVENTS, hours)


def refresh(spark: SparkSession, lake, name: str, hours: Sequence[tuple[str, str]]) -> list[tuple[str, str]]:
    """Bring the summaries up to date after ``hours`` have changed in silver, in one job; returns the hours summarised.

    On the days of these hours, what silver has and the summary lacks is summarised too, and what silver lost is dropped.
    """
    summary = SUMMARIES[name]
    root, days = lake.folder(summary.table), {date for date, _ in hours}
    there = {h for h in partition_folders(spark, lake.folder("silver.wide_table_events"), *HOUR) if h[0] in days}
    known = {h for h in partition_folders(spark, root, *HOUR) if h[0] in days}
    todo = sorted(there & (set(hours) | (there - known)))
    if todo:
        rewrite(silver_hours(spark, lake, todo), lake, name)
    sinks.drop_stale(spark, root, HOUR, list(known), list(there))
    return todo


def rewrite(silver: DataFrame, lake, name: str) -> None:
    """Summarise whole hours of silver in one job."""
    summary = SUMMARIES[name]
    sinks.overwrite_partitions(summary.summarise(silver), lake.folder(summary.table), HOUR)


def read_summary(spark: SparkSession, lake, name: str, first: str, last: str) -> DataFrame:
    """Summaries of the days ``first`` to ``last``."""
    summary = SUMMARIES[name]
    return read_table(spark, lake.folder(summary.table), summary.contract).where(F.col("date").between(first, last))
