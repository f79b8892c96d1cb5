"""Session performance per platform and day."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clickmill.functions.columns import safe_ratio
from clickmill.operators.sessions import SESSION_GAP_SECONDS, platform_sessions


def session_performance(silver: DataFrame, gap: int = SESSION_GAP_SECONDS, grain: Sequence[str] = ("date",),
                        approximate_users: bool = False) -> DataFrame:
    """Sessions, users, bounces and events per session, one row per platform and grain.

    Sessions end with their grain. A session on two platforms counts once on each. The events of null users count as
    one more row in the average, but not as a session. Users are counted exactly: the rows are already grouped by
    user, so it costs no further shuffle. ``approximate_users`` uses the sketch instead.
    """
    return performance_of_sessions(platform_sessions(silver, gap, grain), grain, approximate_users)


def performance_of_sessions(sessions: DataFrame, grain: Sequence[str] = ("date",), approximate_users: bool = False) -> DataFrame:
    """The mart from one row per (grain, user, session, platform)."""
    per_user = sessions.groupBy(*grain, "platform", "user_id").agg(
        F.count(F.lit(1)).alias("rows"), F.count_if(F.col("events") == 1).alias("bounces"),
        F.sum("events").alias("events"))
    users = F.approx_count_distinct("user_id") if approximate_users else F.count("user_id")
    totals = per_user.groupBy(*grain, "platform").agg(
        F.coalesce(F.sum(F.when(F.col("user_id").isNotNull(), F.col("rows"))), F.lit(0)).alias("total_sessions"),
        users.alias("total_users"), F.sum("bounces").alias("bounce_sessions"),
        (F.sum("events") / F.sum("rows")).alias("mean_events"))
    return totals.select(
        *[F.col("date").alias("log_date") for key in grain if key == "date"],
        "total_sessions", "total_users", "bounce_sessions",
        safe_ratio(F.col("bounce_sessions"), F.col("total_sessions"), 4).alias("bounce_rate"),
        F.round("mean_events", 2).alias("avg_events_per_session"),
        F.col("platform").alias("operating_system"), *grain)
