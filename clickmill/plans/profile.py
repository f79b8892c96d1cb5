"""Customer profile: who was active, when last, how many purchases, on which device."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clickmill.schemas import PURCHASE


def customer_profile(silver: DataFrame, grain: Sequence[str] = ("date", "hour")) -> DataFrame:
    """One row per user and grain. A user without a known dimension row has null name, email and creation time.

    The device is the most frequent platform, the alphabetically first one on a tie; null platforms do not count.
    """
    # Every aggregate merges on the map side, also the mode, whose state is one count per platform. So a user with many
    # events arrives at the single shuffle as one row per task.
    return (silver.groupBy(*grain, F.col("user_id").alias("customer_id"))
            .agg(F.min("full_name").alias("fullname"), F.min("email").alias("email"),
                 F.min("user_created_at").alias("created_at"),
                 F.to_date(F.max("occurred_at")).alias("last_active_date"),
                 F.count_if(F.col("event_type") == PURCHASE).alias("total_transactions"),
                 F.mode("platform", deterministic=True).alias("primary_device"))
            .select("customer_id", "fullname", "email", "created_at", "last_active_date", "total_transactions",
                    "primary_device", *grain))
