"""Recency, frequency, monetary scores and segments."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clickmill.operators.cuts import MOST_ROWS, sort_tie, sort_value, tiles
from clickmill.schemas import PURCHASE
from clickmill.session import materialize

# The minutes shown for a user without a purchase, and the labels below.
NO_PURCHASE_MINUTES = 9999
TILES = 5


def score_orders() -> dict[str, tuple[Column, Column]]:
    """Value and tie-breaker of each score; the user id makes every order total, so ties split the same way on every run.

    Whoever bought nothing comes before the oldest purchase, however long the grain.
    """
    tie = sort_tie(F.col("customer_id"))
    bought = F.col("frequency_value") > 0
    return {"r_score": (F.when(bought, -F.col("recency_value").cast("double")).otherwise(F.lit(-1e18)), tie),
            "f_score": (F.col("frequency_value"), tie),
            "m_score": (sort_value(F.col("monetary_value")), tie)}


def _period_end(grain: Sequence[str], as_of: str | None, silver: DataFrame) -> Column:
    """Last second of the row's grain; without a grain, of the day ``as_of`` or of the newest day."""
    if "hour" in grain:
        text = F.concat("date", F.lit(" "), "hour", F.lit(":59:59"))
    elif "date" in grain:
        text = F.concat("date", F.lit(" 23:59:59"))
    else:
        day = F.lit(as_of) if as_of else silver.select(F.max("date")).scalar()
        text = F.concat(day, F.lit(" 23:59:59"))
    return F.unix_timestamp(text.cast("timestamp"))


def rfm_metrics(silver: DataFrame, grain: Sequence[str] = ("date", "hour"), as_of: str | None = None) -> DataFrame:
    """Minutes since the last purchase, number of purchases and money spent, per user and grain.

    Money is null when no purchased product has a known price. It is rounded to cents, which removes the float noise
    of the summation order, so that equal amounts tie.
    """
    bought = F.col("event_type") == PURCHASE
    facts = silver.groupBy(*grain, "user_id").agg(
        F.max(F.when(bought, F.col("occurred_at"))).alias("last_purchase"),
        F.count_if(bought).alias("frequency_value"),
        F.round(F.sum(F.when(bought, F.col("product_price")).otherwise(F.lit(0.0))), 2).alias("monetary_value"))
    seconds = _period_end(grain, as_of, silver) - F.unix_timestamp("last_purchase")
    return facts.select(
        F.col("user_id").alias("customer_id"),
        F.coalesce(F.floor(seconds / 60), F.lit(NO_PURCHASE_MINUTES)).cast("int").alias("recency_value"),
        F.col("frequency_value").cast("int").alias("frequency_value"), "monetary_value", *grain)


def rfm_segments(silver: DataFrame, grain: Sequence[str] = ("date", "hour"), as_of: str | None = None,
                 most_rows: int = MOST_ROWS) -> DataFrame:
    """Scores 1 to 5 within each grain and the segment they fall in.

    The users' metrics are stored once; the rows that separate the scores are found by counting (``operators.cuts``), so a
    grain with very many users is never sorted. ``most_rows`` bounds what is sorted in one place; the result is the same.
    """
    metrics = materialize(rfm_metrics(silver, grain, as_of), "rfm")
    scored = tiles(metrics, TILES, score_orders(), by=grain, most_rows=most_rows)

    r, f = F.col("r_score"), F.col("f_score")
    prefix = "Hourly " if "hour" in grain else ""
    segment = (F.when((r >= 4) & (f >= 4), prefix + "Champions")
               .when((r >= 3) & (f >= 3), prefix + "Active Users")
               .when((r >= 4) & (f == 1), prefix + "New Buyers")
               .otherwise(prefix + "Low Active"))
    cell = F.concat(r.cast("string"), f.cast("string"), F.col("m_score").cast("string"))
    return scored.select("customer_id", "recency_value", "frequency_value", "monetary_value",
                         r.cast("int").alias("r_score"), f.cast("int").alias("f_score"),
                         F.col("m_score").cast("int").alias("m_score"), cell.alias("rfm_cell"),
                         segment.alias("segment_name"), *grain)
