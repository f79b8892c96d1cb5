"""Revenue and orders per product name."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def product_sales(events: DataFrame, products: DataFrame, event_types: Sequence[str] | None = None) -> DataFrame:
    """Sum of price and count of events per product name; events of unknown products are dropped.

    Every event type counts unless ``event_types`` restricts them. Events are counted per product before the join, so
    both join sides have one row per product, and a product that owns a large share of the events weighs no more
    than any other.
    """
    chosen = events if event_types is None else events.where(F.col("event_type").isin(list(event_types)))
    counts = (chosen.where(F.col("product_id").isNotNull())
              .groupBy(F.col("product_id").cast("bigint").alias("product_id"))
              .agg(F.count(F.lit(1)).alias("n"), F.count("event_id").alias("orders")))
    priced = products.select(F.col("product_id").cast("bigint").alias("product_id"), "name", "price")
    return (counts.join(priced, "product_id", "inner").groupBy("name")
            .agg(F.sum(F.col("price") * F.col("n")).alias("total_revenue"), F.sum("orders").alias("total_orders")))


def top_products(report: DataFrame, k: int) -> DataFrame:
    """The ``k`` products with the highest revenue; equal revenues are ordered by name."""
    return report.orderBy(F.desc_nulls_last("total_revenue"), "name").limit(k)
