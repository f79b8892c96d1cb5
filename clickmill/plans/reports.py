"""Jobs between databases and the lake: dimension snapshots and the product report."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import SparkSession

from clickmill import schemas
from clickmill.operators.dimensions import write_snapshot
from clickmill.plans.product_sales import product_sales
from clickmill.sources import jdbc
from clickmill.sources.catalog import table_folder

REPORT_TABLE = "mart_product_sales"


def snapshot_dimensions(spark: SparkSession, shop: jdbc.JdbcTarget, lake_root: str, date: str,
                        tables: Sequence[str] = tuple(schemas.DIMENSIONS), overwrite: bool = False) -> dict[str, str]:
    """Copy the dimension tables of the shop database into the lake, once per date; returns what became of each."""
    return {
        name: write_snapshot(jdbc.read_jdbc(spark, shop, name), table_folder(lake_root, f"metadata.{name}"), date,
                             schemas.DIMENSIONS[name], overwrite, schemas.DIMENSION_KEYS[name])
        for name in tables}


def refresh_product_sales(spark: SparkSession, shop: jdbc.JdbcTarget, hot: jdbc.JdbcTarget, events_table: str = "events",
                          event_types: Sequence[str] | None = None, split: dict | None = None,
                          table: str = REPORT_TABLE) -> None:
    """Compute the product report from the shop's products and the hot events, and replace it in the shop database.

    Only the columns in use travel. ``split`` (split_column, lower, upper, partitions) reads the events in parallel.
    """
    products = jdbc.read_jdbc(spark, shop, "products")
    query = f"SELECT user_id, event_id, product_id, event_type FROM {events_table}"
    events = jdbc.read_jdbc_query(spark, hot, query, "events", **(split or {}))
    jdbc.overwrite_jdbc(product_sales(events, products, event_types), shop, table)
