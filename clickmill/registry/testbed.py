"""The benchmark tables seen as the clickstream domain: events and the four dimensions."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clickmill.functions.columns import date_key, hour_key, slug
from clickmill.operators.tiering import to_bronze

# Event types of the source table and the domain's names for them; "error" stays unknown on purpose.
EVENT_TYPES = {"signup": "SEARCH", "view": "VIEW_PRODUCT", "click": "ADD_TO_CART", "purchase": "PURCHASE",
               "error": "ERROR"}


# The columns used, so that no job is spent on finding the schema.
SCHEMAS = {
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, props string",
    "customer": "c_custkey bigint, c_name string, c_mktsegment string",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_retailprice double",
    "supplier": "s_suppkey bigint, s_name string",
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.schema(SCHEMAS[name]).parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def hot_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    source = table(spark, sf_dir, "events")
    kind = F.col("event_type")
    renamed = F.lit(None).cast("string")
    for old, new in EVENT_TYPES.items():
        renamed = F.when(kind == old, new).otherwise(renamed)
    # The decoded key and the time are used several times, so they are columns of their own first.
    decoded = source.select(
        "event_id", "user_id", renamed.alias("event_type"),
        F.get_json_object("props", "$.k").cast("bigint").alias("k"),
        F.date_trunc("second", F.col("ts").cast("timestamp")).alias("occurred_at"))
    k = F.col("k")
    return decoded.select(
        F.col("event_id").cast("string").alias("event_id"), "user_id", (k * 21).alias("product_id"), "event_type",
        F.when(k % 3 == 0, "WEB").when(k % 3 == 1, "IOS").otherwise("ANDROID").alias("platform"),
        "occurred_at", date_key(F.col("occurred_at")).alias("date"), hour_key(F.col("occurred_at")).alias("hour"))


def bronze_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return to_bronze(hot_events(spark, sf_dir))


def users(spark: SparkSession, sf_dir: str) -> DataFrame:
    created = F.timestamp_seconds(F.unix_timestamp(F.lit("2020-01-01").cast("timestamp")) + F.col("c_custkey") * 86400)
    return table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("user_id"), F.lower("c_name").alias("username"),
        F.concat(F.lower("c_name"), F.lit("@example.com")).alias("email"), F.col("c_name").alias("full_name"),
        created.alias("created_at"))


def categories(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One category per part type; its id is the smallest key of that type."""
    return table(spark, sf_dir, "part").groupBy("p_type").agg(F.min("p_partkey").alias("category_id")).select(
        "category_id", F.lit(None).cast("bigint").alias("parent_id"), F.col("p_type").alias("name"),
        slug(F.col("p_type")).alias("slug"), F.lit(1).alias("level"))


def stores(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "supplier").select(
        F.col("s_suppkey").alias("store_id"), F.lit(0).cast("bigint").alias("owner_id"),
        F.lit(None).cast("string").alias("address"), F.col("s_name").alias("store_name"),
        F.lit(False).alias("is_official_store"), F.lit(0.0).alias("rating"),
        F.lit("2020-01-01").cast("timestamp").alias("created_at"))


def products(spark: SparkSession, sf_dir: str) -> DataFrame:
    part = table(spark, sf_dir, "part")
    kinds = part.groupBy("p_type").agg(F.min("p_partkey").alias("category_id"))
    shops = table(spark, sf_dir, "supplier").select(F.count(F.lit(1))).scalar()
    return part.join(kinds, "p_type").select(
        F.col("p_partkey").alias("product_id"), (F.col("p_partkey") % shops).alias("store_id"), "category_id",
        F.col("p_name").alias("name"), F.lit(None).cast("string").alias("description"),
        F.col("p_retailprice").alias("price"), F.lit(None).cast("int").alias("stock_quantity"),
        F.lit("2020-01-01").cast("timestamp").alias("created_at"))


def dimensions(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    return {"users": users(spark, sf_dir), "products": products(spark, sf_dir),
            "categories": categories(spark, sf_dir), "stores": stores(spark, sf_dir)}
