"""Bronze events to the silver wide table."""

from __future__ import annotations

from collections.abc import Collection, Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clickmill.operators.lookup import BROADCAST_BYTES, Size, attach, measure
from clickmill.operators.versions import PERIOD, Period, attach_as_of, by_period, fold_versions
from clickmill.schemas import SILVER_EVENTS

USER_COLUMNS = ("username", "full_name", "email", "user_created_at")
PRODUCT_COLUMNS = ("product_name", "product_price", "category_name", "store_name")


def category_lookup(categories: DataFrame, *more: str) -> DataFrame:
    return categories.select(F.col("category_id").cast("bigint").alias("category_id"),
                             F.col("name").alias("category_name"), *more)


def store_lookup(stores: DataFrame, *more: str) -> DataFrame:
    return stores.select(F.col("store_id").cast("bigint").alias("store_id"), "store_name", *more)


def user_lookup(users: DataFrame, *more: str) -> DataFrame:
    return users.select(F.col("user_id").cast("bigint").alias("user_id"), "username", "full_name", "email",
                        F.col("created_at").alias("user_created_at"), *more)


def product_keys(products: DataFrame, *more: str) -> DataFrame:
    return products.select(
        F.col("product_id").cast("bigint").alias("product_id"), F.col("category_id").cast("bigint").alias("category_id"),
        F.col("store_id").cast("bigint").alias("store_id"), F.col("name").alias("product_name"),
        F.col("price").cast("double").alias("product_price"), *more)


def _attach_products(events: DataFrame, products: DataFrame, category: DataFrame, store: DataFrame,
                     broadcast_bytes: int, sizes: Sequence[Size], weigh: DataFrame) -> DataFrame:
    """Join the product dimensions with each other first: that leaves one join on the events instead of three.

    A product without a known category or store keeps its own columns; an unknown product has none of them.
    """
    own, of_category, of_store = sizes
    named = attach(products, category, "category_id", broadcast_bytes=broadcast_bytes,
                   weigh=products.select("category_id"), lookup_bytes=of_category.bytes)
    named = attach(named, store, "store_id", broadcast_bytes=broadcast_bytes,
                   weigh=products.select("store_id"), lookup_bytes=of_store.bytes)
    most_bytes = own.bytes + own.rows * (of_category.widest + of_store.widest)
    return attach(events, named.select("product_id", *PRODUCT_COLUMNS), "product_id",
                  broadcast_bytes=broadcast_bytes, weigh=weigh, lookup_bytes=most_bytes)


def enrich(bronze: DataFrame, users: DataFrame, products: DataFrame, categories: DataFrame, stores: DataFrame,
           dims: Collection[str] = ("users", "products"), broadcast_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """Wide events: every bronze event once, with user and product columns or nulls where the key is unknown.

    Each dimension must be a single snapshot, unique on its key. ``dims`` names the joins to make; a mart that reads
    no user columns leaves "users" out, and those columns are null.
    """
    events = _events(bronze)
    lookups = []
    if "users" in dims:
        lookups += [user_lookup(users)]
    if "products" in dims:
        lookups += [product_keys(products), category_lookup(categories), store_lookup(stores)]
    sizes = measure(lookups) if lookups else []

    wide = events
    if "users" in dims:
        wide = attach(wide, lookups[0], "user_id", broadcast_bytes=broadcast_bytes,
                      weigh=events.select("user_id"), lookup_bytes=sizes[0].bytes)
    if "products" in dims:
        wide = _attach_products(wide, *lookups[-3:], broadcast_bytes, sizes[-3:], weigh=events.select("product_id"))
    return _silver(wide)


def enrich_as_of(bronze: DataFrame, snapshots: Mapping[str, DataFrame], periods: Sequence[Period],
                 broadcast_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """Wide events of many days, each joined to the dimensions as of its day, in one job.

    ``snapshots`` are whole dimension tables with their ``date``. Products get the category and store of the same period
    before they are folded to versions, so the events have two joins however many snapshots there are.
    """
    shown = {name: by_period(table, name, periods) for name, table in snapshots.items()}
    products = product_keys(shown["products"], PERIOD)
    named = attach(products, category_lookup(shown["categories"], PERIOD), ["category_id", PERIOD], broadcast_bytes=broadcast_bytes)
    named = attach(named, store_lookup(shown["stores"], PERIOD), ["store_id", PERIOD], broadcast_bytes=broadcast_bytes)
    product_versions = fold_versions(named.select("product_id", *PRODUCT_COLUMNS, PERIOD), "product_id", periods)
    user_versions = fold_versions(user_lookup(shown["users"], PERIOD), "user_id", periods)

    events = _events(bronze)
    wide = attach_as_of(events, user_versions, "user_id", broadcast_bytes=broadcast_bytes)
    wide = attach_as_of(wide, product_versions, "product_id", broadcast_bytes=broadcast_bytes, weigh=events)
    return _silver(wide)


def _events(bronze: DataFrame) -> DataFrame:
    return bronze.select(
        "event_id", F.timestamp_seconds("occurred_at").alias("occurred_at"), "event_type", "platform",
        F.col("user_id").cast("bigint").alias("user_id"), F.col("product_id").cast("bigint").alias("product_id"),
        "date", "hour")


def _silver(wide: DataFrame) -> DataFrame:
    """The columns of the silver contract; those that were not joined are null."""
    return wide.select(*[
        F.col(f.name) if f.name in wide.columns else F.lit(None).cast(f.dataType).alias(f.name)
        for f in SILVER_EVENTS])
