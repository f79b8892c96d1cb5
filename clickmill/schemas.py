"""Table contracts: one StructType per table, partition keys last."""

from __future__ import annotations

from pyspark.sql import types as T

# The event vocabulary and the platforms of the clickstream.
SEARCH = "SEARCH"
VIEW_PRODUCT = "VIEW_PRODUCT"
ADD_TO_CART = "ADD_TO_CART"
PURCHASE = "PURCHASE"
FUNNEL_STEPS = (SEARCH, VIEW_PRODUCT, ADD_TO_CART, PURCHASE)
PLATFORMS = ("WEB", "IOS", "ANDROID")


_TYPES = {"string": T.StringType(), "bigint": T.LongType(), "int": T.IntegerType(), "double": T.DoubleType(),
          "boolean": T.BooleanType(), "binary": T.BinaryType(), "timestamp": T.TimestampType(), "date": T.DateType()}


def _struct(columns: str) -> T.StructType:
    """A struct from "name type, name type"; unlike StructType.fromDDL it needs no running session."""
    pairs = (column.split() for column in columns.split(","))
    return T.StructType([T.StructField(name, _TYPES[kind]) for name, kind in pairs])


EVENT_MESSAGE = _struct(
    "event_id string, user_id bigint, product_id bigint, event_type string, platform string, occurred_at string")

HOT_EVENTS = _struct(
    "event_id string, user_id bigint, product_id bigint, event_type string, platform string, "
    "occurred_at timestamp, date string, hour string")

BRONZE_EVENTS = _struct(
    "event_id string, user_id bigint, product_id bigint, event_type string, platform string, "
    "occurred_at bigint, date string, hour string")

USERS = _struct(
    "user_id bigint, username string, email string, full_name string, created_at timestamp, date string")

CATEGORIES = _struct(
    "category_id bigint, parent_id bigint, name string, slug string, level int, date string")

STORES = _struct(
    "store_id bigint, owner_id bigint, address string, store_name string, is_official_store boolean, "
    "rating double, created_at timestamp, date string")

PRODUCTS = _struct(
    "product_id bigint, store_id bigint, category_id bigint, name string, description string, price double, "
    "stock_quantity int, created_at timestamp, date string")

SILVER_EVENTS = _struct(
    "event_id string, occurred_at timestamp, event_type string, platform string, user_id bigint, username string, "
    "full_name string, product_id bigint, email string, user_created_at timestamp, product_name string, "
    "product_price double, category_name string, store_name string, date string, hour string")

CUSTOMER_PROFILE = _struct(
    "customer_id bigint, fullname string, email string, created_at timestamp, last_active_date date, "
    "total_transactions bigint, primary_device string, date string, hour string")

FUNNEL_CONVERSION = _struct(
    "log_date string, device_type string, step_1_visit bigint, step_2_view_product bigint, "
    "step_3_initiate_checkout bigint, step_4_purchase_success bigint, conversion_rate_overall double, "
    "date string, hour string")

RFM_SEGMENTS = _struct(
    "customer_id bigint, recency_value int, frequency_value int, monetary_value double, r_score int, f_score int, "
    "m_score int, rfm_cell string, segment_name string, date string, hour string")

SESSION_PERFORMANCE = _struct(
    "log_date string, total_sessions bigint, total_users bigint, bounce_sessions bigint, bounce_rate double, "
    "avg_events_per_session double, operating_system string, date string")

# Hourly summaries that merge to days.
SESSION_PIECES = _struct(
    "user_id bigint, block bigint, platform string, first_second bigint, last_second bigint, events bigint, "
    "date string, hour string")
FUNNEL_BITMAPS = _struct("platform string, step int, bucket bigint, users binary, date string, hour string")
USER_SKETCHES = _struct("platform string, users binary, date string, hour string")

DIMENSIONS = {"users": USERS, "categories": CATEGORIES, "stores": STORES, "products": PRODUCTS}
DIMENSION_KEYS = {"users": "user_id", "categories": "category_id", "stores": "store_id", "products": "product_id"}

# schema.table -> (contract, partition columns)
LAKE_TABLES = {
    "metadata.users": (USERS, ("date",)),
    "metadata.categories": (CATEGORIES, ("date",)),
    "metadata.stores": (STORES, ("date",)),
    "metadata.products": (PRODUCTS, ("date",)),
    "metadata.events": (BRONZE_EVENTS, ("date", "hour")),
    "silver.wide_table_events": (SILVER_EVENTS, ("date", "hour")),
    "gold.dim_customer_profile": (CUSTOMER_PROFILE, ("date", "hour")),
    "gold.fact_funnel_conversion": (FUNNEL_CONVERSION, ("date", "hour")),
    "gold.fact_rfm_segments": (RFM_SEGMENTS, ("date", "hour")),
    "gold.fact_session_performance": (SESSION_PERFORMANCE, ("date",)),
}
