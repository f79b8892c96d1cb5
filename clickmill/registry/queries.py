"""The registered queries: every operator over the whole benchmark tables."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clickmill import schemas
from clickmill.functions.columns import canonical_uuid, date_key, hour_key, month_key, name_uuid, slug
from clickmill.operators import dimensions as dims
from clickmill.operators.dedup import dedup, unified_events
from clickmill.operators.enrich import enrich, enrich_as_of, user_lookup
from clickmill.operators.lookup import attach_bucketed
from clickmill.operators.messages import encode_events, good_events, parse_messages, quarantined
from clickmill.operators.sessions import assign_sessions, session_spans
from clickmill.operators.tiering import archive_split, to_bronze
from clickmill.operators.versions import cut_periods, require_snapshots
from clickmill.plans import hourly, summaries
from clickmill.plans.funnel import STEP_COLUMNS, funnel_conversion
from clickmill.plans.product_sales import product_sales, top_products
from clickmill.plans.profile import customer_profile
from clickmill.plans.rfm import rfm_segments
from clickmill.plans.session_performance import session_performance
from clickmill.registry import testbed
from clickmill.session import apply_runtime_conf, shared_folder
from clickmill.sources import catalog, sinks
from clickmill.sources.lake import find_rows, list_files, read_partition, read_table
from clickmill.sources.topics import read_message_files
from clickmill.streaming.ingest import distinct_events, start_ingest
from clickmill.streaming.live import append_to_files, live_funnel, live_sessions
from clickmill.streaming.silver import LIVE_TABLE, start_live_silver

Query = Callable[[SparkSession, str], DataFrame]
REGISTRY: dict[str, Query] = {}

ANY_ID = r"^\d+$"  # the benchmark's event ids are numbers, not UUIDs
HOUR = ("date", "hour")


def register(name: str) -> Callable[[Query], Query]:
    def add(build: Query) -> Query:
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return portable(build(apply_runtime_conf(spark), sf_dir))
        REGISTRY[name] = run
        return build
    return add


def portable(df: DataFrame) -> DataFrame:
    """Types that compare the same in both engines: times and dates as text, integers as bigint."""
    def column(name: str, dtype: str):
        col = F.col(f"`{name}`")
        if dtype.startswith("timestamp"):
            col = F.date_format(col, "yyyy-MM-dd HH:mm:ss")
        elif dtype == "date":
            col = F.date_format(col, "yyyy-MM-dd")
        elif dtype in ("int", "smallint", "tinyint"):
            col = col.cast("bigint")
        return col.alias(name)
    return df.select(*[column(n, t) for n, t in df.dtypes])


def _silver(spark: SparkSession, sf_dir: str, **options) -> DataFrame:
    return enrich(testbed.bronze_events(spark, sf_dir), **testbed.dimensions(spark, sf_dir), **options)


@register("bronze_export_projection")
def bronze_export_projection(spark, sf_dir):
    return to_bronze(testbed.hot_events(spark, sf_dir))


INTERVAL = ("2024-01-10 06:00:00", "2024-01-20 18:00:00")


@register("hot_interval_archive")
def hot_interval_archive(spark, sf_dir):
    return archive_split(testbed.hot_events(spark, sf_dir), *INTERVAL)[0]


@register("hot_interval_retained")
def hot_interval_retained(spark, sf_dir):
    return archive_split(testbed.hot_events(spark, sf_dir), *INTERVAL)[1]


@register("silver_enriched_events")
def silver_enriched_events(spark, sf_dir):
    return _silver(spark, sf_dir)


@register("silver_enriched_shuffled")
def silver_enriched_shuffled(spark, sf_dir):
    """The join path for dimensions that are too large to broadcast."""
    return _silver(spark, sf_dir, broadcast_bytes=0)


def _dimension_history(spark, sf_dir) -> dict[str, dict[str, DataFrame]]:
    """Snapshots by date over January: users change twice and some go and come back, half of the prices and all categories change once."""
    frames = testbed.dimensions(spark, sf_dir)
    gone = testbed.table(spark, sf_dir, "customer").where("c_mktsegment = 'MACHINERY'").select(F.col("c_custkey").alias("user_id"))
    users, products, categories = frames["users"], frames["products"], frames["categories"]
    dearer = F.when(F.col("product_id") % 2 == 0, F.col("price") * 2).otherwise(F.col("price"))
    return {
        "users": {"2024-01-01": users, "2024-01-11": users.join(gone, "user_id", "left_anti").withColumn("full_name", F.upper("full_name")),
                  "2024-01-21": users},
        "products": {"2024-01-01": products, "2024-01-16": products.withColumn("price", dearer)},
        "categories": {"2024-01-01": categories, "2024-01-21": categories.withColumn("name", F.lower("name"))},
        "stores": {"2024-01-01": frames["stores"]}}


def _changing_dimensions(spark, sf_dir) -> dict[str, DataFrame]:
    """These snapshots written, as whole tables."""
    out = {}
    for name, snapshots in _dimension_history(spark, sf_dir).items():
        root = shared_folder(spark, name)
        for date, frame in snapshots.items():
            dims.write_snapshot(frame, root, date, schemas.DIMENSIONS[name])
        out[name] = read_table(spark, root, schemas.DIMENSIONS[name])
    return out


def _asof(spark, sf_dir, **options):
    tables = _changing_dimensions(spark, sf_dir)
    dates = {"users": ["2024-01-01", "2024-01-11", "2024-01-21"], "products": ["2024-01-01", "2024-01-16"],
             "categories": ["2024-01-01", "2024-01-21"], "stores": ["2024-01-01"]}
    periods = cut_periods(dates, "2024-01-01", "2024-12-31")
    require_snapshots(tables, schemas.DIMENSION_KEYS, periods)
    return enrich_as_of(testbed.bronze_events(spark, sf_dir), tables, periods, **options)


@register("silver_asof_intervals")
def silver_asof_intervals(spark, sf_dir):
    """All events joined to the dimensions of their day, over several snapshots, in one job."""
    return _asof(spark, sf_dir)


@register("silver_asof_shuffled")
def silver_asof_shuffled(spark, sf_dir):
    """The same for versions that are too large to broadcast."""
    return _asof(spark, sf_dir, broadcast_bytes=0)


@register("users_from_buckets")
def users_from_buckets(spark, sf_dir):
    """All events joined to users that lie in a bucketed table, so only the events are shuffled."""
    root = shared_folder(spark, "buckets")
    name = "clickmill_" + root.rsplit("-", 1)[1]
    catalog.create_schema(spark, name, root)
    users = f"`{name}`.`users`"
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    catalog.write_bucketed(user_lookup(testbed.users(spark, sf_dir)), users, f"{root}/users", "user_id", buckets)
    return attach_bucketed(testbed.hot_events(spark, sf_dir), spark.table(users), "user_id").select(
        "event_id", "user_id", "username", "full_name", "email", "user_created_at")


@register("silver_partition_slice")
def silver_partition_slice(spark, sf_dir):
    """Write the whole silver table by hour, then read one day's folder."""
    root = shared_folder(spark, "silver")
    sinks.overwrite_partitions(_silver(spark, sf_dir), root, HOUR, sinks.EVENT_SORT)
    return read_partition(spark, root, schemas.SILVER_EVENTS, "2024-01-12")


@register("latest_dimension_snapshot")
def latest_dimension_snapshot(spark, sf_dir):
    root = shared_folder(spark, "users")
    users = testbed.users(spark, sf_dir)
    kept = testbed.table(spark, sf_dir, "customer").where("c_mktsegment <> 'MACHINERY'").select(
        F.col("c_custkey").alias("user_id"))
    changed = users.join(kept, "user_id", "left_semi").withColumn("full_name", F.upper("full_name"))
    dims.write_snapshot(users, root, "2024-01-01", schemas.USERS)
    dims.write_snapshot(changed, root, "2024-01-15", schemas.USERS)
    dims.write_snapshot(users.withColumn("full_name", F.lower("full_name")), root, "2024-02-01", schemas.USERS)
    newest = dims.latest_snapshot(read_table(spark, root, schemas.USERS), "2024-01-30")
    return dims.require_unique(newest, ["user_id"]).select("user_id", "full_name", "date")


# --- marts ---------------------------------------------------------------------------------------------------------

@register("customer_profile")
def customer_profile_hourly(spark, sf_dir):
    return customer_profile(_silver(spark, sf_dir, dims=("users",)))


@register("customer_profile_daily")
def customer_profile_daily(spark, sf_dir):
    return customer_profile(_silver(spark, sf_dir, dims=("users",)), grain=("date",))


@register("funnel_hourly")
def funnel_hourly(spark, sf_dir):
    return funnel_conversion(_silver(spark, sf_dir, dims=()))


@register("funnel_daily")
def funnel_daily(spark, sf_dir):
    return funnel_conversion(_silver(spark, sf_dir, dims=()), grain=("date",))


@register("rfm_hourly")
def rfm_hourly(spark, sf_dir):
    return rfm_segments(_silver(spark, sf_dir, dims=("products",)))


@register("rfm_daily")
def rfm_daily(spark, sf_dir):
    return rfm_segments(_silver(spark, sf_dir, dims=("products",)), grain=("date",))


@register("rfm_daily_distributed")
def rfm_daily_distributed(spark, sf_dir):
    """Daily scores with cut rows that are counted down to a few users before anything is sorted."""
    return rfm_segments(_silver(spark, sf_dir, dims=("products",)), grain=("date",), most_rows=8)


@register("rfm_global")
def rfm_global(spark, sf_dir):
    """Scores over all users and days at once."""
    return rfm_segments(_silver(spark, sf_dir, dims=("products",)), grain=())


@register("session_assignment")
def session_assignment(spark, sf_dir):
    return assign_sessions(testbed.hot_events(spark, sf_dir)).select("event_id", "session_id")


@register("session_assignment_shuffled")
def session_assignment_shuffled(spark, sf_dir):
    """The join path for more blocks than may be broadcast."""
    return assign_sessions(testbed.hot_events(spark, sf_dir), broadcast_bytes=0).select("event_id", "session_id")


@register("session_summary")
def session_summary(spark, sf_dir):
    return session_spans(testbed.hot_events(spark, sf_dir)).select(
        "date", "user_id", "session_start", "session_end", "events")


@register("session_performance_daily")
def session_performance_daily(spark, sf_dir):
    return session_performance(_silver(spark, sf_dir, dims=()))


@register("session_users_approx_ok")
def session_users_approx_ok(spark, sf_dir):
    """Is the sketch of users within 15 % of the exact count, per day and platform?"""
    silver = _silver(spark, sf_dir, dims=())
    exact = session_performance(silver).select("date", "operating_system", "total_users")
    rough = session_performance(silver, approximate_users=True).select(
        "date", "operating_system", F.col("total_users").alias("rough"))
    close = F.abs(F.col("rough") - F.col("total_users")) <= 0.15 * F.col("total_users")
    return exact.join(rough, ["date", "operating_system"]).select("date", "operating_system", close.alias("close"))


def _summarised(spark, sf_dir, name):
    """The hourly summaries of all silver, stored by hour and read back."""
    root = shared_folder(spark, name)
    summary = summaries.SUMMARIES[name]
    sinks.overwrite_partitions(summary.summarise(_silver(spark, sf_dir, dims=())), root, HOUR)
    return read_table(spark, root, summary.contract)


@register("session_performance_from_hours")
def session_performance_from_hours(spark, sf_dir):
    """The daily session mart merged from hourly pieces."""
    return summaries.sessions_by_day(_summarised(spark, sf_dir, "session_pieces"))


@register("funnel_daily_from_hours")
def funnel_daily_from_hours(spark, sf_dir):
    """The daily funnel from hourly bitmaps."""
    return summaries.funnel_from_bitmaps(_summarised(spark, sf_dir, "funnel_bitmaps"))


@register("users_from_sketches_ok")
def users_from_sketches_ok(spark, sf_dir):
    """Are the users of a day, from hourly sketches, within three standard errors, 5 %, or one user, of the exact count?"""
    rough = summaries.users_from_sketches(_summarised(spark, sf_dir, "user_sketches"))
    exact = session_performance(_silver(spark, sf_dir, dims=())).select(
        "date", F.col("operating_system").alias("platform"), "total_users")
    close = F.abs(F.col("users") - F.col("total_users")) <= F.greatest(F.lit(1.0), 0.05 * F.col("total_users"))
    return exact.join(rough, ["date", "platform"]).select("date", F.col("platform").alias("operating_system"), close.alias("close"))


def _sales(spark, sf_dir, **options):
    return product_sales(testbed.hot_events(spark, sf_dir), testbed.products(spark, sf_dir), **options)


@register("product_sales")
def product_sales_all(spark, sf_dir):
    return _sales(spark, sf_dir).withColumn("total_revenue", F.round("total_revenue", 2))


@register("product_sales_purchases")
def product_sales_purchases(spark, sf_dir):
    return _sales(spark, sf_dir, event_types=[schemas.PURCHASE]).withColumn(
        "total_revenue", F.round("total_revenue", 2))


@register("product_sales_topk")
def product_sales_topk(spark, sf_dir):
    return top_products(product_sales_all(spark, sf_dir), 10)


# --- union, duplicates, messages, scalar functions ------------------------------------------------------------------

@register("hot_cold_union")
def hot_cold_union(spark, sf_dir):
    """A cold tier up to the 20th and a hot tier from the 18th, overlapping, as one table."""
    events = testbed.hot_events(spark, sf_dir)
    cold = to_bronze(events.where("date <= '2024-01-20'")).withColumn(
        "occurred_at", F.timestamp_seconds("occurred_at"))
    return unified_events(cold, events.where("date >= '2024-01-18'")).select(*schemas.HOT_EVENTS.names)


@register("dedup_events")
def dedup_events(spark, sf_dir):
    events = testbed.hot_events(spark, sf_dir)
    return dedup(events.unionByName(events.where("event_type = 'PURCHASE'")))


@register("event_json_roundtrip")
def event_json_roundtrip(spark, sf_dir):
    return good_events(parse_messages(encode_events(testbed.hot_events(spark, sf_dir)), ANY_ID))


@register("quarantine_bad_json")
def quarantine_bad_json(spark, sf_dir):
    """Break all messages of four event types, each type in its own way, and sort good from bad."""
    kind = F.col("event_type")
    encoded = testbed.hot_events(spark, sf_dir).select(
        kind, F.to_json(F.struct(
            "event_id", "user_id", "product_id", "event_type", "platform",
            F.date_format("occurred_at", "yyyy-MM-dd HH:mm:ss").alias("occurred_at"))).alias("value"))
    value = F.col("value")
    broken = (F.when(kind == "ERROR", F.regexp_replace(value, r"\}$", ""))
              .when(kind == "VIEW_PRODUCT", F.regexp_replace(value, r'"user_id":(\d+)', r'"user_id":"u$1"'))
              .when(kind == "ADD_TO_CART", F.regexp_replace(value, r'"occurred_at":"[^"]*"', '"occurred_at":"soon"'))
              .when(kind == "SEARCH", F.regexp_replace(value, r'"platform":"[^"]*",', ""))
              .otherwise(value))
    parsed = parse_messages(encoded.select(broken.alias("value")), ANY_ID)
    good = good_events(parsed).select(F.lit("good").alias("outcome"), "event_id")
    bad = quarantined(parsed).select(
        F.col("problem").alias("outcome"), F.regexp_extract("message", r'"event_id":"(\d+)"', 1).alias("event_id"))
    return good.unionByName(bad)


@register("category_slug")
def category_slug(spark, sf_dir):
    part = testbed.table(spark, sf_dir, "part")
    return (part.groupBy("p_brand", "p_type").agg(F.count(F.lit(1)).alias("parts"))
            .select(F.col("p_type").alias("name"), slug(F.concat_ws(" ", "p_brand", "p_type")).alias("slug"), "parts"))


@register("month_bucket_counts")
def month_bucket_counts(spark, sf_dir):
    events = testbed.table(spark, sf_dir, "events")
    return events.groupBy(month_key(F.col("ts")).alias("month"), "event_type").agg(F.count(F.lit(1)).alias("events"))


@register("dimension_probe")
def dimension_probe(spark, sf_dir):
    """Which dimensions hold rows; one more is made empty on purpose."""
    frames = testbed.dimensions(spark, sf_dir)
    frames["nobody"] = frames["users"].where("user_id < 0")
    answers = [dims.loaded(frame).select(F.lit(name).alias("dimension"), "loaded") for name, frame in frames.items()]
    return reduce(DataFrame.unionByName, answers)


# --- streaming ------------------------------------------------------------------------------------------------------

CLOSING_USER = 4294967295


def _message_files(spark: SparkSession, sf_dir: str, closing: bool) -> DataFrame:
    """All events as a stream of message files; ``closing`` adds one event a week after the last, as its own hour.

    In append mode a window appears once the watermark has passed it, and the closing event moves the watermark.
    """
    events = testbed.hot_events(spark, sf_dir)
    folder = shared_folder(spark, "messages")
    encode_events(events).select("value").write.text(folder)
    if closing:
        last = events.agg(F.timestamp_seconds(F.unix_timestamp(F.max("occurred_at")) + 7 * 86400).alias("occurred_at"))
        end = last.select(
            F.lit("0").alias("event_id"), F.lit(CLOSING_USER).cast("bigint").alias("user_id"),
            F.lit(0).cast("bigint").alias("product_id"), F.lit("CLOSE").alias("event_type"),
            F.lit("CLOSE").alias("platform"), "occurred_at")
        encode_events(end).select("value").write.mode("append").text(folder)
    return read_message_files(spark, folder)


def _finished(query) -> None:
    query.awaitTermination()
    if query.exception():
        raise query.exception()


@register("stream_ingest_dedup")
def stream_ingest_dedup(spark, sf_dir):
    """Ingest every message twice into one root, the second time as a replay with a fresh checkpoint; read without copies."""
    hot, bad = shared_folder(spark, "hot"), shared_folder(spark, "quarantine")
    messages = _message_files(spark, sf_dir, closing=False)
    for _ in range(2):
        _finished(start_ingest(messages, hot, bad, shared_folder(spark, "offsets"), ANY_ID))
    return dedup(read_table(spark, hot, schemas.HOT_EVENTS))


@register("stream_silver")
def stream_silver(spark, sf_dir):
    """All messages in the order of time, in small batches, while new snapshots appear between them; one checkpoint."""
    root, messages, offsets = (shared_folder(spark, name) for name in ("lake", "messages", "offsets"))
    lake = hourly.Lake(f"{root}/cold", f"{root}/hot")
    events, history = testbed.hot_events(spark, sf_dir), _dimension_history(spark, sf_dir)
    days = ["2024-01-01", "2024-01-11", "2024-01-16", "2024-01-21", "9999"]
    for first, end in zip(days, days[1:]):
        for name, snapshots in history.items():
            if first in snapshots:
                dims.write_snapshot(snapshots[first], lake.folder(f"metadata.{name}"), first, schemas.DIMENSIONS[name])
        part = events.where((F.col("date") >= first) & (F.col("date") < end))
        encode_events(part).select("value").repartition(2).write.mode("append").text(messages)
        _finished(start_live_silver(read_message_files(spark, messages, max_files=2), lake, offsets, ANY_ID))
    return read_table(spark, lake.folder(LIVE_TABLE), schemas.SILVER_EVENTS)


@register("stream_restart")
def stream_restart(spark, sf_dir):
    """All messages in many micro-batches: the stream ends in mid-topic as if its machine was lost after the last write, goes on
    from its checkpoint, and the hot batches are merged. Events, ids and files per hour."""
    hot, bad, messages, offsets = (shared_folder(spark, name) for name in ("hot", "quarantine", "messages", "offsets"))
    events = testbed.hot_events(spark, sf_dir)
    for part in (events.where("date < '2024-01-15'"), events.where("date >= '2024-01-15' OR date IS NULL")):
        encode_events(part.repartitionByRange(4, "occurred_at")).select("value").write.mode("append").text(messages)
        _finished(start_ingest(read_message_files(spark, messages, max_files=1), hot, bad, offsets, ANY_ID))
        # without its last commit a restarted stream repeats that batch
        done = max(int(path.rsplit("/", 1)[1]) for path in list_files(spark, f"{offsets}/commits"))
        sinks.remove_paths(spark, [f"{offsets}/commits/{done}", f"{offsets}/commits/.{done}.crc"])
    _finished(start_ingest(read_message_files(spark, messages, max_files=1), hot, bad, offsets, ANY_ID))
    hourly.compact_hot(spark, hot)
    stored = spark.read.schema(hourly.HOT_BATCHES).parquet(hot)
    return stored.groupBy(*HOUR).agg(
        F.count(F.lit(1)).alias("events"), F.count_distinct("event_id").alias("ids"),
        F.count_distinct("batch").alias("batches"))


@register("stream_distinct_events")
def stream_distinct_events(spark, sf_dir):
    """Every message sent twice, with duplicates removed by the stream's own state."""
    messages = _message_files(spark, sf_dir, closing=False)
    events = good_events(parse_messages(messages.unionByName(messages), ANY_ID))
    out = shared_folder(spark, "distinct")
    _finished(append_to_files(distinct_events(events, "40 days"), out, shared_folder(spark, "offsets")))
    return spark.read.schema(schemas.HOT_EVENTS).parquet(out)


@register("stream_sessions")
def stream_sessions(spark, sf_dir):
    events = good_events(parse_messages(_message_files(spark, sf_dir, closing=True), ANY_ID))
    out = shared_folder(spark, "sessions")
    _finished(append_to_files(live_sessions(events, "10 minutes"), out, shared_folder(spark, "offsets")))
    return spark.read.parquet(out).where(F.col("user_id") != CLOSING_USER)


def _stream_funnel(spark, sf_dir, approximate):
    events = good_events(parse_messages(_message_files(spark, sf_dir, closing=True), ANY_ID))
    out = shared_folder(spark, "funnel")
    _finished(append_to_files(live_funnel(events, "10 minutes", approximate), out, shared_folder(spark, "offsets")))
    return spark.read.parquet(out).where("device_type <> 'CLOSE'")


@register("stream_funnel")
def stream_funnel(spark, sf_dir):
    return _stream_funnel(spark, sf_dir, approximate=False)


@register("stream_funnel_approx")
def stream_funnel_approx(spark, sf_dir):
    """Each hour and platform, and whether all its sketched counts are within a tenth, or one user, of the exact ones."""
    keys = ["log_date", "hour", "device_type"]
    exact = funnel_conversion(_silver(spark, sf_dir, dims=()))
    near = reduce(lambda a, b: a & b, [
        F.abs(F.col(f"a.{c}") - F.col(f"e.{c}")) <= F.greatest(F.lit(1.0), 0.1 * F.col(f"e.{c}")) for c in STEP_COLUMNS])
    rows = _stream_funnel(spark, sf_dir, approximate=True).alias("a").join(exact.alias("e"), keys, "full")
    return rows.select(*keys, F.coalesce(near, F.lit(False)).alias("close"))


# --- sinks, catalog, whole hours ------------------------------------------------------------------------------------

@register("partition_replace_roundtrip")
def partition_replace_roundtrip(spark, sf_dir):
    """Write bronze by hour, replace one hour by itself and another by nothing, read all of it back."""
    root = shared_folder(spark, "bronze")
    bronze = testbed.bronze_events(spark, sf_dir)
    sinks.overwrite_partitions(bronze, root, HOUR, sinks.EVENT_SORT)
    sinks.replace_partition(bronze.where("date = '2024-01-20' AND hour = '09'"), root,
                            {"date": "2024-01-20", "hour": "09"}, sinks.EVENT_SORT)
    sinks.replace_partition(bronze.where("false"), root, {"date": "2024-01-20", "hour": "10"})
    return read_table(spark, root, schemas.BRONZE_EVENTS)


@register("point_reads")
def point_reads(spark, sf_dir):
    """All bronze events with Bloom filters on their ids; the first and last event of each type, and an id that is not there."""
    root = shared_folder(spark, "bronze")
    bronze = testbed.bronze_events(spark, sf_dir)
    sinks.overwrite_partitions(bronze, root, HOUR, sinks.EVENT_SORT, bloom=sinks.EVENT_BLOOM)
    ends = bronze.groupBy("event_type").agg(F.min("event_id").alias("low"), F.max("event_id").alias("high")).collect()  # per type
    wanted = [value for row in ends for value in (row["low"], row["high"])]
    return find_rows(spark, root, schemas.BRONZE_EVENTS, "event_id", [*wanted, "none"])


@register("published_versions")
def published_versions(spark, sf_dir):
    """The funnel by name through three versions: all hours with doubled counts, all hours, and again the later half."""
    root = shared_folder(spark, "published")
    name = "clickmill_" + root.rsplit("-", 1)[1]
    catalog.create_schema(spark, name, root)
    table, folder = f"`{name}`.`funnel`", f"{root}/funnel"
    catalog.create_table(spark, table, schemas.FUNNEL_CONVERSION, folder, ("log_date",))
    funnel = funnel_conversion(_silver(spark, sf_dir, dims=()))
    doubled = funnel.select(*[(2 * F.col(c)).cast(t).alias(c) if c in STEP_COLUMNS else F.col(c) for c, t in funnel.dtypes])
    catalog.publish_version(doubled, table, folder, ("log_date",))
    catalog.publish_version(funnel, table, folder, ("log_date",))
    catalog.publish_version(funnel.where("log_date >= '2024-01-15'"), table, folder, ("log_date",))
    catalog.drop_versions(spark, table, folder, ("log_date",))
    return spark.table(table).select(*funnel.columns)


@register("catalog_reload")
def catalog_reload(spark, sf_dir):
    """Managed users loaded twice, emptied before the second load; a table dropped; a snapshot of an empty source left out."""
    root = shared_folder(spark, "managed")
    name = "clickmill_" + root.rsplit("-", 1)[1]
    catalog.create_schema(spark, name, root)
    users, gone = f"`{name}`.`users`", f"`{name}`.`gone`"
    rows = testbed.users(spark, sf_dir)
    rows.write.saveAsTable(users)
    rows.write.saveAsTable(gone)
    catalog.truncate_tables(spark, [users])
    rows.write.insertInto(users)
    catalog.drop_table(spark, gone)
    outcome = dims.write_snapshot(rows.where("false"), f"{root}/snapshots", "2024-01-01", schemas.USERS)
    return spark.table(users).select("user_id", "username", F.lit(spark.catalog.tableExists(gone)).alias("gone_exists"),
                                     F.lit(outcome).alias("empty_snapshot"))


@register("uuid_roundtrip")
def uuid_roundtrip(spark, sf_dir):
    """An id for each event, written in four common forms and read back."""
    events = testbed.table(spark, sf_dir, "events").select("event_id", name_uuid(F.col("event_id")).alias("id"))
    form = F.col("event_id") % 4
    written = (F.when(form == 0, F.upper("id")).when(form == 1, F.concat(F.lit("{"), "id", F.lit("}")))
               .when(form == 2, F.concat(F.lit("urn:uuid:"), "id")).otherwise(F.replace(F.col("id"), F.lit("-"), F.lit(""))))
    return events.select("event_id", canonical_uuid(written).alias("uuid"))


@register("gold_overwrite_roundtrip")
def gold_overwrite_roundtrip(spark, sf_dir):
    """Write the funnel for all hours, then again for the later half: each hour must be there once."""
    root = shared_folder(spark, "funnel")
    funnel = funnel_conversion(_silver(spark, sf_dir, dims=()))
    sinks.overwrite_partitions(funnel, root, HOUR)
    sinks.overwrite_partitions(funnel.where("date >= '2024-01-15'"), root, HOUR)
    return read_table(spark, root, schemas.FUNNEL_CONVERSION)


def _hot_tier(spark: SparkSession, sf_dir: str) -> hourly.Lake:
    """A new lake whose hot tier holds all events as one ingested batch."""
    root = shared_folder(spark, "lake")
    lake = hourly.Lake(f"{root}/cold", f"{root}/hot")
    sinks.overwrite_partitions(testbed.hot_events(spark, sf_dir).withColumn("batch", F.lit("0")), lake.hot,
                               (*HOUR, "batch"))
    return lake


@register("hour_archive_roundtrip")
def hour_archive_roundtrip(spark, sf_dir):
    """Archive three hours, one of them twice; both tiers together must still hold every event once."""
    lake = _hot_tier(spark, sf_dir)
    for hour in ("00", "01", "02", "01"):
        hourly.archive_hour(spark, lake, "2024-01-03", hour)
    hot = read_table(spark, lake.hot, schemas.HOT_EVENTS).select(*HOUR)
    cold = read_table(spark, lake.folder("metadata.events"), schemas.BRONZE_EVENTS).select(*HOUR)
    return hot.unionByName(cold).groupBy(*HOUR).agg(F.count(F.lit(1)).alias("events"))


@register("late_hours_recomputed")
def late_hours_recomputed(spark, sf_dir):
    """Run all hours, let every fiftieth event arrive late, run what is pending again; totals per hour and day."""
    root = shared_folder(spark, "lake")
    lake = hourly.Lake(f"{root}/cold", f"{root}/hot")
    for name, frame in testbed.dimensions(spark, sf_dir).items():
        dims.write_snapshot(frame, lake.folder(f"metadata.{name}"), "2024-01-01", schemas.DIMENSIONS[name])
    events, late = testbed.hot_events(spark, sf_dir), F.col("event_id").cast("bigint") % 50 == 0
    for batch, part in (("first", events.where(~late)), ("late", events.where(late))):
        sinks.overwrite_partitions(part.withColumn("batch", F.lit(batch)), lake.hot, (*HOUR, "batch"))
        hourly.run_pending(spark, lake, "9999", ["funnel_conversion", "session_performance"])
    silver = read_table(spark, lake.folder("silver.wide_table_events"), schemas.SILVER_EVENTS)
    funnel = read_table(spark, lake.folder("gold.fact_funnel_conversion"), schemas.FUNNEL_CONVERSION)
    sessions = read_table(spark, lake.folder("gold.fact_session_performance"), schemas.SESSION_PERFORMANCE)
    return (silver.groupBy(*HOUR).agg(F.count(F.lit(1)).alias("n")).select(F.lit("silver").alias("part"), *HOUR, "n")
            .unionByName(funnel.groupBy(*HOUR).agg(F.sum("step_4_purchase_success").alias("n"))
                         .select(F.lit("buyers").alias("part"), *HOUR, "n"))
            .unionByName(sessions.groupBy("date").agg(F.sum("total_sessions").alias("n"))
                         .select(F.lit("sessions").alias("part"), "date", F.lit("").alias("hour"), "n")))


@register("catalog_sync_roundtrip")
def catalog_sync_roundtrip(spark, sf_dir):
    """External table over a partitioned folder, read by name after its partitions are registered."""
    root = shared_folder(spark, "catalog")
    name = "clickmill_" + root.rsplit("-", 1)[1]
    sinks.overwrite_partitions(testbed.bronze_events(spark, sf_dir), f"{root}/events", HOUR)
    catalog.create_schema(spark, name, root)
    table = f"`{name}`.`events`"
    catalog.create_table(spark, table, schemas.BRONZE_EVENTS, f"{root}/events", HOUR)
    catalog.sync_partitions(spark, table, "ADD")
    sinks.remove_paths(spark, [f"{root}/events/date=2024-01-05/hour=07"])  # the catalog still lists it
    catalog.sync_partitions(spark, table, "FULL")
    return spark.table(table).groupBy(*HOUR).agg(F.count(F.lit(1)).alias("events"))


@register("snapshot_if_absent")
def snapshot_if_absent(spark, sf_dir):
    """The second snapshot of the same date must not replace the first."""
    root = shared_folder(spark, "products")
    products = testbed.products(spark, sf_dir)
    dims.write_snapshot(products, root, "2024-01-30", schemas.PRODUCTS)
    dims.write_snapshot(products.withColumn("price", F.lit(0.0)), root, "2024-01-30", schemas.PRODUCTS)
    return read_table(spark, root, schemas.PRODUCTS).select("product_id", "name", "price", "date")


@register("gold_backfill")
def gold_backfill(spark, sf_dir):
    """Silver and the four marts for all days, written to a lake; rows and a sum of their values per table and day."""
    root = shared_folder(spark, "lake")
    lake = hourly.Lake(f"{root}/cold", f"{root}/hot")
    sinks.overwrite_partitions(testbed.bronze_events(spark, sf_dir), lake.folder("metadata.events"), HOUR,
                               sinks.EVENT_SORT)
    for name, frame in testbed.dimensions(spark, sf_dir).items():
        dims.write_snapshot(frame, lake.folder(f"metadata.{name}"), "2024-01-01", schemas.DIMENSIONS[name])
    hourly.backfill(spark, lake, "2024-01-01", "2024-12-31")
    tables = {"silver": "silver.wide_table_events", **{name: mart.table for name, mart in hourly.MARTS.items()}}
    values = {"silver": "user_id + 3 * product_id", "customer_profile": "total_transactions * (customer_id % 97 + 1)",
              "funnel_conversion": "step_1_visit + 2 * step_2_view_product + 3 * step_3_initiate_checkout "
                                   "+ 5 * step_4_purchase_success",
              "rfm_segments": "(r_score + 7 * f_score + 49 * m_score) * (customer_id % 97 + 1)",
              "session_performance": "total_sessions + 2 * total_users + 3 * bounce_sessions"}
    sums = []
    for name, full_name in tables.items():
        contract, _ = schemas.LAKE_TABLES[full_name]
        sums.append(read_table(spark, lake.folder(full_name), contract).groupBy("date").agg(
            F.count(F.lit(1)).alias("out_rows"), F.sum(F.expr(values[name])).cast("bigint").alias("total"))
            .select(F.lit(name).alias("mart"), "date", "out_rows", "total"))
    return reduce(DataFrame.unionByName, sums)
