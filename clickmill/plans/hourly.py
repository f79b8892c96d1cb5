"""The hour's work from hot tier to gold marts, and the same over a range of days."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from clickmill import schemas
from clickmill.operators.dedup import dedup, unified_events
from clickmill.operators.dimensions import latest_snapshot, require_ready
from clickmill.operators.enrich import enrich, enrich_as_of
from clickmill.operators.tiering import merge_archive, to_bronze
from clickmill.operators.versions import Period, cut_periods, require_snapshots
from clickmill.plans.funnel import funnel_conversion
from clickmill.plans.profile import customer_profile
from clickmill.plans.rfm import rfm_segments
from clickmill.plans.session_performance import session_performance
from clickmill.plans.summaries import HOUR, SUMMARIES, read_summary, refresh, rewrite, sessions_by_day, silver_hours
from clickmill.session import materialize, remove_paths, step_tables
from clickmill.sources import sinks
from clickmill.sources.catalog import sync_partitions, table_folder
from clickmill.sources.lake import folders_read, partition_folders, read_hours, read_partition, read_range, read_table

DIMENSION_KEYS = {"users": "user_id", "products": "product_id", "categories": "category_id", "stores": "store_id"}
DAY = ("date",)
HOT_BATCHES = T.StructType([*schemas.HOT_EVENTS.fields, T.StructField("batch", T.StringType())])


@dataclass(frozen=True)
class Mart:
    build: Callable[..., DataFrame]
    table: str
    grain: tuple[str, ...]
    # a daily mart that is merged from hourly summaries: their name and the merge
    summary: str | None = None
    merge: Callable[[DataFrame], DataFrame] | None = None


MARTS = {
    "customer_profile": Mart(customer_profile, "gold.dim_customer_profile", HOUR),
    "funnel_conversion": Mart(funnel_conversion, "gold.fact_funnel_conversion", HOUR),
    "rfm_segments": Mart(rfm_segments, "gold.fact_rfm_segments", HOUR),
    "session_performance": Mart(session_performance, "gold.fact_session_performance", DAY, "session_pieces", sessions_by_day),
}


@dataclass(frozen=True)
class Lake:
    """Folders of one lake. The hot tier may lie elsewhere.

    ``catalog``: prefix of the lake's tables in the catalog, as given to ``register_lake``; None if it has none.
    ``optional``: dimensions that may be empty, whose columns are then null.
    """
    root: str
    hot: str
    catalog: str | None = None
    optional: tuple[str, ...] = ()

    def folder(self, table: str) -> str:
        return table_folder(self.root, table)


def archive_hour(spark: SparkSession, lake: Lake, date: str, hour: str) -> int:
    """Move one event hour from hot to bronze; returns the rows the hour holds afterwards.

    What is in bronze already stays and is merged, so a rerun after the move, or a late event, never empties the hour.
    Exactly the hot batches that were read are deleted, and only after bronze is written: a batch that lands meanwhile
    is left for the next run.
    """
    leaf = f"{lake.hot.rstrip('/')}/date={date}/hour={hour}"
    # The files are listed here, once: later steps see the same batches even if more arrive.
    hot = read_partition(spark, lake.hot, HOT_BATCHES, date, hour)
    batches = [batch for batch, in folders_read(hot, "batch")]
    bronze_root = lake.folder("metadata.events")
    existing = read_partition(spark, bronze_root, schemas.BRONZE_EVENTS, date, hour)
    if not batches:
        return existing.count()
    # Written out first, because the merge reads the partition that it replaces.
    merged = materialize(merge_archive(existing, to_bronze(hot)), "archive")
    rows = sinks.replace_partition(merged, bronze_root, {"date": date, "hour": hour}, sinks.EVENT_SORT, sinks.EVENT_BLOOM)
    remove_paths(spark, [f"{leaf}/batch={number}" for number in batches])
    return rows


def all_events(spark: SparkSession, lake: Lake) -> DataFrame:
    """The events of both tiers as one table, each once; the hot hours are known from the folders that were listed."""
    cold = read_table(spark, lake.folder("metadata.events"), schemas.BRONZE_EVENTS)
    hot = read_table(spark, lake.hot, HOT_BATCHES)
    return unified_events(cold, to_bronze(hot).select(*cold.columns), live_hours=folders_read(hot, *HOUR))


def compact_hot(spark: SparkSession, hot_root: str) -> int:
    """Merge the micro-batches of each hour of the hot tier into one batch; returns the hours that were merged.

    A stream leaves a folder per micro-batch and touched hour. Hours of a single batch stay as they are. The merged batch is
    written before the batches that were read are deleted, and copies are removed, so a run that dies in between leaves
    copies that reading through ``dedup``, archiving or the next compaction removes. Batches that land meanwhile stay.
    Not to be run on an hour that is being archived.
    """
    by_hour: dict[tuple[str, str], list[str]] = {}
    for date, hour, batch in partition_folders(spark, hot_root, *HOUR, "batch"):
        by_hour.setdefault((date, hour), []).append(f"{hot_root.rstrip('/')}/date={date}/hour={hour}/batch={batch}")
    leaves = [leaf for batches in by_hour.values() if len(batches) > 1 for leaf in batches]
    if not leaves:
        return 0
    hot = spark.read.schema(HOT_BATCHES).option("basePath", hot_root).parquet(*leaves).drop("batch")
    merged = dedup(hot, (*HOUR, "event_id")).withColumn("batch", F.lit(f"merged-{uuid.uuid4().hex}"))
    sinks.overwrite_partitions(merged, hot_root, (*HOUR, "batch"), sinks.EVENT_SORT)
    remove_paths(spark, leaves)
    return sum(len(batches) > 1 for batches in by_hour.values())


def snapshots(spark: SparkSession, lake: Lake, as_of: str) -> dict[str, DataFrame]:
    """The four dimensions as of a date, each a single snapshot; refused if one is missing or repeats a key."""
    frames = {name: latest_snapshot(read_table(spark, lake.folder(f"metadata.{name}"), contract), as_of)
              for name, contract in schemas.DIMENSIONS.items()}
    require_ready(frames, DIMENSION_KEYS, lake.optional)
    return frames


def publish(spark: SparkSession, lake: Lake, *tables: str) -> None:
    """Make the partitions of tables known to the catalog, gone ones included."""
    if lake.catalog is not None:
        for table in tables:
            sync_partitions(spark, lake.catalog + table, "FULL")


def _require_same_rows(bronze_rows: int, silver_rows: int) -> None:
    """Enrichment neither drops nor multiplies events; a dimension with a repeated key would multiply them."""
    if bronze_rows != silver_rows:
        raise ValueError(f"silver has {silver_rows} rows for {bronze_rows} bronze events: a dimension key repeats")


def build_silver(spark: SparkSession, lake: Lake, date: str, hour: str) -> int:
    bronze = read_partition(spark, lake.folder("metadata.events"), schemas.BRONZE_EVENTS, date, hour)
    wide = enrich(bronze, **snapshots(spark, lake, date))  # checked before anything is written
    rows = sinks.replace_partition(wide, lake.folder("silver.wide_table_events"), {"date": date, "hour": hour},
                                   sinks.EVENT_SORT)
    _require_same_rows(bronze.count(), rows)
    return rows


def build_mart(spark: SparkSession, lake: Lake, name: str, date: str, *hours: str) -> int | None:
    """Compute one mart for an hour, or for the whole day if the mart is daily.

    A daily mart is merged from the summaries of its hours; ``hours`` are the ones that changed, and only their silver is read.
    Returns the rows written, or None without writing if silver has nothing for that time.
    """
    mart = MARTS[name]
    if mart.summary:
        refresh(spark, lake, mart.summary, [(date, hour) for hour in hours])
        summaries = read_summary(spark, lake, mart.summary, date, date)
        if summaries.isEmpty():
            return None
        return sinks.replace_partition(mart.merge(summaries), lake.folder(mart.table), {"date": date})
    [hour] = hours
    silver = read_partition(spark, lake.folder("silver.wide_table_events"), schemas.SILVER_EVENTS, date, hour)
    if silver.isEmpty():
        return None
    return sinks.replace_partition(mart.build(silver, grain=mart.grain), lake.folder(mart.table), {"date": date, "hour": hour})


def run_hour(spark: SparkSession, lake: Lake, date: str, hour: str,
             marts: Sequence[str] = tuple(MARTS)) -> dict[str, int | None]:
    """Archive, enrich and compute the marts of one hour; returns the rows of each step."""
    rows = {"bronze": archive_hour(spark, lake, date, hour), "silver": build_silver(spark, lake, date, hour)}
    rows |= _side_by_side(lambda name: build_mart(spark, lake, name, date, hour), marts)
    publish(spark, lake, "metadata.events", "silver.wide_table_events", *[MARTS[name].table for name in marts])
    return rows


def pending_hours(spark: SparkSession, lake: Lake, before: str) -> list[tuple[str, str]]:
    """Hours (date, hour) that hold hot events and start before ``before``, given as ``yyyy-MM-dd HH``.

    Late events land in the hour of their own time, so an hour that was finished before shows up again.
    """
    hours = {(date, hour) for date, hour, _ in partition_folders(spark, lake.hot, *HOUR, "batch")}
    return sorted((date, hour) for date, hour in hours if f"{date} {hour}" < before)


def archive_hours(spark: SparkSession, lake: Lake, hours: Sequence[tuple[str, str]]) -> None:
    """``archive_hour`` for many hours in one job; the hot batches that were listed first are read and then deleted."""
    wanted = set(hours)
    leaves = [f"{lake.hot.rstrip('/')}/date={date}/hour={hour}/batch={batch}"
              for date, hour, batch in partition_folders(spark, lake.hot, *HOUR, "batch") if (date, hour) in wanted]
    hot = spark.read.schema(HOT_BATCHES).option("basePath", lake.hot).parquet(*leaves)
    bronze_root = lake.folder("metadata.events")
    existing = read_hours(spark, bronze_root, schemas.BRONZE_EVENTS, hours)
    # copies share their hour; the same id in two hours is two events, as when hours are archived one by one
    both = existing.unionByName(to_bronze(hot).select(*existing.columns))
    merged = materialize(dedup(both, (*HOUR, "event_id")), "archive")
    sinks.overwrite_partitions(merged, bronze_root, HOUR, sinks.EVENT_SORT, bloom=sinks.EVENT_BLOOM)
    remove_paths(spark, leaves)


def build_silver_hours(spark: SparkSession, lake: Lake, hours: Sequence[tuple[str, str]]) -> int:
    """``build_silver`` for many hours in one job, each day joined to its own snapshots."""
    periods, tables = snapshot_periods(spark, lake, hours[0][0], hours[-1][0]), dimension_tables(spark, lake)
    require_snapshots(tables, DIMENSION_KEYS, periods, lake.optional)
    bronze = read_hours(spark, lake.folder("metadata.events"), schemas.BRONZE_EVENTS, hours)
    with step_tables(spark):
        rows = sinks.overwrite_partitions(enrich_as_of(bronze, tables, periods), lake.folder("silver.wide_table_events"), HOUR,
                                          sinks.EVENT_SORT)
    _require_same_rows(bronze.count(), rows)
    return rows


def run_pending(spark: SparkSession, lake: Lake, before: str, marts: Sequence[str] = tuple(MARTS)) -> list[tuple[str, str]]:
    """Archive and recompute all pending hours together, a job per table; returns the hours.

    Daily marts are merged anew for the touched days from the summaries of their hours.
    """
    hours = pending_hours(spark, lake, before)
    if not hours:
        return hours
    archive_hours(spark, lake, hours)
    build_silver_hours(spark, lake, hours)
    silver, days = silver_hours(spark, lake, hours), sorted({date for date, _ in hours})

    def recompute(name: str) -> int:
        mart = MARTS[name]
        if mart.summary:
            refresh(spark, lake, mart.summary, hours)
            rows = mart.merge(read_summary(spark, lake, mart.summary, days[0], days[-1]).where(F.col("date").isin(days)))
        else:
            rows = mart.build(silver, grain=mart.grain)
        return sinks.overwrite_partitions(rows, lake.folder(mart.table), mart.grain)

    _side_by_side(recompute, marts)
    publish(spark, lake, "metadata.events", "silver.wide_table_events", *[MARTS[name].table for name in marts])
    return hours


def dimension_tables(spark: SparkSession, lake: Lake) -> dict[str, DataFrame]:
    """The four dimensions with all their snapshots."""
    return {name: read_table(spark, lake.folder(f"metadata.{name}"), contract) for name, contract in schemas.DIMENSIONS.items()}


def snapshot_periods(spark: SparkSession, lake: Lake, first: str, last: str) -> list[Period]:
    """The days cut into periods that see the same snapshot of every dimension, from the folder names."""
    return cut_periods({name: [d for d, in partition_folders(spark, lake.folder(f"metadata.{name}"), "date")]
                        for name in schemas.DIMENSIONS}, first, last)


def backfill(spark: SparkSession, lake: Lake, first: str, last: str,
             marts: Sequence[str] = tuple(MARTS)) -> dict[str, int]:
    """Recompute silver and gold for days ``first`` to ``last`` from bronze.

    Each day is joined to the snapshots as of that day, as the hourly run does, in one silver job for all days: the snapshots
    are folded to validity intervals. All of them are checked before anything is written. The marts take one job each
    and are submitted side by side. Partitions that the recomputed range no longer has are removed; their names come
    from the folders.
    """
    silver_root, bronze_root = lake.folder("silver.wide_table_events"), lake.folder("metadata.events")
    hours = [h for h in partition_folders(spark, bronze_root, *HOUR) if first <= h[0] <= last]
    rows = {"silver": 0}
    if hours:
        periods = snapshot_periods(spark, lake, hours[0][0], hours[-1][0])
        tables = dimension_tables(spark, lake)
        require_snapshots(tables, DIMENSION_KEYS, periods, lake.optional)
        bronze = read_range(spark, bronze_root, schemas.BRONZE_EVENTS, first, last)
        with step_tables(spark):
            rows["silver"] = sinks.overwrite_partitions(enrich_as_of(bronze, tables, periods), silver_root, HOUR, sinks.EVENT_SORT)
        _require_same_rows(bronze.count(), rows["silver"])
    _drop_gone(spark, silver_root, HOUR, first, last, hours)
    silver = read_range(spark, silver_root, schemas.SILVER_EVENTS, first, last)

    def recompute(name: str) -> int:
        mart = MARTS[name]
        root = lake.folder(mart.table)
        if mart.summary:
            rewrite(silver, lake, mart.summary)
            _drop_gone(spark, lake.folder(SUMMARIES[mart.summary].table), HOUR, first, last, hours)
            wanted = mart.merge(read_summary(spark, lake, mart.summary, first, last))
        else:
            wanted = mart.build(silver, grain=mart.grain)
        written = sinks.overwrite_partitions(wanted, root, mart.grain)
        _drop_gone(spark, root, mart.grain, first, last, sorted({h[:len(mart.grain)] for h in hours}))
        return written

    rows |= _side_by_side(recompute, marts)
    publish(spark, lake, "silver.wide_table_events", *[MARTS[name].table for name in marts])
    return rows


def _drop_gone(spark, root, grain, first, last, wanted) -> None:
    present = [p for p in partition_folders(spark, root, *grain) if first <= p[0] <= last]
    sinks.drop_stale(spark, root, grain, present, wanted)


def _side_by_side(work: Callable[[str], int | None], names: Sequence[str]) -> dict[str, int | None]:
    """Submit independent jobs from one thread each; the first error is raised after all have ended."""
    if not names:
        return {}
    with ThreadPoolExecutor(max_workers=len(names)) as pool:
        return dict(zip(names, pool.map(work, names)))
