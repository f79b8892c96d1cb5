"""Writing partitioned Parquet: whole partitions are replaced, reruns leave the same table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from clickmill.session import remove_paths

# Order inside files, so that row groups can be skipped on these columns.
EVENT_SORT = ("event_type", "platform", "occurred_at")
# Columns that are looked up by single values and lie scattered over all row groups.
EVENT_BLOOM = ("event_id",)


def arrange(df: DataFrame, partition_by: Sequence[str], sort: Sequence[str] = ()) -> DataFrame:
    """Bring each partition's rows together before a partitioned write.

    Spark rebalances by real size: a partition that holds much of the data is split over many tasks, small ones share a
    task. With no columns, for a single partition, the rows are dealt out evenly.
    """
    arranged = df.hint("rebalance", *partition_by)
    return arranged.sortWithinPartitions(*partition_by, *sort) if sort else arranged


def bloom_options(columns: Sequence[str]) -> dict[str, str]:
    """Writer options for a Bloom filter per row group on ``columns``, as large as the values found there need."""
    switches = {f"parquet.bloom.filter.enabled#{c}": "true" for c in columns}
    return {**switches, "parquet.bloom.filter.adaptive.enabled": "true"} if columns else {}


def overwrite_partitions(df: DataFrame, root: str, partition_by: Sequence[str], sort: Sequence[str] = (),
                         deal_by: Sequence[str] | None = None, bloom: Sequence[str] = ()) -> int:
    """Replace exactly the partitions that occur in ``df``; returns the rows written, counted by the write itself.

    ``bloom`` names the columns whose row groups get a Bloom filter.
    """
    seen = Observation()
    arranged = arrange(df, partition_by if deal_by is None else deal_by, sort)
    counted = arranged.observe(seen, F.count(F.lit(1)).alias("rows"))
    (counted.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .options(**bloom_options(bloom)).partitionBy(*partition_by).parquet(root))
    return seen.get["rows"]


def replace_partition(df: DataFrame, root: str, spec: dict[str, str], sort: Sequence[str] = (),
                      bloom: Sequence[str] = ()) -> int:
    """Make ``df`` the content of one partition. An empty ``df`` removes the partition; others stay as they are.

    The new files are staged and swapped in when the job commits, so a failed run leaves the old content.
    """
    values = [F.lit(value).alias(key) for key, value in spec.items()]
    body = df.select(*[c for c in df.columns if c not in spec], *values)
    rows = overwrite_partitions(body, root, list(spec), sort, deal_by=(), bloom=bloom)
    if rows == 0:
        leaf = "/".join(f"{key}={value}" for key, value in spec.items())
        remove_paths(df.sparkSession, [f"{root.rstrip('/')}/{leaf}"])
    return rows


def drop_stale(spark, root: str, partition_by: Sequence[str], present: list[tuple], wanted: list[tuple]) -> int:
    """Remove partitions that a recomputed range no longer has; dynamic overwrite alone would leave them."""
    stale = sorted(set(present) - set(wanted))
    return remove_paths(spark, [
        f"{root.rstrip('/')}/" + "/".join(f"{k}={v}" for k, v in zip(partition_by, values)) for values in stale])
