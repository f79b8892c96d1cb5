"""Published versions, point reads, bucketed joins and merged hot batches."""

import uuid

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from clickmill import schemas
from clickmill.functions.columns import UUID_PATTERN, canonical_uuid, name_uuid
from clickmill.operators.lookup import attach_bucketed
from clickmill.operators.sessions import assign_sessions
from clickmill.plans import hourly
from clickmill.sources import catalog, sinks
from clickmill.sources.lake import find_rows, list_files, read_table
from frames import rows_of

ROWS = T.StructType([T.StructField("n", T.LongType()), T.StructField("date", T.StringType())])


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture
def table(spark, tmp_path):
    schema = "versions_" + uuid.uuid4().hex
    catalog.create_schema(spark, schema, str(tmp_path / "db"))
    name, folder = f"`{schema}`.`t`", str(tmp_path / "t")
    catalog.create_table(spark, name, ROWS, folder, ("date",))
    return name, folder


def frame(spark, *rows):
    return spark.createDataFrame(list(rows), ROWS)


def test_a_reader_by_name_sees_the_old_rows_until_the_switch(spark, table):
    name, folder = table
    catalog.publish_version(frame(spark, (1, "a"), (2, "b")), name, folder, ("date",))
    version = catalog.write_version(frame(spark, (10, "a"), (30, "c")), folder, ("date",))
    assert rows_of(spark.table(name)) == [(1, "a"), (2, "b")]
    assert catalog.show_version(spark, name, version, ("date",)) == [("a",), ("c",)]
    assert rows_of(spark.table(name)) == [(10, "a"), (2, "b"), (30, "c")]
    assert catalog.show_version(spark, name, version, ("date",)) == [("a",), ("c",)]  # again after a stop in between
    assert rows_of(spark.table(name)) == [(10, "a"), (2, "b"), (30, "c")]


def test_only_folders_that_nobody_shows_are_dropped(spark, table):
    name, folder = table
    catalog.publish_version(frame(spark, (1, "a"), (2, "b")), name, folder, ("date",))
    catalog.publish_version(frame(spark, (10, "a")), name, folder, ("date",))
    waiting = catalog.write_version(frame(spark, (5, "b")), folder, ("date",))
    assert catalog.drop_versions(spark, name, folder, ("date",), keep=[waiting]) == 1
    assert catalog.drop_versions(spark, name, folder, ("date",), keep=[waiting]) == 0
    assert rows_of(spark.table(name)) == [(10, "a"), (2, "b")]
    catalog.show_version(spark, name, waiting, ("date",))
    assert rows_of(spark.table(name)) == [(10, "a"), (5, "b")]


def test_a_failed_write_changes_nothing(spark, table):
    name, folder = table
    catalog.publish_version(frame(spark, (1, "a")), name, folder, ("date",))
    broken = frame(spark, (2, "a")).withColumn("n", F.raise_error(F.lit("no")).cast("bigint"))
    with pytest.raises(Exception, match="no"):
        catalog.publish_version(broken, name, folder, ("date",))
    assert rows_of(spark.table(name)) == [(1, "a")]


def test_an_empty_version_shows_nothing_new(spark, table):
    name, folder = table
    catalog.publish_version(frame(spark, (1, "a")), name, folder, ("date",))
    catalog.publish_version(frame(spark), name, folder, ("date",))
    assert rows_of(spark.table(name)) == [(1, "a")]


def scanned(df):
    """Rows that the scans of a collected frame handed on."""
    df.collect()
    leaves = df._jdf.queryExecution().executedPlan().collectLeaves()
    return sum(leaves.apply(i).metrics().apply("numOutputRows").value() for i in range(leaves.size()))


def test_a_point_read_skips_row_groups_by_the_bloom_filter(spark, tmp_path):
    ids = spark.range(20000).select(F.md5(F.col("id").cast("string")).alias("event_id"), "id").repartition(8, "id")
    contract = T.StructType([T.StructField("event_id", T.StringType()), T.StructField("id", T.LongType())])
    plain, filtered = str(tmp_path / "plain"), str(tmp_path / "filtered")
    ids.write.parquet(plain)
    ids.write.options(**sinks.bloom_options(["event_id"])).parquet(filtered)
    wanted = [row[0] for row in ids.where("id in (7, 4711)").select("event_id").collect()]
    for root in (plain, filtered):
        assert rows_of(find_rows(spark, root, contract, "event_id", wanted), "id") == [(4711,), (7,)]
    assert scanned(find_rows(spark, plain, contract, "event_id", wanted[:1])) == 20000
    assert scanned(find_rows(spark, filtered, contract, "event_id", wanted[:1])) < 5000


def test_point_reads_of_none_one_twice_and_many(spark, tmp_path):
    contract = T.StructType([T.StructField("id", T.LongType())])
    spark.range(100).write.parquet(str(tmp_path / "t"))
    find = lambda values: rows_of(find_rows(spark, str(tmp_path / "t"), contract, "id", values))
    assert find([]) == [] and find([None]) == [] and find([500]) == []
    assert find([3, 3, None]) == [(3,)]
    assert len(find(range(25))) == 25
    assert rows_of(find_rows(spark, str(tmp_path / "absent"), contract, "id", [1])) == []


def bucketed_users(spark, tmp_path, buckets=4):
    schema = "buckets_" + uuid.uuid4().hex
    catalog.create_schema(spark, schema, str(tmp_path / "db"))
    users = spark.range(50).select(F.col("id").alias("user_id"), F.concat(F.lit("u"), F.col("id")).alias("name"))
    catalog.write_bucketed(users, f"`{schema}`.`users`", str(tmp_path / "users"), "user_id", buckets)
    return spark.table(f"`{schema}`.`users`")


def test_the_bucketed_side_is_not_shuffled(spark, tmp_path):
    spark.range(60).select(F.col("id").alias("user_id"), F.col("id").alias("n")).write.parquet(str(tmp_path / "facts"))
    facts = spark.read.parquet(str(tmp_path / "facts"))
    joined = plan(attach_bucketed(facts, bucketed_users(spark, tmp_path), "user_id"))
    merge = joined[joined.index("SortMergeJoin"):]
    assert joined.count("Exchange hashpartitioning") == 1 and "Bucketed: true" in joined, merge


@pytest.mark.parametrize("heavy", [1, 300])
def test_bucketed_join_keeps_every_row(spark, tmp_path, heavy):
    rows = [(7, i) for i in range(heavy)] + [(None, 1), (None, 2), (999, 3)] + [(u, 9) for u in range(50)]
    facts = spark.createDataFrame(rows, "user_id bigint, n bigint")
    got = rows_of(attach_bucketed(facts, bucketed_users(spark, tmp_path), "user_id"))
    want = [(u, n, f"u{u}" if u is not None and u < 50 else None) for u, n in rows]
    assert got == sorted(want, key=repr)


def test_sessions_scan_the_events_twice(spark, tmp_path):
    spark.createDataFrame([("1", 5, "2024-01-01 00:00:01")], "event_id string, user_id bigint, t string").select(
        "event_id", "user_id", F.col("t").cast("timestamp").alias("occurred_at"),
        F.lit("2024-01-01").alias("date")).write.parquet(str(tmp_path / "ev"))
    events = spark.read.parquet(str(tmp_path / "ev"))
    small, large = assign_sessions(events), assign_sessions(events, broadcast_bytes=0)
    assert rows_of(small, "session_id") == rows_of(large, "session_id") == [("5_1",)]
    assert plan(small).count(str(tmp_path / "ev")) == 1  # the other scan wrote the blocks


HOT = "event_id string, user_id bigint, product_id bigint, event_type string, platform string, occurred_at timestamp, date string, hour string, batch string"


def hot_rows(spark, *rows):
    return spark.createDataFrame(
        [(i, 1, 1, "VIEW", "WEB", None, "2024-01-01", hour, batch) for i, hour, batch in rows], HOT)


def test_hot_batches_of_an_hour_are_merged(spark, tmp_path):
    root = str(tmp_path / "hot")
    first = hot_rows(spark, ("1", "00", "a"), ("2", "00", "b"), ("2", "00", "c"), ("3", "01", "a"))
    sinks.overwrite_partitions(first, root, (*hourly.HOUR, "batch"))
    assert hourly.compact_hot(spark, root) == 1
    read = lambda: rows_of(read_table(spark, root, schemas.HOT_EVENTS), "event_id", "hour")
    assert read() == [("1", "00"), ("2", "00"), ("3", "01")]
    [batch] = (tmp_path / "hot" / "date=2024-01-01" / "hour=00").glob("batch=*")
    assert len(list_files(spark, str(batch))) == 1
    assert hourly.compact_hot(spark, root) == 0
    # a batch that is written again, as after a failure, adds a copy that the next run removes
    sinks.overwrite_partitions(hot_rows(spark, ("1", "00", "a")), root, (*hourly.HOUR, "batch"))
    assert hourly.compact_hot(spark, root) == 1
    assert read() == [("1", "00"), ("2", "00"), ("3", "01")]


def test_an_absent_hot_tier_has_nothing_to_merge(spark, tmp_path):
    assert hourly.compact_hot(spark, str(tmp_path / "none")) == 0


def test_made_ids_are_uuids_of_their_values(spark):
    rows = spark.createDataFrame([("a", None), ("a", "-"), (None, "a"), ("a", None), ("ab", "c"), ("a", "bc")], "x string, y string")
    ids = [row[0] for row in rows.select(name_uuid(F.col("x"), F.col("y"))).collect()]
    assert len(set(ids)) == 5 and ids[0] == ids[3]
    checked = rows.select(name_uuid(F.col("x"), F.col("y")).alias("id")).where(
        F.col("id").rlike(UUID_PATTERN) & (canonical_uuid(F.upper("id")) == F.col("id")))
    assert checked.count() == 6
