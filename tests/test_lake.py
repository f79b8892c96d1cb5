import pytest
from pyspark.sql import functions as F

from clickmill import schemas
from clickmill.operators import dimensions as dims
from clickmill.operators.dedup import dedup, unified_events
from clickmill.operators.tiering import archive_split, to_bronze
from clickmill.sources import catalog, jdbc, sinks
from clickmill.sources.lake import partition_values, read_partition, read_range, read_table
from frames import events, rows_of

HOUR = ("date", "hour")


def hot(spark, rows):
    return events(spark, rows).select(*schemas.HOT_EVENTS.names)


def test_missing_folder_is_an_empty_table_and_other_errors_surface(spark, tmp_path):
    root = str(tmp_path / "t")
    assert read_table(spark, root, schemas.BRONZE_EVENTS).isEmpty()
    assert read_partition(spark, root, schemas.BRONZE_EVENTS, "2024-01-01", "00").columns == schemas.BRONZE_EVENTS.names
    leaf = tmp_path / "t" / "date=2024-01-01" / "hour=00"
    leaf.mkdir(parents=True)
    (leaf / "part-0.parquet").write_bytes(b"this is not parquet, but it is long enough to be opened")
    with pytest.raises(Exception, match="(?i)parquet|FAILED_READ_FILE"):
        read_partition(spark, root, schemas.BRONZE_EVENTS, "2024-01-01", "00").collect()


def test_partition_keys_stay_text_and_reads_are_pruned(spark, tmp_path):
    root = str(tmp_path)
    sinks.overwrite_partitions(to_bronze(hot(spark, [(1, "2024-01-01 04:00:00"), (1, "2024-01-02 05:00:00")])), root, HOUR)
    assert partition_values(read_table(spark, root, schemas.BRONZE_EVENTS), *HOUR) == [
        ("2024-01-01", "04"), ("2024-01-02", "05")]
    day = read_partition(spark, root, schemas.BRONZE_EVENTS, "2024-01-02")
    assert rows_of(day, "date", "hour") == [("2024-01-02", "05")] and len(day.inputFiles()) == 1
    assert read_range(spark, root, schemas.BRONZE_EVENTS, "2024-01-01", "2024-01-01").count() == 1


def test_overwrites_touch_only_their_partitions_and_an_empty_one_clears(spark, tmp_path):
    root = str(tmp_path)
    first = to_bronze(hot(spark, [(1, "2024-01-01 04:00:00"), (2, "2024-01-01 05:00:00")]))
    assert sinks.overwrite_partitions(first, root, HOUR) == 2
    again = to_bronze(hot(spark, [(7, "2024-01-01 05:10:00"), (8, "2024-01-01 05:20:00")]))
    for _ in range(2):
        assert sinks.overwrite_partitions(again, root, HOUR, sinks.EVENT_SORT) == 2
    assert rows_of(read_table(spark, root, schemas.BRONZE_EVENTS), "user_id") == [(1,), (7,), (8,)]
    assert sinks.replace_partition(first.where("false"), root, {"date": "2024-01-01", "hour": "05"}) == 0
    assert rows_of(read_table(spark, root, schemas.BRONZE_EVENTS), "user_id") == [(1,)]
    assert sinks.drop_stale(spark, root, HOUR, [("2024-01-01", "04")], []) == 1
    assert read_table(spark, root, schemas.BRONZE_EVENTS).isEmpty()


def test_writes_are_rebalanced_by_partition_and_single_partitions_evenly(spark):
    df = spark.range(10).withColumn("date", F.lit("d"))
    plan = lambda d: d._jdf.queryExecution().executedPlan().toString()
    assert "REBALANCE_PARTITIONS_BY_COL" in plan(sinks.arrange(df, ["date"]))
    assert "REBALANCE_PARTITIONS_BY_NONE" in plan(sinks.arrange(df, []))


def test_cold_hours_that_are_not_hot_are_not_shuffled(spark):
    cold = hot(spark, [(1, "2024-01-01 10:00:00"), (2, "2024-01-01 11:00:00")]).select("event_id", "user_id", "date", "hour")
    live = cold.where("hour = '11'")
    both = unified_events(cold, live)
    assert rows_of(both, "hour") == [("10",), ("11",)]
    assert unified_events(cold, live.where("false"))._jdf.queryExecution().executedPlan().toString().count("Exchange") <= 1


def test_archive_interval_is_half_open_and_the_rest_is_retained(spark):
    df = hot(spark, [(1, "2024-01-01 10:00:00"), (2, "2024-01-01 10:59:59"), (3, "2024-01-01 11:00:00"), (4, None)])
    archived, retained = archive_split(df, "2024-01-01 10:00:00", "2024-01-01 11:00:00")
    assert rows_of(archived, "user_id") == [(1,), (2,)] and rows_of(retained, "user_id") == [(3,), (4,)]


def test_dedup_takes_the_earliest_copy_and_keeps_unkeyed_rows_apart(spark):
    df = spark.createDataFrame([("a", 2, "x"), ("a", 1, "z"), ("a", 1, "y"), (None, 1, "p"), (None, 2, "q"), ("b", 5, None)],
                               "event_id string, occurred_at int, note string")
    assert rows_of(dedup(df)) == [("a", 1, "y"), ("b", 5, None), (None, 1, "p"), (None, 2, "q")]
    assert unified_events(df, df).count() == 4


def test_snapshots_are_written_once_and_the_whole_latest_is_read(spark, tmp_path):
    root = str(tmp_path / "users")
    users = spark.createDataFrame([(1, "a"), (2, "b")], "user_id int, username string")
    assert dims.write_snapshot(users, root, "2024-01-01", schemas.USERS) == "written"
    assert dims.write_snapshot(users.where("user_id = 1"), root, "2024-01-01", schemas.USERS) == "skipped"
    assert dims.write_snapshot(users.where("false"), root, "2024-01-02", schemas.USERS) == "empty"
    assert dims.write_snapshot(users.where("user_id = 2"), root, "2024-01-03", schemas.USERS) == "written"
    table = read_table(spark, root, schemas.USERS)
    assert rows_of(dims.latest_snapshot(table, "2024-01-02"), "user_id") == [(1,), (2,)]
    assert rows_of(dims.latest_snapshot(table), "user_id", "email") == [(2, None)]
    assert dims.latest_snapshot(table, "2023-01-01").isEmpty() and dims.is_loaded(table)
    assert dims.write_snapshot(users, root, "2024-01-03", schemas.USERS, overwrite=True) == "written"
    table = read_table(spark, root, schemas.USERS)  # lists the new files
    assert dims.latest_snapshot(table).count() == 2
    with pytest.raises(ValueError):
        dims.require_unique(table, ["user_id"])


def test_catalog_tables_see_partitions_after_a_sync(spark, tmp_path):
    names = catalog.register_lake(spark, str(tmp_path), prefix="lake_test_")
    assert len(names) == 10
    events_table = "`lake_test_metadata`.`events`"
    folder = catalog.table_folder(str(tmp_path), "metadata.events")
    sinks.overwrite_partitions(to_bronze(hot(spark, [(1, "2024-01-01 04:00:00")])), folder, HOUR)
    assert spark.table(events_table).isEmpty()
    catalog.sync_partitions(spark, events_table, "ADD")
    assert spark.table(events_table).select("date", "hour").collect() == [("2024-01-01", "04")]
    spark.createDataFrame([], schemas.BRONZE_EVENTS).createOrReplaceTempView("nothing")
    catalog.replace_table_partition(spark, "nothing", events_table, {"date": "2024-01-01", "hour": "04"},
                                    schemas.BRONZE_EVENTS.names)
    assert spark.table(events_table).isEmpty()
    sinks.remove_paths(spark, [f"{folder}/date=2024-01-01"])
    catalog.sync_partitions(spark, events_table, "FULL")
    assert spark.sql(f"SHOW PARTITIONS {events_table}").isEmpty()
    catalog.drop_table(spark, events_table)
    assert not spark.catalog.tableExists("lake_test_metadata.events")
    spark.sql("CREATE TABLE lake_test_gold.managed (x int) USING parquet")
    spark.sql("INSERT INTO lake_test_gold.managed VALUES (1)")
    catalog.truncate_tables(spark, ["lake_test_gold.managed"])
    assert spark.table("lake_test_gold.managed").isEmpty()
    for schema in ("metadata", "silver", "gold"):
        spark.sql(f"DROP DATABASE lake_test_{schema} CASCADE")


class Recorder:
    """Stands in for a reader or writer: no database runs in the tests."""

    def __init__(self):
        self.calls = []

    @property
    def read(self):
        return self

    @property
    def write(self):
        return self

    def option(self, key, value):
        self.calls.append(("option", key, value))
        return self

    def repartition(self, n):
        self.calls.append(("repartition", n))
        return self

    def jdbc(self, *args, **kwargs):
        self.calls.append(("jdbc", args, kwargs))
        return self


def test_jdbc_calls(spark):
    target = jdbc.JdbcTarget("jdbc:x:y", {"user": "u"})
    seen = Recorder()
    jdbc.read_jdbc_query(seen, target, "SELECT a FROM t", "events", split_column="a", lower=0, upper=9, partitions=3)
    assert seen.calls[-1] == ("jdbc", ("jdbc:x:y", "(SELECT a FROM t) events"), {
        "column": "a", "lowerBound": 0, "upperBound": 9, "numPartitions": 3, "properties": {"user": "u"}})
    jdbc.read_jdbc(seen, target, "products")
    assert seen.calls[-1] == ("jdbc", ("jdbc:x:y", "products"), {"properties": {"user": "u"}})
    with pytest.raises(ValueError):
        jdbc.read_jdbc(seen, target, "products", split_column="a")
    jdbc.overwrite_jdbc(seen, target, "report", connections=2)
    assert seen.calls[-3:] == [("repartition", 2), ("option", "truncate", "false"), (
        "jdbc", ("jdbc:x:y", "report"), {"mode": "overwrite", "properties": {"user": "u"}})]
    jdbc.append_jdbc(seen, target, "users")
    assert seen.calls[-1][2]["mode"] == "append"
