import pytest
from pyspark.sql import functions as F

from clickmill import jobs, schemas
from clickmill.operators.dimensions import write_snapshot
from clickmill.plans import hourly, reports
from clickmill.sources import jdbc, sinks
from clickmill.sources.lake import read_table
from frames import events, rows_of

DAY, ROWS = "2024-01-01", [(1, "2024-01-01 10:00:00"), (2, "2024-01-01 10:20:00", "IOS"), (1, "2024-01-01 11:00:00"),
                           (3, "2024-01-01 11:30:00", "IOS"), (1, "2024-01-02 10:00:00")]


def ingest(spark, lake, rows, batch, first_id=0):
    hot = (events(spark, rows).withColumn("event_id", (F.col("event_id").cast("int") + first_id).cast("string"))
           .select(*schemas.HOT_EVENTS.names, F.lit(batch).alias("batch")))
    sinks.overwrite_partitions(hot, lake.hot, ("date", "hour", "batch"))


@pytest.fixture
def lake(spark, tmp_path):
    lake = hourly.Lake(str(tmp_path / "cold"), str(tmp_path / "hot"))
    frames = {
        "users": "SELECT 1 AS user_id, 'ann' AS username, 'Ann' AS full_name, 'a@x' AS email, "
                 "timestamp '2020-01-01' AS created_at",
        "products": "SELECT 1 AS product_id, 1 AS store_id, 1 AS category_id, 'p' AS name, 2.5D AS price",
        "categories": "SELECT 1 AS category_id, 'c' AS name", "stores": "SELECT 1 AS store_id, 's' AS store_name"}
    for name, sql in frames.items():
        write_snapshot(spark.sql(sql), lake.folder(f"metadata.{name}"), "2023-12-31", schemas.DIMENSIONS[name])
    ingest(spark, lake, ROWS, 0)
    return lake


def contents(spark, lake):
    return {name: rows_of(read_table(spark, lake.folder(name), contract))
            for name, (contract, _) in schemas.LAKE_TABLES.items() if not name.startswith("metadata.")}


def bronze_ids(spark, lake):
    return [r[0] for r in rows_of(read_table(spark, lake.folder("metadata.events"), schemas.BRONZE_EVENTS), "event_id")]


def hot_ids(spark, lake):
    return [r[0] for r in rows_of(read_table(spark, lake.hot, schemas.HOT_EVENTS), "event_id")]


def test_hours_then_rerun_then_backfill_leave_the_same_tables(spark, lake):
    first = hourly.run_hour(spark, lake, DAY, "10")
    assert first == {"bronze": 2, "silver": 2, "customer_profile": 2, "funnel_conversion": 2, "rfm_segments": 2,
                     "session_performance": 2}
    hourly.run_hour(spark, lake, DAY, "11")
    hourly.run_hour(spark, lake, "2024-01-02", "10")
    assert bronze_ids(spark, lake) == ["0", "1", "2", "3", "4"] and hot_ids(spark, lake) == []
    before = contents(spark, lake)
    assert len(before["silver.wide_table_events"]) == 5
    assert hourly.run_hour(spark, lake, DAY, "10") == first  # hot is empty now; nothing may get lost
    assert contents(spark, lake) == before
    rows = hourly.backfill(spark, lake, "2024-01-01", "2024-01-31")
    assert contents(spark, lake) == before
    assert rows["silver"] == 5 and rows["session_performance"] == len(before["gold.fact_session_performance"])


def test_late_and_repeated_events_join_their_hour(spark, lake):
    hourly.run_hour(spark, lake, DAY, "10")
    ingest(spark, lake, [(1, "2024-01-01 10:00:00"), (5, "2024-01-01 10:59:59")], 1)  # id 0 again, id 1 in two versions
    ingest(spark, lake, [(9, "2024-01-01 10:05:00")], 2, first_id=50)
    assert hourly.run_hour(spark, lake, DAY, "10", marts=["funnel_conversion"])["bronze"] == 3
    assert bronze_ids(spark, lake) == ["0", "1", "50"]


def test_both_tiers_read_as_one_table_without_a_job_to_find_the_hot_hours(spark, lake):
    assert [r[0] for r in rows_of(hourly.all_events(spark, lake), "event_id")] == ["0", "1", "2", "3", "4"]  # all hot
    hourly.run_hour(spark, lake, DAY, "10")
    ingest(spark, lake, [(1, "2024-01-01 10:00:00"), (7, "2024-01-01 10:30:00")], 3, first_id=0)  # archived ids again
    spark.sparkContext.setJobGroup("both-tiers", "")
    both = hourly.all_events(spark, lake)
    assert list(spark.sparkContext.statusTracker().getJobIdsForGroup("both-tiers")) == []
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert both.columns == schemas.BRONZE_EVENTS.names
    assert [r[0] for r in rows_of(both, "event_id")] == ["0", "1", "2", "3", "4"]
    for date, hour in [(DAY, "10"), (DAY, "11"), ("2024-01-02", "10")]:
        hourly.run_hour(spark, lake, date, hour, marts=[])
    assert [r[0] for r in rows_of(hourly.all_events(spark, lake), "event_id")] == ["0", "1", "2", "3", "4"]  # all cold


def test_a_batch_that_lands_during_the_move_stays_hot(spark, lake, monkeypatch):
    replace = sinks.replace_partition

    def land_another(*args, **kwargs):
        rows = replace(*args, **kwargs)
        ingest(spark, lake, [(4, "2024-01-01 10:40:00")], 1, first_id=90)
        return rows

    monkeypatch.setattr(sinks, "replace_partition", land_another)
    assert hourly.archive_hour(spark, lake, DAY, "10") == 2
    monkeypatch.undo()
    assert "90" in hot_ids(spark, lake) and bronze_ids(spark, lake) == ["0", "1"]
    assert hourly.archive_hour(spark, lake, DAY, "10") == 3
    assert bronze_ids(spark, lake) == ["0", "1", "90"]


def test_an_hour_without_data_writes_nothing(spark, lake):
    assert hourly.run_hour(spark, lake, "2024-03-03", "07") == {
        "bronze": 0, "silver": 0, "customer_profile": None, "funnel_conversion": None, "rfm_segments": None,
        "session_performance": None}


def test_backfill_removes_hours_that_bronze_no_longer_has(spark, lake):
    for hour in ("10", "11"):
        hourly.run_hour(spark, lake, DAY, hour)
    sinks.remove_paths(spark, [f"{lake.folder('metadata.events')}/date={DAY}/hour=11"])
    hourly.backfill(spark, lake, DAY, DAY)
    left = contents(spark, lake)
    assert len(left["silver.wide_table_events"]) == 2
    assert {r[-1] for r in left["gold.fact_rfm_segments"]} == {"10"}


def test_a_repeated_dimension_key_is_an_error(spark, lake):
    twice = spark.sql("SELECT 1 AS user_id, 'a' AS username UNION ALL SELECT 1, 'b'")
    with pytest.raises(ValueError, match="not unique"):
        write_snapshot(twice, lake.folder("metadata.users"), DAY, schemas.USERS, key="user_id")
    write_snapshot(twice, lake.folder("metadata.users"), DAY, schemas.USERS)
    for run in (lambda: hourly.run_hour(spark, lake, DAY, "10"), lambda: hourly.backfill(spark, lake, DAY, DAY)):
        with pytest.raises(ValueError, match="key repeats"):
            run()
        assert read_table(spark, lake.folder("silver.wide_table_events"), schemas.SILVER_EVENTS).isEmpty()


def test_missing_dimensions_are_an_error_unless_optional(spark, lake):
    sinks.remove_paths(spark, [lake.folder("metadata.stores")])
    with pytest.raises(ValueError, match="not loaded"):
        hourly.run_hour(spark, lake, DAY, "10")
    assert read_table(spark, lake.folder("silver.wide_table_events"), schemas.SILVER_EVENTS).isEmpty()
    relaxed = hourly.Lake(lake.root, lake.hot, optional=("stores",))
    assert hourly.run_hour(spark, relaxed, DAY, "10")["silver"] == 2


def test_backfill_joins_each_day_to_its_own_snapshot(spark, lake):
    renamed = spark.sql("SELECT 1 AS user_id, 'ann' AS username, 'New' AS full_name, 'a@x' AS email, "
                        "timestamp '2020-01-01' AS created_at")
    write_snapshot(renamed, lake.folder("metadata.users"), "2024-01-02", schemas.USERS)
    for date, hour in ((DAY, "10"), (DAY, "11"), ("2024-01-02", "10")):
        hourly.run_hour(spark, lake, date, hour)
    before = contents(spark, lake)
    hourly.backfill(spark, lake, DAY, "2024-01-02")
    assert contents(spark, lake) == before
    silver = read_table(spark, lake.folder("silver.wide_table_events"), schemas.SILVER_EVENTS).where("user_id = 1")
    assert set(rows_of(silver, "date", "full_name")) == {(DAY, "Ann"), ("2024-01-02", "New")}


def test_late_hours_are_pending_again(spark, lake):
    assert hourly.run_pending(spark, lake, "2024-01-01 12") == [(DAY, "10"), (DAY, "11")]
    assert hourly.run_pending(spark, lake, "2024-01-01 12") == []
    ingest(spark, lake, [(4, "2024-01-01 10:40:00")], 1, first_id=50)
    assert hourly.pending_hours(spark, lake, "2024-01-01 12") == [(DAY, "10")]
    hourly.run_pending(spark, lake, "2024-01-01 12")
    after = contents(spark, lake)
    assert len(after["silver.wide_table_events"]) == 5
    hourly.backfill(spark, lake, DAY, DAY)
    assert contents(spark, lake) == after


def test_report_from_two_databases(spark, monkeypatch):
    """The databases are stood in for by frames; what is asked of them is recorded."""
    asked, written = [], {}
    frames = {"products": spark.sql("SELECT 1 AS product_id, 'a' AS name, 2.5BD AS price"),
              "events": spark.sql("SELECT '1' AS event_id, 1 AS product_id, 'SEARCH' AS event_type")}

    def read(spark, target, table, **split):
        asked.append((target.url, table, split))
        return frames["events" if "events" in table else "products"]

    monkeypatch.setattr(reports.jdbc, "read_jdbc", read)
    monkeypatch.setattr(reports.jdbc, "overwrite_jdbc", lambda df, target, table: written.update({table: rows_of(df)}))
    shop, hot = jdbc.JdbcTarget("shop"), jdbc.JdbcTarget("hot")
    reports.refresh_product_sales(spark, shop, hot, split={"split_column": "user_id", "lower": 0, "upper": 9,
                                                           "partitions": 3})
    assert [(r[0], float(r[1]), r[2]) for r in written["mart_product_sales"]] == [("a", 2.5, 1)]
    assert asked[0] == ("shop", "products", {})
    assert asked[1][1].startswith("(SELECT") and asked[1][2]["partitions"] == 3
    assert reports.snapshot_dimensions(spark, shop, "/nowhere", DAY, tables=[]) == {}


def test_jobs_by_command_line(spark, lake, capsys, monkeypatch):
    monkeypatch.setattr(jobs, "build_session", lambda *args, **kwargs: spark)
    monkeypatch.setattr(type(spark), "stop", lambda self: None)
    where = ["--lake", lake.root, "--hot", lake.hot]
    assert jobs.main(["hour", DAY, "10", *where]) == 0
    assert jobs.main(["mart", DAY, "10", "--name", "funnel_conversion", *where]) == 0
    assert jobs.main(["mart", "2024-05-05", "10", "--name", "funnel_conversion", *where]) == 0
    assert jobs.main(["backfill", DAY, DAY, *where]) == 0
    assert '"funnel_conversion": 2' in capsys.readouterr().out


def test_more_jobs_by_command_line(spark, lake, tmp_path, capsys, monkeypatch):
    monkeypatch.setattr(jobs, "build_session", lambda *args, **kwargs: spark)
    monkeypatch.setattr(type(spark), "stop", lambda self: None)
    where = ["--lake", lake.root, "--hot", lake.hot]
    prefix = "jobs_" + tmp_path.name.replace("-", "_").lower() + "_"
    assert jobs.main(["compact", *where]) == 0
    assert jobs.main(["register", *where, "--catalog", prefix]) == 0
    assert jobs.main(["pending", DAY, "11", *where, "--catalog", prefix]) == 0
    compacted, registered, pending = capsys.readouterr().out.strip().splitlines()
    assert '"merged"' in compacted and f"`{prefix}gold`" in registered and f"{DAY} 10" in pending
    found = spark.table(f"`{prefix}metadata`.`events`").where(f"date = '{DAY}' AND hour = '10'").count()
    assert found == spark.read.parquet(lake.folder("metadata.events")).where(f"date = '{DAY}' AND hour = '10'").count() > 0
    monkeypatch.setattr(jobs, "read_topic", lambda spark, servers, topic: (servers, topic))
    started = []

    class Ended:
        lastProgress = {"batchId": 4}

        def awaitTermination(self):
            started.append("ended")

    monkeypatch.setattr(jobs, "start_ingest", lambda *args, **more: started.append((args, more)) or Ended())
    assert jobs.main(["ingest", *where, "--servers", "s:1", "--topic", "t", "--checkpoint", "c"]) == 0
    assert started[0] == ((("s:1", "t"), lake.hot, f"{lake.hot}-quarantine", "c"), {"every": None}) and started[1] == "ended"
    assert '"last_batch": 4' in capsys.readouterr().out
