import os
import time

import pytest
from pyspark.sql import functions as F

from clickmill import schemas
from clickmill.operators.dedup import dedup
from clickmill.operators.dimensions import write_snapshot
from clickmill.operators.messages import encode_events, good_events, parse_messages
from clickmill.operators.sessions import session_spans
from clickmill.plans import hourly
from clickmill.plans.funnel import funnel_conversion
from clickmill.sources.lake import read_table
from clickmill.sources.topics import read_message_files, read_topic
from clickmill.streaming.ingest import distinct_events, start_ingest
from clickmill.streaming.live import append_to_files, live_funnel, live_sessions
from clickmill.streaming.silver import LIVE_TABLE, start_live_silver
from frames import events, rows_of, silver

ANY = r"^\d+$"


def land(folder, lines, number):
    """One message file; a later number arrives later."""
    os.makedirs(folder, exist_ok=True)
    path = os.path.join(folder, f"m{number}.txt")
    with open(path, "w") as out:
        out.write("".join(line + "\n" for line in lines))
    os.utime(path, (time.time() - 1000 + number, time.time() - 1000 + number))


def lines_of(df):
    return [r.value for r in encode_events(df).orderBy("key").collect()]


def finish(query):
    query.awaitTermination()
    assert query.exception() is None


def test_ingest_in_small_batches_replay_and_late_event(spark, tmp_path):
    source = str(tmp_path / "in")
    df = events(spark, [(u, f"2024-01-01 1{u % 3}:{u:02d}:00") for u in range(12)])
    lines = lines_of(df)
    for i in range(4):
        land(source, lines[3 * i:3 * i + 3] + (["{broken"] if i == 2 else []), i)
    hot, bad, offsets = (str(tmp_path / n) for n in ("hot", "bad", "offsets"))
    messages = read_message_files(spark, source, max_files=1)
    finish(start_ingest(messages, hot, bad, offsets, ANY))
    expected = rows_of(df.select(*schemas.HOT_EVENTS.names))
    assert rows_of(read_table(spark, hot, schemas.HOT_EVENTS)) == expected
    assert [r.message for r in spark.read.parquet(bad).collect()] == ["{broken"]

    finish(start_ingest(messages, hot, bad, offsets, ANY))  # restart: nothing new, nothing twice
    assert read_table(spark, hot, schemas.HOT_EVENTS).count() == 12

    late = events(spark, [(77, "2023-12-31 05:00:00")]).withColumn("event_id", F.lit("77"))
    land(source, lines_of(late) + lines[:2], 9)
    finish(start_ingest(messages, hot, bad, offsets, ANY))
    table = read_table(spark, hot, schemas.HOT_EVENTS)
    assert table.count() == 15 and dedup(table).count() == 13
    assert rows_of(table.where("date = '2023-12-31'"), "hour", "event_id") == [("05", "77")]


def test_a_replay_with_a_new_checkpoint_keeps_what_was_there(spark, tmp_path):
    source, hot, bad = (str(tmp_path / n) for n in ("in", "hot", "bad"))
    land(source, lines_of(events(spark, [(1, "2024-01-01 10:00:00"), (2, "2024-01-01 10:30:00")])), 0)
    finish(start_ingest(read_message_files(spark, source), hot, bad, str(tmp_path / "offsets0"), ANY))
    # A cut topic with one other event of the same hour: batch 0 of another query.
    other = str(tmp_path / "other")
    land(other, lines_of(events(spark, [(9, "2024-01-01 10:50:00")]).withColumn("event_id", F.lit("90"))) + ["bad"], 0)
    finish(start_ingest(read_message_files(spark, other), hot, bad, str(tmp_path / "offsets1"), ANY))
    assert [r[0] for r in rows_of(read_table(spark, hot, schemas.HOT_EVENTS), "event_id")] == ["0", "1", "90"]
    batches = {row[0] for row in spark.read.parquet(hot).select("batch").distinct().collect()}
    assert len(batches) == 2 and all(b.endswith("-0") for b in batches)


def test_streamed_sessions_and_funnel_equal_the_batch_marts(spark, tmp_path):
    rows = []
    for i in range(60):
        minute = i * 17
        rows.append((str(i), f"2024-01-0{1 + minute // 1440} {minute // 60 % 24:02d}:{minute % 60:02d}:30",
                     schemas.FUNNEL_STEPS[i % 4], schemas.PLATFORMS[i % 3], i % 5, None, 1, 1.0))
    df = silver(spark, rows)
    ordered = [r.value for r in encode_events(df.orderBy("occurred_at")).collect()]
    source = str(tmp_path / "in")
    in_time = sorted(ordered, key=lambda line: line.split('"occurred_at":')[1])
    for i in range(6):
        land(source, in_time[10 * i:10 * i + 10], i)
    closing = silver(spark, [("999", "2024-02-01 00:00:00", "CLOSE", "CLOSE", 999, None, 1, 1.0)])
    land(source, lines_of(closing), 50)

    def run(build, name):
        decoded = good_events(parse_messages(read_message_files(spark, source, max_files=1), ANY))
        out = str(tmp_path / name)
        finish(append_to_files(build(decoded), out, str(tmp_path / (name + "-offsets"))))
        return spark.read.parquet(out)

    sessions = run(lambda e: live_sessions(e, "5 minutes"), "sessions")
    spans = ["date", "user_id", "session_start", "session_end", "events"]
    assert rows_of(sessions, *spans) == rows_of(session_spans(df), *spans)

    funnel = funnel_conversion(df)
    assert rows_of(run(lambda e: live_funnel(e, "5 minutes"), "funnel"), *funnel.columns) == rows_of(funnel)
    rough = run(lambda e: live_funnel(e, "5 minutes", approximate=True), "rough")
    assert rows_of(rough, *funnel.columns) == rows_of(funnel)  # so few users that the sketch is exact


def test_stream_dedup_drops_copies_in_later_batches(spark, tmp_path):
    source = str(tmp_path / "in")
    lines = lines_of(events(spark, [(u, f"2024-01-01 10:{u:02d}:00") for u in range(6)]))
    land(source, lines[:4], 0)
    land(source, lines[2:], 1)
    decoded = good_events(parse_messages(read_message_files(spark, source, max_files=1), ANY))
    out = str(tmp_path / "out")
    finish(append_to_files(distinct_events(decoded, "1 hour"), out, str(tmp_path / "offsets")))
    assert [r[0] for r in rows_of(spark.read.parquet(out), "event_id")] == [str(i) for i in range(6)]


def test_topic_source_needs_its_connector(spark):
    with pytest.raises(Exception, match="(?i)kafka"):
        read_topic(spark, "localhost:1", "events", max_offsets=5000)


def test_live_silver_sees_new_snapshots_and_survives_a_restart(spark, tmp_path):
    lake = hourly.Lake(str(tmp_path / "cold"), str(tmp_path / "hot"))
    source, offsets = str(tmp_path / "in"), str(tmp_path / "offsets")
    one = {"products": "SELECT 1 AS product_id, 1 AS store_id, 1 AS category_id, 'p' AS name, 2.5D AS price",
           "categories": "SELECT 1 AS category_id, 'c' AS name", "stores": "SELECT 1 AS store_id, 's' AS store_name"}

    def users(name, date):
        write_snapshot(spark.sql(f"SELECT 1L AS user_id, '{name}' AS full_name"), lake.folder("metadata.users"), date, schemas.USERS)

    for table, sql in one.items():
        write_snapshot(spark.sql(sql), lake.folder(f"metadata.{table}"), "2023-12-31", schemas.DIMENSIONS[table])
    users("old", "2023-12-31")
    df = events(spark, [(1, "2024-01-01 10:00:00"), (2, "2024-01-01 11:00:00"), (1, "2024-01-02 10:00:00"), (1, "2024-01-01 10:30:00")])
    lines = lines_of(df)
    run = lambda: finish(start_live_silver(read_message_files(spark, source, max_files=1), lake, offsets, ANY))
    for number in (0, 1):
        land(source, [lines[number], "{broken"], number)
    run()
    users("new", "2024-01-02")
    land(source, lines[2:], 2)
    run()
    run()  # nothing is left
    got = rows_of(read_table(spark, lake.folder(LIVE_TABLE), schemas.SILVER_EVENTS), "event_id", "full_name", "category_name", "hour")
    assert got == [("0", "old", "c", "10"), ("1", None, "c", "11"), ("2", "new", "c", "10"), ("3", "old", "c", "10")]
