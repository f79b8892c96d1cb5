import random

import pytest
from pyspark.sql import functions as F

from clickmill.plans import hourly, summaries
from clickmill.plans.funnel import funnel_conversion
from clickmill.plans.session_performance import session_performance
from clickmill.sources import sinks
from frames import rows_of, silver

DAY = "2024-01-01"
KINDS = ["SEARCH", "VIEW_PRODUCT", "ADD_TO_CART", "PURCHASE", "OTHER"]


def day_of_events(spark, n=400, seed=1):
    r = random.Random(seed)
    rows = []
    for i in range(n):
        second = r.choice([r.randrange(86400), r.randrange(0, 86400, 1800), r.randrange(3000, 4200)])
        user = r.choice([1, 1, 1, 2, 3, 4, 5, -7, 0, 32768, 32769, 1 << 40, None])
        at = f"{DAY} {second // 3600:02d}:{second // 60 % 60:02d}:{second % 60:02d}"
        rows.append((str(i), at, r.choice(KINDS), r.choice(["WEB", "IOS", "ANDROID"]), user, None, 1, 1.0))
    return silver(spark, rows + [("x", f"{DAY} 05:00:00", "OTHER", "TV", None, None, 1, 1.0)])


@pytest.fixture
def lake(tmp_path):
    return hourly.Lake(str(tmp_path / "cold"), str(tmp_path / "hot"))


def put_hour(lake, rows, hour):
    return sinks.replace_partition(rows.where(F.col("hour") == hour), lake.folder("silver.wide_table_events"), {"date": DAY, "hour": hour})


def wide(df):
    """Silver rows with all columns of the contract."""
    missing = [f for f in summaries.schemas.SILVER_EVENTS if f.name not in df.columns]
    return df.select("*", *[F.lit(None).cast(f.dataType).alias(f.name) for f in missing]).select(*summaries.schemas.SILVER_EVENTS.names)


def test_hours_in_any_order_and_late_events_make_the_daily_mart(spark, lake):
    rows = wide(day_of_events(spark)).cache()
    hours = sorted({r.hour for r in rows.select("hour").collect()})
    late = F.col("event_id").endswith("3")
    order = hours[12:15] + hours[:12]
    for hour in order[:3]:
        put_hour(lake, rows.where(~late), hour)
        hourly.build_mart(spark, lake, "session_performance", DAY, hour)
    mart = lambda: rows_of(spark.read.parquet(lake.folder("gold.fact_session_performance")).drop("date"))
    expected = lambda df: rows_of(session_performance(df).drop("date"))
    assert mart() == expected(rows.where(~late & F.col("hour").isin(order[:3])))
    put_hour(lake, rows, order[0])          # late events of an hour that was done
    for hour in hours:
        if hour not in order[:3]:
            put_hour(lake, rows.where(~late) if hour in order else rows, hour)
    hourly.build_mart(spark, lake, "session_performance", DAY, order[0], order[5])  # the rest is noticed by itself
    assert mart() == expected(rows.where(~late | (F.col("hour") == order[0]) | ~F.col("hour").isin(order)))


def test_only_changed_hours_of_silver_are_read(spark, lake):
    rows = wide(day_of_events(spark))
    for hour in ("01", "02", "03"):
        put_hour(lake, rows, hour)
    all_three = [(DAY, "01"), (DAY, "02"), (DAY, "03")]
    assert summaries.refresh(spark, lake, "session_pieces", all_three) == all_three
    assert summaries.refresh(spark, lake, "session_pieces", all_three[2:]) == all_three[2:]
    read = summaries.silver_hours(spark, lake, all_three[2:])
    plan = read._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters" in plan and "date" in plan.split("PartitionFilters")[1].split("]")[0]
    assert {r[0].split("hour=")[1][:2] for r in read.select(F.input_file_name()).distinct().collect()} == {"03"}
    day = summaries.sessions_by_day(summaries.read_summary(spark, lake, "session_pieces", DAY, DAY))
    assert "wide_table_events" not in "".join(day.inputFiles())


def test_a_lost_hour_leaves_the_day(spark, lake):
    rows = wide(day_of_events(spark))
    for hour in ("01", "02"):
        put_hour(lake, rows, hour)
        hourly.build_mart(spark, lake, "session_performance", DAY, hour)
    put_hour(lake, rows.where("false"), "01")
    hourly.build_mart(spark, lake, "session_performance", DAY, "01")
    assert rows_of(spark.read.parquet(lake.folder("gold.fact_session_performance")).drop("date")) == rows_of(
        session_performance(rows.where("hour = '02'")).drop("date"))


@pytest.mark.parametrize("gap", [1800, 2500, 50])
def test_pieces_of_hours_merge_for_any_gap(spark, gap):
    rows = day_of_events(spark, seed=gap)
    merged = summaries.sessions_by_day(summaries.summarise_sessions(rows, gap), gap)
    assert rows_of(merged) == rows_of(session_performance(rows, gap))


def test_bitmaps_count_distinct_users_exactly(spark):
    rows = day_of_events(spark)
    bitmaps = summaries.summarise_funnel(rows)
    assert rows_of(summaries.funnel_from_bitmaps(bitmaps)) == rows_of(funnel_conversion(rows, ("date",)))
    assert rows_of(summaries.funnel_from_bitmaps(bitmaps, ("date", "hour"))) == rows_of(funnel_conversion(rows))
    assert ("TV", 0) in rows_of(summaries.funnel_from_bitmaps(bitmaps), "device_type", "step_1_visit")


def test_sketches_of_hours_merge(spark):
    rows = day_of_events(spark)
    got = dict(rows_of(summaries.users_from_sketches(summaries.summarise_users(rows)), "platform", "users"))
    assert got == dict(rows_of(rows.groupBy("platform").agg(F.count_distinct("user_id"))))
