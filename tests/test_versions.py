import random

import pytest
from pyspark.sql import functions as F

from clickmill.operators import lookup, versions
from clickmill.operators.versions import attach_as_of, by_period, cut_periods, fold_versions, require_snapshots
from clickmill.session import materialize, path_exists, step_tables
from frames import rows_of

DAYS = [f"2024-01-{d:02d}" for d in range(1, 29)]


def snapshots_at_random(spark, dates, keys=12, seed=2):
    """Full copies in which keys change, vanish and come back."""
    r = random.Random(seed)
    content = {d: {k: r.choice(["a", "b", None]) for k in range(keys) if r.random() < 0.8} for d in dates}
    rows = [(k, v, d) for d, copy in content.items() for k, v in copy.items()]
    return content, spark.createDataFrame(rows, "id bigint, name string, date string")


def test_periods_show_the_newest_snapshot():
    got = cut_periods({"a": ["2024-01-01", "2024-01-05"], "b": ["2023-12-01", "2024-01-03", "2024-02-01"]}, "2024-01-02", "2024-01-31")
    assert [(p.number, p.start, p.shown["a"], p.shown["b"]) for p in got] == [
        (0, "2024-01-02", "2024-01-01", "2023-12-01"), (1, "2024-01-03", "2024-01-01", "2024-01-03"),
        (2, "2024-01-05", "2024-01-05", "2024-01-03")]


@pytest.mark.parametrize("broadcast_bytes", [0, 1 << 20])
def test_events_get_the_version_of_their_day(spark, broadcast_bytes):
    dates = ["2024-01-01", "2024-01-04", "2024-01-09", "2024-01-10", "2024-01-20"]
    content, table = snapshots_at_random(spark, dates)
    periods = cut_periods({"t": dates, "other": ["2024-01-01", "2024-01-07"]}, DAYS[0], DAYS[-1])
    versions = fold_versions(by_period(table, "t", periods), "id", periods)
    r = random.Random(3)
    # one key owns two thirds of the rows
    events = [(i, r.choice([3, 3, 3, 3, r.randrange(15), None]), r.choice([*DAYS, None])) for i in range(600)]
    fact = spark.createDataFrame(events, "n int, id bigint, date string")
    got = rows_of(attach_as_of(fact, versions, "id", broadcast_bytes=broadcast_bytes))
    newest = lambda day: content[max(d for d in dates if d <= day)]
    assert got == sorted([(n, k, day, newest(day).get(k) if day else None) for n, k, day in events], key=repr)


def test_versions_are_as_long_as_they_can_be(spark):
    rows = [(1, "a", 0), (1, "a", 1), (1, "b", 2), (1, "a", 3), (2, None, 0), (2, None, 2), (None, "x", 0)]
    table = spark.createDataFrame(rows, "id bigint, name string, __period int")
    periods = cut_periods({"t": ["2024-01-01", "2024-01-02", "2024-01-03", "2024-01-04"]}, "2024-01-01", "2024-01-31")
    assert rows_of(fold_versions(table, "id", periods), "id", "name", "valid_from", "valid_to") == sorted([
        (1, "a", "2024-01-01", "2024-01-03"), (1, "b", "2024-01-03", "2024-01-04"), (1, "a", "2024-01-04", None),
        (2, None, "2024-01-01", "2024-01-02"), (2, None, "2024-01-03", "2024-01-04")], key=repr)


def test_unready_snapshots_are_refused(spark):
    table = spark.createDataFrame([(1, "a", "2024-01-05"), (1, "b", "2024-01-05")], "id bigint, name string, date string")
    check = lambda rows, first, optional=(): require_snapshots(
        {"t": rows}, {"t": "id"}, cut_periods({"t": ["2024-01-05"]}, first, "2024-01-31"), optional)
    with pytest.raises(ValueError, match="not loaded"):
        check(table, "2024-01-01")
    with pytest.raises(ValueError, match="key repeats"):
        check(table, "2024-01-05")
    with pytest.raises(ValueError, match="not loaded"):
        check(table.where("false"), "2024-01-05")
    check(table.where("name = 'a'"), "2024-01-05")
    check(table.where("name = 'a'"), "2024-01-01", ["t"])


def test_the_large_side_needs_one_exchange_per_join(spark):
    """Broadcast versions leave the events where they are."""
    dates = ["2024-01-01", "2024-01-04"]
    _, table = snapshots_at_random(spark, dates)
    periods = cut_periods({"t": dates}, DAYS[0], DAYS[-1])
    fact = spark.range(100).select("id", F.lit("2024-01-03").alias("date"))
    plan = attach_as_of(fact, fold_versions(by_period(table, "t", periods), "id", periods), "id")._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" not in plan and "BroadcastHashJoin" in plan


def written(monkeypatch):
    """Purposes and paths of the tables that are materialised from here on."""
    made, real = [], versions.materialize
    for module in (versions, lookup):
        monkeypatch.setattr(module, "materialize", lambda df, purpose: made.append((purpose, real(df, purpose))) or made[-1][1])
    return made


@pytest.mark.parametrize("dates", [["2024-01-01"], ["2024-01-01", "2024-01-09"]])
def test_large_versions_are_folded_once(spark, dates, monkeypatch):
    """The rest of the job reads stored versions; it neither folds them again nor lists pairs of keys and days."""
    _, table = snapshots_at_random(spark, dates)
    periods = cut_periods({"t": dates}, DAYS[0], DAYS[-1])
    fact = spark.range(400).select((F.col("id") % 9).alias("id"), F.lit("2024-01-11").alias("date"))
    made = written(monkeypatch)
    folded = fold_versions(by_period(table, "t", periods), "id", periods)
    plan = attach_as_of(fact, folded, "id", broadcast_bytes=0)._jdf.queryExecution().optimizedPlan().toString()
    assert [purpose for purpose, _ in made] == ["weights", "versions"]
    assert "Window" not in plan


def test_large_versions_of_which_few_occur_are_broadcast(spark):
    table = spark.range(20_000).select("id", F.lit("x").alias("name"), F.lit("2024-01-01").alias("date"))
    periods = cut_periods({"t": ["2024-01-01"]}, DAYS[0], DAYS[-1])
    fact = spark.range(1_000).select((F.col("id") % 20).alias("id"), F.lit("2024-01-03").alias("date"))
    got = attach_as_of(fact, fold_versions(by_period(table, "t", periods), "id", periods), "id", broadcast_bytes=100_000)
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" not in plan and "BroadcastHashJoin" in plan
    assert rows_of(got.groupBy("name").count()) == [("x", 1_000)]


def test_one_period_gives_every_key_one_version(spark):
    rows = spark.createDataFrame([(1, "a", 0), (2, None, 0), (None, "x", 0), (1, "a", 0)], "id bigint, name string, __period int")
    periods = cut_periods({"t": ["2024-01-01"]}, "2024-01-05", "2024-01-31")
    assert rows_of(fold_versions(rows, "id", periods), "id", "name", "valid_from", "valid_to") == [
        (1, "a", "2024-01-05", None), (2, None, "2024-01-05", None)]


def test_tables_of_a_step_go_with_it(spark):
    with step_tables(spark):
        inside = materialize(spark.range(3), "step")
        [folder] = {name.rsplit("/", 1)[0] for name in inside.inputFiles()}
        assert path_exists(spark, folder) and inside.count() == 3
    assert not path_exists(spark, folder)
    after = materialize(spark.range(3), "step")
    assert after.count() == 3
