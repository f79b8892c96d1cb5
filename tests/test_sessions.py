import datetime as dt

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from clickmill.operators.sessions import assign_sessions, platform_sessions, session_spans
from frames import events, rows_of


def test_gap_of_exactly_half_an_hour_stays_and_one_second_more_splits(spark):
    df = events(spark, [(1, "2024-01-01 00:00:00"), (1, "2024-01-01 00:30:00"),
                        (1, "2024-01-01 01:00:00.5"), (1, "2024-01-01 01:30:01")])
    assert rows_of(assign_sessions(df), "event_id", "session_id") == [
        ("0", "1_1"), ("1", "1_1"), ("2", "1_1"), ("3", "1_2")]


def test_tied_times_share_a_session_and_midnight_cuts(spark):
    df = events(spark, [(1, "2024-01-01 23:50:00"), (1, "2024-01-01 23:50:00"), (1, "2024-01-02 00:05:00")])
    spans = rows_of(session_spans(df), "date", "events")
    assert spans == [("2024-01-01", 2), ("2024-01-02", 1)]


def test_null_users_have_no_session_id_and_form_one_row_per_platform(spark):
    df = events(spark, [(None, "2024-01-01 00:00:00"), (None, "2024-01-01 09:00:00"),
                        (None, "2024-01-01 09:00:00", "IOS"), (1, "2024-01-01 00:00:00")])
    assert [r[1] for r in rows_of(assign_sessions(df), "event_id", "session_id")] == [None, None, None, "1_1"]
    assert rows_of(platform_sessions(df), "user_id", "platform", "events") == [
        (1, "WEB", 1), (None, "IOS", 1), (None, "WEB", 2)]


def test_session_over_two_platforms_has_a_row_on_each(spark):
    df = events(spark, [(1, "2024-01-01 00:29:59", "WEB"), (1, "2024-01-01 00:30:00", "IOS"),
                        (1, "2024-01-01 00:31:00", "IOS")])
    assert rows_of(platform_sessions(df), "platform", "events") == [("IOS", 2), ("WEB", 1)]
    starts = {r[0] for r in platform_sessions(df).select("session_start").collect()}
    assert len(starts) == 1


def test_shuffled_assignment_agrees_with_broadcast(spark):
    df = events(spark, [(u % 3, f"2024-01-01 {h:02d}:{m:02d}:00") for u in range(6) for h in range(4) for m in (0, 29)])
    assert rows_of(assign_sessions(df), "event_id", "session_id") == rows_of(
        assign_sessions(df, broadcast_bytes=0), "event_id", "session_id")


def brute_force(rows, gap):
    """Event index -> session number, event by event in time order."""
    numbers = {}
    by_user = {}
    for i, (user, second) in enumerate(rows):
        by_user.setdefault(user, []).append((second, i))
    for user, timed in by_user.items():
        number, previous = 0, None
        for second, i in sorted(timed):
            if previous is None or second - previous > gap:
                number += 1
            numbers[str(i)] = f"{user}_{number}"
            previous = second
    return numbers


@settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(st.integers(1, 3), st.integers(0, 400)), min_size=1, max_size=60), st.integers(2, 90))
def test_blocks_agree_with_event_by_event_sessions(spark, rows, gap):
    start = dt.datetime(2024, 1, 1)
    df = events(spark, [(u, str(start + dt.timedelta(seconds=s))) for u, s in rows])
    got = dict(rows_of(assign_sessions(df, gap=gap), "event_id", "session_id"))
    assert got == brute_force(rows, gap)
    sizes = {}
    for session in brute_force(rows, gap).values():
        sizes[session] = sizes.get(session, 0) + 1
    assert sorted(sizes.values()) == sorted(r[0] for r in platform_sessions(df, gap).groupBy(
        "user_id", "session_start").agg(F.sum("events")).select("sum(events)").collect())
