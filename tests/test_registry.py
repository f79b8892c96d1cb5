"""Registered queries against DuckDB on the smallest tables. ``check.py`` runs all of them at any scale."""

import os

import pytest

import __spark_entry__ as entry
from check import compare

SMALL = "/root/testdata/sf0.001"
# These write hundreds of hour folders; check.py covers them.
SLOW = {"silver_partition_slice", "stream_ingest_dedup", "partition_replace_roundtrip", "gold_overwrite_roundtrip",
        "hour_archive_roundtrip", "catalog_sync_roundtrip", "gold_backfill", "late_hours_recomputed",
        "session_performance_from_hours", "funnel_daily_from_hours", "users_from_sketches_ok", "stream_silver",
        "stream_restart", "point_reads"}
TEXT = set(entry.LLM_QUERIES)  # tested in a folder of their own


def test_every_query_has_sql():
    assert set(entry.queries()) - TEXT <= set(entry.oracle_sql())
    assert set(entry.oracle_sql()) <= set(entry.queries())


@pytest.mark.skipif(not os.path.isdir(SMALL), reason="test tables are absent")
@pytest.mark.parametrize("name", sorted(set(entry.queries()) - SLOW - TEXT))
def test_query_equals_its_sql(spark, name):
    same, note = compare(spark, name, SMALL)
    assert same, note
