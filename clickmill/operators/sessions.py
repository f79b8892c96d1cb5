"""Gap sessionization that never sorts the raw events of one user on one task.

Two events inside the same ``gap``-second block are always closer than the gap, so a session can only break between
blocks. Events are therefore first aggregated to (user, block) on the map side; the window then runs over at most
86,400 / gap rows per user and day, however many events a user has.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from clickmill.operators.lookup import BROADCAST_BYTES, attach
from clickmill.session import materialize

SESSION_GAP_SECONDS = 1800


def _with_block(events: DataFrame, gap: int) -> DataFrame:
    """Whole seconds of the event and the start of the gap-sized block that holds them."""
    return (events.withColumn("__sec", F.unix_timestamp("occurred_at"))
            .withColumn("__block", F.expr(f"__sec - pmod(__sec, {gap})")))


def session_blocks(events: DataFrame, gap: int = SESSION_GAP_SECONDS, grain: Sequence[str] = ("date",)) -> DataFrame:
    """One row per (grain, user, block) with the number of the session it belongs to.

    A session starts at the first event and wherever more than ``gap`` whole seconds have passed since the user's
    previous event of the same grain.
    """
    blocks = _with_block(events, gap).groupBy(*grain, "user_id", "__block").agg(
        F.min("__sec").alias("__first"), F.max("__sec").alias("__last"), F.count("event_id").alias("events"),
        F.count(F.lit(1)).alias("rows"))
    per_user = Window.partitionBy(*grain, "user_id").orderBy("__block")
    previous = F.lag("__last").over(per_user)
    starts = F.when(previous.isNull() | (F.col("__first") - previous > gap), 1).otherwise(0)
    blocks = blocks.withColumn("__starts", starts)
    index = F.sum("__starts").over(per_user)
    return blocks.select(
        *grain, "user_id", "__block", "__first", "__last", "events", "rows", index.alias("session_idx"),
        F.concat(F.col("user_id").cast("string"), F.lit("_"), index.cast("string")).alias("session_id"))


def assign_sessions(events: DataFrame, gap: int = SESSION_GAP_SECONDS, grain: Sequence[str] = ("date",),
                    broadcast_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """Add ``session_id`` (null for null users) to every event.

    The blocks are written once; their size and, by their row counts, the heavy ones are read from that table, so the
    events are scanned twice: for the blocks and for the join.
    """
    keys = [*grain, "user_id", "__block"]
    blocks = materialize(session_blocks(events, gap, grain).select(*keys, "session_id", "rows"), "session-blocks")
    joined = attach(_with_block(events, gap), blocks.select(*keys, "session_id"), keys, broadcast_bytes=broadcast_bytes,
                    weigh=blocks.select(*keys, F.col("rows").alias("__n")))
    return joined.select(*events.columns, "session_id")


def session_spans(events: DataFrame, gap: int = SESSION_GAP_SECONDS, grain: Sequence[str] = ("date",)) -> DataFrame:
    """One row per session: first and last event time and number of events."""
    return (session_blocks(events, gap, grain)
            .groupBy(*grain, "user_id", "session_id")
            .agg(F.timestamp_seconds(F.min("__first")).alias("session_start"),
                 F.timestamp_seconds(F.max("__last")).alias("session_end"),
                 F.sum("events").alias("events")))


def session_pieces(events: DataFrame, gap: int = SESSION_GAP_SECONDS, grain: Sequence[str] = ("date",)) -> DataFrame:
    """One row per (grain, user, block, platform): first and last second and number of events.

    Pieces of several parts of the same events, such as hours, may be put together and summed up by the same keys again: they are
    all that sessions need, whatever order the parts come in.
    """
    return _with_block(events, gap).groupBy(*grain, "user_id", F.col("__block").alias("block"), "platform").agg(
        F.min("__sec").alias("first_second"), F.max("__sec").alias("last_second"), F.count("event_id").alias("events"))


def sessions_of_pieces(pieces: DataFrame, gap: int = SESSION_GAP_SECONDS, grain: Sequence[str] = ("date",)) -> DataFrame:
    """One row per (grain, user, session, platform) with its number of events, from pieces unique by their keys."""
    per_user = Window.partitionBy(*grain, "user_id").orderBy("block")
    earlier = per_user.rangeBetween(Window.unboundedPreceding, -1)
    this_block = per_user.rangeBetween(Window.currentRow, Window.currentRow)
    pieces = (pieces
              .withColumn("__previous", F.max("last_second").over(earlier))
              .withColumn("__block_first", F.min("first_second").over(this_block)))
    begins = F.col("__previous").isNull() | (F.col("__block_first") - F.col("__previous") > gap)
    start = F.last(F.when(begins, F.col("__block_first")), ignorenulls=True).over(per_user)
    pieces = pieces.withColumn("session_start", F.when(F.col("user_id").isNotNull(), start))
    return (pieces.groupBy(*grain, "user_id", "session_start", "platform")
            .agg(F.sum("events").alias("events")))


def platform_sessions(events: DataFrame, gap: int = SESSION_GAP_SECONDS,
                      grain: Sequence[str] = ("date",)) -> DataFrame:
    """One row per (grain, user, session, platform) with its number of events.

    All events of null users of one platform form a single row, as their session has no id.
    """
    return sessions_of_pieces(session_pieces(events, gap, grain), gap, grain)
