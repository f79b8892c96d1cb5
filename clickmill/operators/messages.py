"""JSON event messages: decode, check, quarantine, encode."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from clickmill.functions.columns import all_set, canonical_uuid, date_key, hour_key, lenient_timestamp
from clickmill.schemas import EVENT_MESSAGE, HOT_EVENTS

PREVIEW_LENGTH = 200
MAX_KEY = 4294967295  # keys are unsigned 32-bit in the hot table


def parse_messages(messages: DataFrame, id_pattern: str | None = None) -> DataFrame:
    """Decode the ``value`` column into event fields plus ``problem``, which is null for a good message.

    Event ids must be UUIDs and are put in canonical form; with ``id_pattern`` they must match that instead.
    """
    parsed_type = T.StructType([*EVENT_MESSAGE.fields, T.StructField("_corrupt_record", T.StringType())])
    # One-row generators hold the decoded values: a later filter on ``problem`` would otherwise be pushed below and
    # decode each message again for every field it looks at.
    decoded = messages.withColumn("__text", F.col("value").cast("string")).select(
        "*", F.inline(F.array(F.from_json("__text", parsed_type, {"mode": "PERMISSIVE"}))))
    checked = decoded.select(*messages.columns, "__text", "_corrupt_record", F.inline(F.array(F.struct(
        _checked_id(F.col("event_id"), id_pattern).alias("event_id"), "user_id", "product_id", "event_type",
        "platform", lenient_timestamp(F.col("occurred_at")).alias("occurred_at"),
        all_set(EVENT_MESSAGE.names).alias("__complete")))))
    in_range = F.col("user_id").between(0, MAX_KEY) & F.col("product_id").between(0, MAX_KEY)
    problem = (F.when(F.col("__text").isNull(), "empty message")
               .when(F.col("_corrupt_record").isNotNull(), "malformed json")
               .when(~F.col("__complete"), "missing field")
               .when(F.col("event_id").isNull(), "bad event id")
               .when(F.col("occurred_at").isNull(), "bad time")
               .when(~in_range, "key out of range"))
    return checked.withColumn("problem", problem).drop("_corrupt_record")


def _checked_id(raw: Column, pattern: str | None) -> Column:
    return canonical_uuid(raw) if pattern is None else F.when(raw.rlike(pattern), raw)


def good_events(parsed: DataFrame) -> DataFrame:
    """Valid events in the hot-table layout; date and hour come from the event's own time."""
    return parsed.where(F.col("problem").isNull()).select(
        "event_id", "user_id", "product_id", "event_type", "platform", "occurred_at",
        date_key(F.col("occurred_at")).alias("date"), hour_key(F.col("occurred_at")).alias("hour")
    ).select(*HOT_EVENTS.names)


def quarantined(parsed: DataFrame) -> DataFrame:
    """Rejected messages: why, a short preview for logs, and the whole message."""
    return parsed.where(F.col("problem").isNotNull()).select(
        "problem", F.substring("__text", 1, PREVIEW_LENGTH).alias("preview"), F.col("__text").alias("message"))


def encode_events(events: DataFrame) -> DataFrame:
    """Events as keyed JSON messages, ready for a Kafka sink."""
    message = F.struct(
        "event_id", "user_id", "product_id", "event_type", "platform",
        F.date_format("occurred_at", "yyyy-MM-dd HH:mm:ss").alias("occurred_at"))
    return events.select(F.col("event_id").alias("key"), F.to_json(message).alias("value"))
