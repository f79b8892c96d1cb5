"""Continuous ingestion of messages into the hot tier."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from clickmill.operators.messages import good_events, parse_messages, quarantined
from clickmill.sources.sinks import overwrite_partitions

HOT_PARTITIONS = ("date", "hour", "batch")


def start_ingest(messages: DataFrame, hot_root: str, quarantine_root: str, checkpoint: str,
                 id_pattern: str | None = None, every: str | None = None) -> StreamingQuery:
    """Decode a stream of messages; good ones go to ``hot_root``, rejected ones to ``quarantine_root``.

    Each micro-batch overwrites its own ``batch=`` folders, so a batch that is repeated after a failure leaves the same
    files: with the checkpointed offsets every message counts once. A batch is named by the id of the query, which the
    checkpoint stores, and its number: queries with other checkpoints, such as a replay or a second topic, never
    overwrite each other's batches in the same root. No state is kept and no late event is dropped: an event lands in the
    hour of its own time. A replay repeats events under new batches; copies share their hour, and reading through
    ``dedup`` or archiving the hour keeps one. Without ``every`` the query takes what is there and ends.
    """
    def write(batch: DataFrame, number: int) -> None:
        parsed = parse_messages(batch, id_pattern).persist()
        try:
            query = batch.sparkSession.sparkContext.getLocalProperty("sql.streaming.queryId")
            stamp = F.lit(f"{query}-{number}").alias("batch")
            overwrite_partitions(good_events(parsed).select("*", stamp), hot_root, HOT_PARTITIONS)
            overwrite_partitions(quarantined(parsed).select("*", stamp), quarantine_root, ("batch",))
        finally:
            parsed.unpersist()

    writer = messages.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
    writer = writer.trigger(processingTime=every) if every else writer.trigger(availableNow=True)
    return writer.start()


def distinct_events(events: DataFrame, lateness: str) -> DataFrame:
    """Streaming duplicate removal with bounded state, for sinks that cannot deduplicate on reading.

    Copies are recognised while they arrive within ``lateness`` of each other in event time. Events later than that
    are dropped by the watermark, so pick it longer than any replay.
    """
    return events.withWatermark("occurred_at", lateness).dropDuplicatesWithinWatermark(["event_id"])
