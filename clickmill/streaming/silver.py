"""Silver as the messages arrive: every micro-batch is joined to the dimensions as they are by then."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from clickmill.operators.enrich import enrich_as_of
from clickmill.operators.messages import good_events, parse_messages
from clickmill.operators.tiering import to_bronze
from clickmill.operators.versions import require_snapshots
from clickmill.plans.hourly import DIMENSION_KEYS, Lake, dimension_tables, snapshot_periods
from clickmill.session import step_tables
from clickmill.sources.sinks import overwrite_partitions

LIVE_TABLE = "silver.live_events"


def start_live_silver(messages: DataFrame, lake: Lake, checkpoint: str, id_pattern: str | None = None,
                      every: str | None = None) -> StreamingQuery:
    """Decode a stream of messages and write wide events to ``LIVE_TABLE`` by date and batch, in few files.

    The snapshots are listed anew for each micro-batch, so one that was written in between is used by the next; an event gets
    the version of its own day. A batch overwrites its own folders, which the query id in the checkpoint and the batch number
    name, so a repeated batch leaves the same rows. Without ``every`` the query takes what is there and ends.
    """
    def write(batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        bronze = to_bronze(good_events(parse_messages(batch, id_pattern))).persist()
        try:
            days = bronze.agg(F.min("date").alias("first"), F.max("date").alias("last")).first()
            if days["first"] is None:
                return
            tables, periods = dimension_tables(spark, lake), snapshot_periods(spark, lake, days["first"], days["last"])
            require_snapshots(tables, DIMENSION_KEYS, periods, lake.optional)
            query = spark.sparkContext.getLocalProperty("sql.streaming.queryId")
            stamp = F.lit(f"{query}-{number}").alias("batch")
            with step_tables(spark):
                overwrite_partitions(enrich_as_of(bronze, tables, periods).select("*", stamp), lake.folder(LIVE_TABLE), ("date", "batch"))
        finally:
            bronze.unpersist()

    writer = messages.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
    writer = writer.trigger(processingTime=every) if every else writer.trigger(availableNow=True)
    return writer.start()
