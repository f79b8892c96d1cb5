"""Message streams with a ``value`` column."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def read_topic(spark: SparkSession, servers: str, topic: str, max_offsets: int | None = None,
               starting: str = "earliest", options: dict[str, str] | None = None) -> DataFrame:
    """A Kafka topic, by default from its first message.

    ``starting`` counts only for a new checkpoint: a query that restarts goes on where it stopped. To replay a topic,
    start a query with a fresh checkpoint folder. ``max_offsets`` bounds one micro-batch.
    """
    reader = (spark.readStream.format("kafka").option("kafka.bootstrap.servers", servers)
              .option("subscribe", topic).option("startingOffsets", starting))
    if max_offsets:
        reader = reader.option("maxOffsetsPerTrigger", str(max_offsets))
    return reader.options(**(options or {})).load()


def read_message_files(spark: SparkSession, path: str, max_files: int | None = None) -> DataFrame:
    """Text files with one message per line, in the order of their arrival."""
    reader = spark.readStream.format("text")
    if max_files:
        reader = reader.option("maxFilesPerTrigger", str(max_files))
    return reader.load(path)


def write_topic(messages: DataFrame, servers: str, topic: str, options: dict[str, str] | None = None) -> None:
    """Publish ``key`` and ``value`` in one batch."""
    (messages.select("key", "value").write.format("kafka").option("kafka.bootstrap.servers", servers)
     .option("topic", topic).options(**(options or {})).save())
