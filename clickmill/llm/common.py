"""What the text operators share: reading, word splitting, session settings and work tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from clickmill.session import apply_runtime_conf, materialize, remove_paths, shared_folder

__all__ = ["prepare", "read_table", "words_of", "text_of", "materialize", "shared_folder", "remove_paths",
           "discard", "total_text_bytes"]

#: White space that separates words, as a Java character class.
SPACE = r"[\x20\x09-\x0D]"


def prepare(spark: SparkSession) -> SparkSession:
    """Session settings of this subpackage.

    Shuffle files are dropped as soon as the query that wrote them has ended: every operator here hands results from
    job to job as tables in the shared folder, so nothing reads them again. Arrow batches are cut by bytes, since
    the number of rows says little about texts that differ a thousandfold in length.
    """
    apply_runtime_conf(spark)
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(8 << 20))
    spark.conf.set("spark.sql.classic.shuffleDependency.fileCleanup.enabled", "true")
    return spark


def read_table(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def text_of(column: str = "text") -> Column:
    """The text, a null one as empty."""
    return F.coalesce(F.col(column).cast("string"), F.lit(""))


def words_of(text: Column) -> Column:
    """Words of a text: maximal runs without white space."""
    return F.array_remove(F.split(text, SPACE + "+"), "")


def discard(table: DataFrame) -> None:
    """Deletes a work table that ``materialize`` made and nothing needs any more."""
    remove_paths(table.sparkSession, sorted({name.rsplit("/", 1)[0] for name in table.inputFiles()}))


def total_text_bytes(docs: DataFrame, column: str = "text") -> int:
    """UTF-8 bytes of all texts, for choosing a number of partitions."""
    row = docs.agg(F.sum(F.octet_length(text_of(column)).cast("bigint")).alias("n")).first()
    return int(row["n"] or 0)
