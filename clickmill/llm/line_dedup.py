"""Repeated passages of lines, by overlapping three-line windows.

Every three consecutive lines of a document are hashed to 128 bits. Of equal windows in the whole corpus the first one, by
document id and line number, is the original; all later ones are removed, and a line goes when any removed window covers
it. Windows are judged on the input, not on what is left.

Counting per window is combined on the map side, so a window that a third of all rows share meets as one partial count per
task; the later occurrences are found by a join on the window, which adaptive execution splits where one window is hot.

Defined cases: lines are split at the line feed and compared as they are; windows of blank lines only do not count; a text
of fewer than three lines, an empty one and a null one stay as they are; rows equal in id and text are one document, so a
repeated row is not a later occurrence of itself; rows of one id with different texts are documents of their own, ordered by
a 62-bit hash of the text; null ids come before all others; other columns pass through.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clickmill.llm.common import materialize, text_of

WINDOW = 3
BLANK = " \t\r\f\x0b"


def _lines(text: Column) -> Column:
    return F.split(text, "\n")


def _document(docs: DataFrame, text: str, doc_id: str) -> list[Column]:
    """What tells documents apart: the id, a missing one as the least bigint, and a hash of the text."""
    return [F.coalesce(F.col(f"`{doc_id}`").cast("bigint"), F.lit(-2**63)).alias("__doc"),
            F.xxhash64(text_of(text)).bitwiseAND(F.lit(2**62 - 1)).alias("__hash")]


def windows(docs: DataFrame, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """(__doc, __hash, line, h1, h2, again) of every three-line window that holds more than blanks.

    ``again``: an earlier line of the same row starts an equal window.
    """
    lines, spots = F.col("lines"), F.col("spots")
    three = lambda i: [F.get(lines, i + k) for k in range(WINDOW)]
    full = lambda i: F.length(F.btrim(F.concat(*three(i)), F.lit(BLANK))) > 0
    places = F.filter(F.sequence(F.lit(0), F.size(lines) - WINDOW), full)
    hashed = F.transform(places, lambda i: F.struct(
        F.xxhash64(*three(i)).alias("h1"), F.xxhash64(F.lit("second"), *three(i)).alias("h2"), i.alias("line")))

    def marked(w: Column, i: Column) -> Column:
        before = F.get(spots, i - 1)
        again = F.coalesce((before["h1"] == w["h1"]) & (before["h2"] == w["h2"]), F.lit(False))
        return F.struct(w["line"].alias("line"), w["h1"].alias("h1"), w["h2"].alias("h2"), again.alias("again"))

    rows = docs.select(*_document(docs, text, doc_id), _lines(text_of(text)).alias("lines"))
    return (rows.where(F.size("lines") >= WINDOW).select("__doc", "__hash", F.array_sort(hashed).alias("spots"))
            # explode proper would make Spark test the array's size first and compute it again for that
            .select("__doc", "__hash", F.explode_outer(F.transform(spots, marked)).alias("w")).where("w IS NOT NULL")
            .select("__doc", "__hash", "w.*"))


def repeated_lines(docs: DataFrame, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """(__doc, __hash, removed) with the sorted numbers of the lines that later occurrences cover."""
    rows = materialize(windows(docs, text, doc_id), "line-windows")
    # id and hash in one number, which the hash aggregation can keep the least of
    place = (F.col("__doc").cast("decimal(19,0)") * F.lit(2**62).cast("decimal(19,0)")
             + F.col("__hash").cast("decimal(19,0)")).cast("decimal(38,0)")
    first = rows.groupBy("h1", "h2").agg(F.min(place).alias("first"), F.count(F.lit(1)).alias("n")).where("n > 1").drop("n")
    later = rows.join(first, ["h1", "h2"]).where((place > F.col("first")) | F.col("again"))
    starts = later.groupBy("__doc", "__hash").agg(F.collect_set("line").alias("starts"))
    covered = F.flatten(F.transform("starts", lambda s: F.sequence(s, s + (WINDOW - 1))))
    return starts.select("__doc", "__hash", F.array_sort(F.array_distinct(covered)).alias("removed"))


def dedup_lines(docs: DataFrame, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """The documents with their text cut, and ``removed_lines``, the numbers of the lines that went."""
    gone = repeated_lines(docs, text, doc_id).withColumnRenamed("removed", "__removed")
    joined = docs.select("*", *_document(docs, text, doc_id)).join(gone, ["__doc", "__hash"], "left")
    lines = F.col("__lines")
    left = F.array_except(F.sequence(F.lit(0), F.size(lines) - 1), F.col("__removed"))
    cut = F.array_join(F.transform(left, lambda i: F.get(lines, i)), "\n")
    return (joined.withColumn("__lines", _lines(text_of(text)))
            .withColumn(text, F.when(F.col("__removed").isNull(), F.col(f"`{text}`")).otherwise(cut))
            .withColumn("removed_lines", F.coalesce("__removed", F.array().cast("array<int>")))
            .select(*[F.col(f"`{c}`") for c in docs.columns if c != "removed_lines"], "removed_lines"))


def line_digest(docs: DataFrame) -> DataFrame:
    """Per document: lines, removed lines, runs of removed lines and the hash of what is left."""
    lines = F.size(_lines(text_of("__text")))
    runs = F.filter("removed_lines", lambda x, i: F.coalesce(F.get("removed_lines", i - 1) != x - 1, F.lit(True)))
    return dedup_lines(docs.select("doc_id", "text", F.col("text").alias("__text"))).select(
        "doc_id", lines.cast("bigint").alias("n_lines"), F.size("removed_lines").cast("bigint").alias("n_removed"),
        F.size(runs).cast("bigint").alias("n_spans"), F.sha2(F.encode(text_of(), "UTF-8"), 256).alias("kept_sha256"))
