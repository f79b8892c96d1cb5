"""Stages that clean and tokenise ``documents``: quality rules, line dedup, near-dedup, decontamination, tokens.

Each stage takes what the one before has kept and writes its result to the shared folder. Defined cases are those of the
operators, but from near-dedup on a document is what is equal in id and text: null and repeated ids are judged row by row, by
a key of id and text. Rows equal in both become one.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clickmill.llm import bpe, decontaminate, line_dedup, quality_rules, simhash
from clickmill.llm.common import materialize, prepare, read_table
from clickmill.llm.registry import RANKS

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def keyed(docs: DataFrame) -> DataFrame:
    """The documents with ``__row``, a key of id and text that is never null; its least is the least id, null ids last."""
    body = F.coalesce("text", F.lit(""))
    return docs.withColumn("__row", F.struct(
        F.col("doc_id").isNull().alias("missing"), F.coalesce("doc_id", F.lit(0)).cast("bigint").alias("id"),
        F.xxhash64(body).alias("h1"), F.xxhash64(F.lit("second"), body).alias("h2")))


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the default policy of the quality rules, judged by the stored ledger.

    Without the table the verdict's filter would be pushed below the measurements and compute them over and over.
    """
    stored = materialize(quality_rules.ledger(docs), "quality-ledger")
    judged = quality_rules.apply_policy(stored, name="__kept")
    return judged.where("__kept").select(*docs.columns)


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without repeated three-line passages; a document that lost all its lines goes, ``n_chars`` is counted anew."""
    cut = line_dedup.dedup_lines(docs)
    left = cut.where((F.size("removed_lines") == 0) | (F.length(F.col("text")) > 0))
    return left.withColumn("n_chars", F.when(F.size("removed_lines") > 0, F.length("text")).otherwise(F.col("n_chars"))
                           .cast(docs.schema["n_chars"].dataType)).select(*docs.columns)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each SimHash group, the one of the least key; repeated rows of it become one."""
    rows = keyed(docs)
    least = simhash.near_duplicates(rows, doc_id="__row").where(F.col("doc_id") == F.col("component_id")).select(
        F.col("doc_id").alias("__row")).distinct()
    return rows.join(least, "__row").dropDuplicates(["__row"]).select(*docs.columns)


def benchmark_free(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item, with or without an id."""
    items = read_table(spark, sf_dir, "benchmark")
    return decontaminate.decontaminate(keyed(docs), items, key="__row").select(*docs.columns)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents with their token ids, checked by decoding them: ``round_trip`` tells whether the text came back."""
    encoded = bpe.encode_and_decode(docs, RANKS)
    same = F.col("decoded") == F.encode(F.coalesce("text", F.lit("")), "UTF-8")
    return encoded.withColumn("round_trip", same).drop("decoded")


STAGES: list[tuple[str, Stage]] = [
    ("quality_rules", quality),
    ("line_dedup", lines),
    ("simhash_near_dedup", near_copies),
    ("benchmark_decontamination", benchmark_free),
    ("byte_bpe", tokens),
]

#: SimHash over XXH64 has no counterpart in SQL; a test holds the stages against plain Python.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(prepare(spark), sf_dir, "documents")
    for name, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
