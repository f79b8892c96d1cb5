"""Benchmark items inside documents, by size-partitioned MinHash containment.

An item and a document are sets of five-word shingles, and an item is found where a document holds at least ``threshold``
of its shingles. A fixed number of minima per document would lose a short item in a long document, so the sketch of a
document grows with its size: it keeps every hash up to a bound, a fixed share of the document's shingles. Items are
partitioned by size, and the partition sets the item's sketch. Of ``n`` shingles at most ``n - ceil(threshold * n)`` may be
missing, so one more least hash than that is certain to meet a document that holds the item; that is the sketch of the
partitions of short items. Long items stop at ``SKETCH`` minima, of which one in 400,000 pairs at containment 0.8 shares
none. The bound of a partition is the greatest hash of its sketches. Document sketches for the partitions nest, so one join by
hash with the widest serves all of them: an item's minima lie below its own partition's bound anyway. An item and a
document that share a minimum are a candidate pair, and candidates are verified by counting shared shingles as strings.

The item tables are written first, so that Spark knows their size and broadcasts them only below its threshold.

Defined cases: words are lower-cased; an item of fewer than five words is one shingle of all its words and matches only a
document of exactly these words; an empty or null item matches nothing; rows of equal document id count as one document,
rows of equal item id as one item; null ids cannot be reported and are left out; other columns are not read.
DataFrame functions only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clickmill.llm.common import materialize, text_of, words_of

SHINGLE = 5
#: Most least hashes that stand for an item.
SKETCH = 8
THRESHOLD = 0.8


def shingles(words: Column) -> Column:
    """Shingles of a text's words as strings, repeats included."""
    rows = F.transform(F.sequence(F.lit(0), F.size(words) - SHINGLE), lambda i: F.concat_ws(
        " ", *[F.get(words, i + k) for k in range(SHINGLE)]))
    whole = F.when(F.size(words) > 0, F.array(F.array_join(words, " "))).otherwise(F.array().cast("array<string>"))
    return F.when(F.size(words) >= SHINGLE, rows).otherwise(whole)


def shingle_hashes(words: Column) -> Column:
    """Hashes of the shingles, without building the strings."""
    rows = F.transform(F.sequence(F.lit(0), F.size(words) - SHINGLE), lambda i: F.xxhash64(
        *[F.get(words, i + k) for k in range(SHINGLE)]))
    whole = F.when(F.size(words) > 0, F.array(F.xxhash64(F.array_join(words, " ")))).otherwise(F.array().cast("array<bigint>"))
    return F.when(F.size(words) >= SHINGLE, rows).otherwise(whole)


def _rows(table: DataFrame, key: str, text: str) -> DataFrame:
    return table.where(F.col(key).isNotNull()).select(F.col(key).alias(key), words_of(F.lower(text_of(text))).alias("words"))


def sketch_size(n: Column, threshold: float) -> Column:
    """Least hashes that stand for an item of ``n`` shingles: all that certainty takes, or ``SKETCH``."""
    missing = n - F.ceil(F.lit(threshold) * n - F.lit(1e-9))
    return F.least(F.lit(SKETCH), F.greatest(missing + 1, F.lit(1))).cast("int")


def item_tables(items: DataFrame, threshold: float = THRESHOLD, key: str = "item_id",
                text: str = "text") -> tuple[DataFrame, DataFrame, DataFrame]:
    """Item shingles (item_id, shingle, n_shingles), sketches (hash, item_id) and partitions (part, bound)."""
    rows = _rows(items, key, text).withColumnRenamed(key, "item_id")
    single = (rows.select("item_id", F.explode(shingles(F.col("words"))).alias("shingle")).distinct())
    sizes = single.groupBy("item_id").agg(F.count(F.lit(1)).alias("n_shingles"))
    full = materialize(single.join(sizes, "item_id"), "item-shingles")
    hashed = rows.select("item_id", F.explode(F.array_distinct(shingle_hashes(F.col("words")))).alias("hash")).distinct()
    least = hashed.groupBy("item_id").agg(F.array_sort(F.collect_list("hash")).alias("h"))
    sketch = materialize(least.select("item_id", F.floor(F.log2(F.size("h"))).cast("int").alias("part"),
                                      F.explode(F.slice("h", F.lit(1), sketch_size(F.size("h"), threshold))).alias("hash")), "item-sketches")
    return full, sketch.select("hash", "item_id"), sketch.groupBy("part").agg(F.max("hash").alias("bound"))


def contaminated(docs: DataFrame, items: DataFrame, threshold: float = THRESHOLD, text: str = "text",
                 key: str = "doc_id") -> DataFrame:
    """(doc_id, item_id, n_shared, n_shingles, containment) of every item found in a document; ``key`` tells documents apart."""
    full, sketch, parts = item_tables(items, threshold)
    # one number per power of two of the item size; the widest share of a document's hashes covers all partitions
    bound = parts.agg(F.max("bound").alias("b")).first()["b"]
    if bound is None:
        bound = -2**63
    rows = _rows(docs, key, text).withColumnRenamed(key, "doc_id")
    minima = (rows.select("doc_id", F.explode(shingle_hashes(F.col("words"))).alias("hash"))
              .where(F.col("hash") <= F.lit(bound)))
    candidates = materialize(minima.join(sketch, "hash").select("doc_id", "item_id").distinct(), "candidates")
    near = rows.join(candidates.select("doc_id").distinct(), "doc_id", "left_semi")
    shared = (near.select("doc_id", F.explode(F.array_distinct(shingles(F.col("words")))).alias("shingle"))
              .join(full, "shingle").join(candidates, ["doc_id", "item_id"], "left_semi")
              .groupBy("doc_id", "item_id", "n_shingles").agg(F.count_distinct("shingle").alias("n_shared")))
    found = shared.where(F.col("n_shared") >= F.lit(threshold) * F.col("n_shingles") - F.lit(1e-9))
    return found.select("doc_id", "item_id", "n_shared", "n_shingles",
                        (F.col("n_shared") / F.col("n_shingles")).alias("containment"))


def decontaminate(docs: DataFrame, items: DataFrame, threshold: float = THRESHOLD, key: str = "doc_id") -> DataFrame:
    """The documents that hold no item. A document whose ``key`` is null cannot be matched and stays."""
    found = contaminated(docs, items, threshold, key=key).select(F.col("doc_id").alias(key)).distinct()
    return docs.join(found, key, "left_anti").select(*docs.columns)
