"""SimHash near-duplicates with a byte-position inverted index.

A fingerprint of 64 bits is eight bytes. Three differing bits touch at most three of them, so linked fingerprints share at
least five bytes at equal positions. The index posts every distinct fingerprint under groups of four positional bytes; the
fourteen groups are chosen so that any five positions contain one of them, hence no link is missed. Inside a posting list the
shared positional bytes of a pair are tallied, pairs with at least five are kept, and their differing bits are verified.

Copies collapse before the index: it holds each distinct fingerprint once. A posting list longer than ``BLOCK`` is split into
blocks that meet in pairs, so no task gathers an unbounded list, and a list answers with a spanning forest of its links
instead of all of them, so the output stays linear in its length while connectivity is complete. Groups are found by
alternating star contraction over a table in the shared folder.

Defined cases: a null or empty text has the fingerprint zero and is linked like any other; rows of equal id are separate
rows with one entry in their group; null ids get a group but never name it, unless all its ids are null (then it is null);
an empty table gives an empty result; other columns pass through.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations, repeat

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from clickmill.llm.common import materialize
from clickmill.llm.components import connected_components

#: Longest posting list, or block of one, that is compared at once.
BLOCK = 2048
MOST_BITS = 3
LEAST_BYTES = 8 - MOST_BITS
SHINGLE = 3
#: Hashes that are counted at once.
PIECE = 1 << 16


def fingerprint(text: str) -> int:
    """The 64-bit SimHash of a text over its three-word shingles, as a signed number."""
    words = text.encode("utf-8", "surrogatepass").lower().split()  # bytes: only A-Z change, only ASCII white space splits
    if not words:
        return 0
    n = max(1, len(words) - SHINGLE + 1)
    shingles = map(b" ".join, zip(*[words[k:] for k in range(SHINGLE)])) if len(words) >= SHINGLE else [b" ".join(words)]
    hashes = np.fromiter(map(xxhash.xxh64_intdigest, shingles, repeat(42)), "<u8", n)
    ones = np.zeros(64, np.int64)
    for low in range(0, n, PIECE):
        part = hashes[low:low + PIECE]
        ones += np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    value = sum(1 << bit for bit in np.flatnonzero(2 * ones > n).tolist())
    return value - (1 << 64) if value >> 63 else value


@F.pandas_udf(T.LongType())
def fingerprint_of(texts: pd.Series) -> pd.Series:
    return texts.map(fingerprint)


def position_groups() -> list[tuple[int, ...]]:
    """Four-position groups such that any five of the eight positions contain one: picked greedily by what they cover."""
    open_ = {frozenset(c) for c in combinations(range(8), LEAST_BYTES)}
    groups: list[tuple[int, ...]] = []
    while open_:
        best = max(combinations(range(8), 4), key=lambda g: (sum(set(g) <= c for c in open_), [-x for x in g]))
        groups.append(best)
        open_ = {c for c in open_ if not set(best) <= c}
    return groups


def _forest(left: np.ndarray, right: np.ndarray | None) -> list[tuple[int, int]]:
    """A spanning forest of the links inside ``left``, or between ``left`` and ``right``."""
    values = left if right is None else np.concatenate([left, right])
    first = 0 if right is None else len(left)
    view = values.view(np.uint8).reshape(-1, 8)
    label, links = np.arange(len(values)), []
    for i in range(len(left)):
        start = i + 1 if right is None else first
        shared = (view[start:] == view[i]).sum(1)  # tally of shared positional bytes
        near = start + np.flatnonzero(shared >= LEAST_BYTES)
        bits = np.bitwise_count(values[near] ^ values[i])
        for j in near[bits <= MOST_BITS].tolist():
            if label[i] != label[j]:
                links.append((int(values[i].astype(np.int64)), int(values[j].astype(np.int64))))
                label[label == label[j]] = label[i]
    return links


def _verify(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Links of posting lists: rows (first, second), two arrays of fingerprints; the second is empty inside one block."""
    for batch in batches:
        links: list[tuple[int, int]] = []
        for a, b in zip(batch["first"], batch["second"]):
            left = np.asarray(a, np.int64).view(np.uint64)
            right = np.asarray(b, np.int64).view(np.uint64)
            links += _forest(left, right if len(right) else None)
        yield pd.DataFrame(links, columns=["a", "b"], dtype="int64")


def fingerprint_links(prints: DataFrame) -> DataFrame:
    """Links (a, b) that connect what differs in at most three bits. ``prints``: distinct ``fp``."""
    groups = position_groups()
    masks = [sum(0xFF << (8 * p) for p in g) for g in groups]
    signed = lambda m: m - (1 << 64) if m >> 63 else m
    keys = F.array(*[F.struct(F.lit(i).alias("g"), F.col("fp").bitwiseAND(F.lit(signed(m)).cast("bigint")).alias("bytes"))
                     for i, m in enumerate(masks)])
    index = prints.select("fp", F.explode(keys).alias("k")).select("fp", "k.g", "k.bytes")
    lists = index.groupBy("g", "bytes").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    blocks = F.ceil(F.col("n") / BLOCK).cast("int")
    posted = (index.join(lists, ["g", "bytes"]).withColumn("blocks", blocks)
              .withColumn("own", F.pmod(F.xxhash64("fp"), F.col("blocks").cast("bigint")).cast("int")))
    # a block meets every block: rows (least, greatest) of the two block numbers
    met = posted.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))).select(
        "g", "bytes", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"),
        (F.col("own") > F.col("other")).alias("second"), "fp")
    pairs = met.groupBy("g", "bytes", "i", "j").agg(
        F.collect_list(F.when(~F.col("second"), F.col("fp"))).alias("first"),
        F.collect_list(F.when(F.col("second"), F.col("fp"))).alias("second"))
    full = pairs.where((F.size("first") > 0) & ((F.col("i") == F.col("j")) | (F.size("second") > 0)))
    return full.select("first", "second").mapInPandas(_verify, "a bigint, b bigint").distinct()


def near_duplicates(docs: DataFrame, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """(doc_id, fp, component_id) of every document."""
    marked = materialize(docs.select(F.col(f"`{doc_id}`").alias("doc_id"), fingerprint_of(
        F.coalesce(F.col(f"`{text}`").cast("string"), F.lit(""))).alias("fp")), "simhash-prints")
    prints = materialize(marked.groupBy("fp").agg(F.min("doc_id").alias("least")), "simhash-distinct")
    roots = connected_components(fingerprint_links(prints.select("fp")))
    rooted = prints.join(roots.withColumnRenamed("node", "fp"), "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    names = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    named = rooted.join(names, "root").select("fp", "component_id")
    return marked.join(named, "fp").select("doc_id", "fp", "component_id")


def simhash_digest(docs: DataFrame) -> DataFrame:
    return near_duplicates(docs).select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")
