"""Connected components of a link table that never leaves the executors."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clickmill.llm.common import discard, materialize


def _both_ways(links: DataFrame) -> DataFrame:
    return links.select(F.explode(F.array(
        F.struct(F.col("a").alias("u"), F.col("b").alias("v")),
        F.struct(F.col("b").alias("u"), F.col("a").alias("v")))).alias("e")).select("e.u", "e.v")


def connected_components(links: DataFrame) -> DataFrame:
    """(node, root) with the least node of each component as root, for every node that has a link.

    Alternating star contraction: each round hangs all larger neighbours of a node on its least neighbour, then all its
    smaller neighbours; the table of links is written after each round, and rounds end when it no longer changes, which they do
    after at most about the squared logarithm of the number of nodes. A node
    with very many neighbours is only ever aggregated to a minimum and joined, where adaptive execution splits it.
    """
    current = materialize(links.where("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(),
                          "links")
    state = None
    while True:
        around = _both_ways(current)
        least = around.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = around.where("v > u").join(least, "u").select(F.col("m").alias("a"), F.col("v").alias("b")).where("a <> b").distinct()
        # small star: of a node and its smaller neighbours, all hang on the least
        small_least = large.groupBy("b").agg(F.min("a").alias("m"))
        small = (large.join(small_least, "b")
                 .select(F.explode(F.array(F.struct(F.col("m").alias("a"), F.col("b").alias("b")),
                                           F.struct(F.col("m").alias("a"), F.col("a").alias("b")))).alias("e"))
                 .select("e.a", "e.b").where("a <> b").distinct())
        before, current = current, materialize(small, "links")
        discard(before)
        row = current.agg(F.count(F.lit(1)).alias("n"), F.bit_xor(F.xxhash64("a", "b")).alias("h")).first()
        if (row["n"], row["h"]) == state:
            return current.select(F.col("b").alias("node"), F.col("a").alias("root")).unionByName(
                current.select(F.col("a").alias("node"), F.col("a").alias("root")).distinct())
        state = (row["n"], row["h"])
