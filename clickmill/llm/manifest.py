"""Merkle manifest of a dataset: one digest that fixes every row, and a proof for each row.

Every row is a leaf, the hash of its fields with their lengths. The leaves of one group (such as a language), in the order of
their key, are reduced pair by pair to a subroot, and the subroots, in the order of the groups, to the root. A proof is the list
of the siblings on the way from a leaf to the root; folding a leaf with its siblings must give the root.

1. Leaves are computed by Spark's own functions into a narrow table and numbered inside their group by range partitions and
   one count per range, so a group of any size spreads over tasks.
2. Upwards, ``2 ** LEVELS`` consecutive nodes, a superblock, become one node of the next tier, until every group has one node. A tier
   is a thousandth of the one below.
3. Downwards, tier by tier, nodes are cogrouped by superblock with the outer row of the superblock: the siblings from its top
   to the root. One ``applyInPandas`` redoes the local reduction, which gives the siblings inside the superblock, joins the
   outer siblings behind them and, at the leaves, folds. So a task sees one superblock and one outer row, however large
   the group, and each node is exchanged twice.

Every tier is a table in the shared folder; a lost executor repeats its tasks.

Defined cases: a null field is ``-``, unlike an empty one; null groups come first, others in the order of their UTF-8 bytes; null
keys come first; equal keys are ordered by their leaf, so equal rows share nothing but their leaf and each has its own place; a
table of one row has its leaf as root and the hash of nothing as proof; an empty table gives an empty manifest. Only the named
fields are read, so extra columns cannot clash.
"""

from __future__ import annotations

import hashlib
from collections.abc import Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clickmill.llm.common import materialize
from clickmill.operators.ranking import number_rows

#: Levels of the tree inside a superblock, of 1,024 nodes.
LEVELS = 10
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")

def leaf_hash(fields: Sequence[str], changed: dict[str, Column] | None = None) -> Column:
    """Hash of the fields of a row, each as its bytes' number, a colon and its text, or as ``-``."""
    parts = []
    for name in fields:
        value = (changed or {}).get(name, F.col(f"`{name}`")).cast("string")
        parts.append(F.when(value.isNull(), F.lit("-")).otherwise(
            F.concat(F.octet_length(value).cast("string"), F.lit(":"), value)))
    return F.sha2(F.concat(*parts), 256)


def digest(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def reduce_levels(nodes: list[str], count: int) -> list[list[str]]:
    """The nodes and ``count`` levels above them; a last node without a neighbour is hashed alone."""
    levels = [nodes]
    for _ in range(count):
        below = levels[-1]
        levels.append([digest("".join(below[k:k + 2])) for k in range(0, len(below), 2)])
    return levels


def fold(node: str, siblings: Sequence[str], sides: str) -> str:
    """The node joined with its siblings one after the other: ``<`` left of it, ``>`` right of it, ``.`` none."""
    rest = iter(siblings)
    for side in sides:
        node = digest(next(rest) + node if side == "<" else node + next(rest) if side == ">" else node)
    return node


def _local_paths(levels: list[list[str]]) -> tuple[list[list[str]], list[str]]:
    """Per node of the lowest level its siblings inside the superblock and their sides."""
    paths: list[list[str]] = [[] for _ in levels[0]]
    sides = [""] * len(paths)
    for height, level in enumerate(levels[:-1]):
        for k in range(len(paths)):
            other = (k >> height) ^ 1
            if other < len(level):
                paths[k].append(level[other])
                sides[k] += "<" if other < k >> height else ">"
            else:
                sides[k] += "."
    return paths, sides


NODES = "tree string, pos bigint, total bigint, node string"
OUTER = "tree string, block bigint, subroot string, siblings array<string>, sides string"


def _numbered(rows: DataFrame, order: list[Column]) -> DataFrame:
    """Place in the tree, from 0, and size of the tree."""
    return number_rows(rows, order, by=["tree"]).select(
        *rows.columns, (F.col("__rn") - 1).alias("pos"), F.col("__rows").cast("bigint").alias("total"))


class Forest:
    """Tiers of trees whose superblocks have ``levels`` levels."""

    def __init__(self, levels: int) -> None:
        self.levels = levels

    def grouped(self, nodes: DataFrame):
        return nodes.withColumn("block", F.shiftright("pos", self.levels)).groupBy("tree", "block")

    def reduce(self, nodes: list[str], total: int) -> list[list[str]]:
        """A superblock of a tree with ``total`` nodes and the levels above it, fewer if the tree ends in it."""
        return reduce_levels(nodes, self.levels if total > 1 << self.levels else (total - 1).bit_length())

    def above(self, nodes: DataFrame) -> list[DataFrame]:
        """The tier of ``nodes`` and all above it; the last has one node per tree."""
        def top(group: pd.DataFrame) -> pd.DataFrame:
            group = group.sort_values("pos")
            tree, total = group["tree"].iloc[0], int(group["total"].iloc[0])
            return pd.DataFrame({"tree": [tree], "pos": [int(group["pos"].iloc[0]) >> self.levels],
                                 "total": [-(-total >> self.levels)], "node": self.reduce(list(group["node"]), total)[-1]})

        tiers = [nodes]
        while (tiers[-1].agg(F.max("total")).first()[0] or 0) > 1:
            thin = tiers[-1].select("tree", "pos", "total", "node")
            tiers.append(materialize(self.grouped(thin).applyInPandas(lambda group: top(group), NODES), "merkle-tier"))
        return tiers

    def join(self, nodes: pd.DataFrame, outer: pd.DataFrame) -> tuple[pd.DataFrame, list[list[str]], list[str]]:
        """The nodes of one superblock in order, with their siblings up to the root and the sides of these."""
        nodes = nodes.sort_values("pos", ignore_index=True)
        paths, sides = _local_paths(self.reduce(list(nodes["node"]), int(nodes["total"].iloc[0])))
        beyond, beyond_sides = list(outer["siblings"].iloc[0]), outer["sides"].iloc[0]
        return nodes, [path + beyond for path in paths], [side + beyond_sides for side in sides]

    def exchange(self, nodes: DataFrame, outer: DataFrame, step, schema: str) -> DataFrame:
        """``step`` on every superblock with its outer row."""
        return self.grouped(nodes).cogroup(outer.groupBy("tree", "block")).applyInPandas(
            lambda inside, outside: step(*self.join(inside, outside), outside), schema)

    def below(self, tiers: list[DataFrame], outer: DataFrame) -> DataFrame:
        """The outer rows of the lowest tier's superblocks, given those of the trees' tops."""
        def step(nodes: pd.DataFrame, paths: list, sides: list, outer: pd.DataFrame) -> pd.DataFrame:
            return pd.DataFrame({"tree": nodes["tree"], "block": nodes["pos"], "subroot": outer["subroot"].iloc[0],
                                 "siblings": paths, "sides": sides})

        for tier in reversed(tiers[1:]):
            outer = materialize(self.exchange(tier, outer, step, OUTER), "merkle-outer")
        return outer


def _one_top(tops: DataFrame) -> DataFrame:
    """Outer row of the only superblock of the highest tier of each tree: nothing is outside."""
    return tops.select("tree", F.lit(0).cast("bigint").alias("block"), F.col("node").alias("subroot"),
                       F.array().cast("array<string>").alias("siblings"), F.lit("").alias("sides"))


def manifest(rows: DataFrame, fields: Sequence[str] = FIELDS, key: str = "doc_id", group: str = "lang",
             tampered: dict[str, Column] | None = None, levels: int = LEVELS) -> DataFrame:
    """Per row: the key, ``leaf``, ``subroot``, ``root``, ``siblings`` and ``sides`` of the proof, ``folded_root``.

    ``tampered`` replaces fields before folding, to try whether proofs find a change: the folded root then starts from the leaf of
    the changed row. Without it the stored leaf is folded.
    """
    own = leaf_hash(fields)
    claimed = leaf_hash(fields, tampered) if tampered else own
    name = F.col(f"`{group}`").cast("string")
    leaves = materialize(rows.select(
        F.col(f"`{key}`").alias("key"), F.when(name.isNull(), "0").otherwise(F.concat(F.lit("1"), name)).alias("tree"),
        own.alias("node"), F.when(claimed != own, claimed).alias("claimed")), "merkle-leaves")
    leaves = _numbered(leaves, [F.col("key").asc_nulls_first(), F.col("node").asc()])

    forest = Forest(levels)
    tiers = forest.above(leaves)
    subroots = tiers[-1].select(F.lit("").alias("tree"), F.col("tree").alias("of"), "node")
    groups = materialize(_numbered(subroots, [F.col("of").asc()]), "merkle-subroots")
    tiers_of_groups = forest.above(groups)
    outer_of_groups = forest.below(tiers_of_groups, _one_top(tiers_of_groups[-1]))

    def of_group(nodes: pd.DataFrame, paths: list, sides: list, outer: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame({"tree": nodes["of"], "block": 0, "subroot": nodes["node"], "siblings": paths, "sides": sides})

    def finish(nodes: pd.DataFrame, paths: list, sides: list, outer: pd.DataFrame) -> pd.DataFrame:
        folded = [fold(claim or node, path, side) for claim, node, path, side in zip(nodes["claimed"], nodes["node"], paths, sides)]
        return pd.DataFrame({"key": nodes["key"], "leaf": nodes["node"], "subroot": outer["subroot"].iloc[0],
                             "siblings": paths, "sides": sides, "folded_root": folded})

    tops = materialize(forest.exchange(groups, outer_of_groups, of_group, OUTER), "merkle-outer")
    # the key as text, because pandas turns numbers with nulls into floats
    texts = leaves.withColumn("key", F.col("key").cast("string"))
    proofs = forest.exchange(texts, forest.below(tiers, tops), finish,
                             "key string, leaf string, subroot string, siblings array<string>, sides string, folded_root string")
    return proofs.select(F.col("key").cast(leaves.schema["key"].dataType).alias(key), "leaf", "subroot",
                         tiers_of_groups[-1].select("node").scalar().alias("root"), "siblings", "sides", "folded_root")


def manifest_digest(docs: DataFrame, levels: int = LEVELS) -> DataFrame:
    """The manifest of the documents, with one more in ``n_chars`` wherever 7 divides the checksum of the id."""
    touched = F.crc32(F.col("doc_id").cast("string")) % 7 == 0
    n_chars = F.when(touched, F.col("n_chars").cast("decimal(20,0)") + 1).otherwise(F.col("n_chars").cast("decimal(20,0)"))
    done = manifest(docs, tampered={"n_chars": n_chars}, levels=levels)
    return done.select("doc_id", "leaf", "subroot", "root", F.sha2(F.array_join("siblings", ""), 256).alias("proof_sha256"),
                       "folded_root", (F.col("folded_root") == F.col("root")).alias("verified"))
