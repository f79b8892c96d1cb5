"""Quality score of texts: histogram gradient-boosted trees over document statistics.

The statistics are built-in expressions, written once as a narrow table. The trees are complete binary trees of a fixed
depth, flattened into arrays (feature and bound per inner node, value per leaf), and a batch of documents walks all of
them at once in numpy. Fitting takes at most ``TRAIN_ROWS`` labelled rows, picked by the hash of their id; it bins the
statistics at quantiles and grows trees level by level on histograms of gradients. The rows where crc32(doc_id) mod 4 is 2
are held out. Label, language, source and id never enter a score.

Defined cases: a null or empty text has all-zero statistics and a score like any other; a null id is not held out; a document
with several labels has its lowest; labels that are null or of unknown documents are not used; without labels of both
kinds every score is the smoothed share of label 1; an empty table gives an empty result; other columns are not carried.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from clickmill.llm.common import SPACE, materialize, text_of, words_of

TRAIN_ROWS = 20_000
TREES, DEPTH, RATE, BINS = 60, 4, 0.15, 64
LEAST_HESSIAN, RIDGE = 1.0, 1.0
THRESHOLD = 0.7


def statistics(docs: DataFrame, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """(doc_id, x) with the statistics of every text."""
    staged = (docs.select(F.col(f"`{doc_id}`").alias("doc_id"), text_of(text).alias("t"))
              .withColumn("w", words_of(F.col("t")))
              .withColumn("l", F.filter(F.split("t", "\n"), lambda line: F.length(F.regexp_replace(line, SPACE + "+", "")) > 0)))
    body, words, lines = F.col("t"), F.col("w"), F.col("l")
    chars = F.greatest(F.length(body), F.lit(1))
    n_words, n_lines = F.greatest(F.size(words), F.lit(1)), F.greatest(F.size(lines), F.lit(1))

    def share(kind: str, of: Column) -> Column:
        return (F.length(body) - F.length(F.regexp_replace(body, kind, ""))) / of

    stats = [
        F.log1p(F.size(words)), F.log1p(F.size(lines)), F.length(F.array_join(words, "")) / n_words,
        F.size(F.array_distinct(words)) / n_words, F.size(F.array_distinct(lines)) / n_lines, n_words / n_lines,
        share(r"\p{Lu}", chars), share("[0-9]", chars), share(r"[#*$%&|<>]", n_words), share("!", n_words),
        share("[.,;:?]", n_words), share(r"[^\p{L}\p{N}\s]", chars), share(r"[^\x00-\x7F]", chars),
        F.size(F.split(body, r"[.!?]\s")) / n_words, share(r"[\"'@=/\\]", n_words),
    ]
    return staged.select("doc_id", F.array(*[s.cast("double") for s in stats]).alias("x"))


@dataclass
class Trees:
    """Flattened complete trees: node k has the children 2k+1 and 2k+2."""

    feature: np.ndarray  # trees x inner nodes
    bound: np.ndarray
    leaf: np.ndarray     # trees x leaves
    start: float

    def scores(self, x: np.ndarray) -> np.ndarray:
        total, rows = np.full(len(x), self.start), np.arange(len(x))
        for feature, bound, leaf in zip(self.feature, self.bound, self.leaf):
            node = np.zeros(len(x), np.int64)
            for _ in range(DEPTH):
                node = 2 * node + 1 + (x[rows, feature[node]] > bound[node])
            total += leaf[node - len(feature)]
        return 1 / (1 + np.exp(-total))


def fit(x: np.ndarray, y: np.ndarray) -> Trees:
    share = (y.sum() + 1) / (len(y) + 2)
    start = float(np.log(share / (1 - share)))
    inner, leaves = 2 ** DEPTH - 1, 2 ** DEPTH
    if len(np.unique(y)) < 2:
        return Trees(np.zeros((0, inner), np.int64), np.zeros((0, inner)), np.zeros((0, leaves)), start)
    n, m = x.shape
    edges = [np.unique(np.quantile(x[:, f], np.linspace(0, 1, BINS + 1)[1:-1])) for f in range(m)]
    binned = np.stack([np.searchsorted(edges[f], x[:, f], side="left") for f in range(m)], 1)
    total = np.full(n, start)
    features, bounds, values = [], [], []
    for _ in range(TREES):
        p = 1 / (1 + np.exp(-total))
        g, h = p - y, p * (1 - p)
        feature, bound = np.zeros(inner, np.int64), np.full(inner, np.inf)
        node = np.zeros(n, np.int64)
        for level in range(DEPTH):
            first, width = 2 ** level - 1, 2 ** level
            best = np.full(width, 1e-9)
            for f in range(m):
                cell = (node - first) * BINS + binned[:, f]
                gs = np.bincount(cell, g, width * BINS).reshape(width, BINS).cumsum(1)
                hs = np.bincount(cell, h, width * BINS).reshape(width, BINS).cumsum(1)
                gl, hl, gt, ht = gs[:, :-1], hs[:, :-1], gs[:, -1:], hs[:, -1:]
                gain = gl**2 / (hl + RIDGE) + (gt - gl)**2 / (ht - hl + RIDGE) - gt**2 / (ht + RIDGE)
                gain[(hl < LEAST_HESSIAN) | (ht - hl < LEAST_HESSIAN)] = -1
                gain[:, len(edges[f]):] = -1
                cut = gain.argmax(1)
                top = gain[np.arange(width), cut]
                for k in np.flatnonzero(top > best).tolist():
                    best[k], feature[first + k], bound[first + k] = top[k], f, edges[f][cut[k]]
            node = 2 * node + 1 + (x[np.arange(n), feature[node]] > bound[node])
        leaf = node - inner
        value = -RATE * np.bincount(leaf, g, leaves) / (np.bincount(leaf, h, leaves) + RIDGE)
        total += value[leaf]
        features.append(feature)
        bounds.append(bound)
        values.append(value)
    return Trees(np.array(features), np.array(bounds), np.array(values), start)


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def fit_quality(stats: DataFrame, labels: DataFrame, most: int = TRAIN_ROWS) -> Trees:
    """Fits on labelled rows that are not held out; at most ``most`` rows reach the driver."""
    lowest = labels.where("doc_id is not null and quality is not null").groupBy("doc_id").agg(F.min("quality").alias("y"))
    rows = stats.join(lowest, "doc_id").where(~held_out(F.col("doc_id"))).select("x", "y", F.xxhash64("doc_id", "x").alias("order"))
    total = lowest.count()
    # a rough share first, so that no task sorts many more than it needs
    share = min(1_000_000, max(1, 2 * most * 1_000_000 // max(1, total)))
    sample = rows.where(F.pmod("order", F.lit(1_000_000)) < share).orderBy("order").limit(most).select("x", "y").toPandas()
    x = np.stack(sample["x"]) if len(sample) else np.zeros((0, 1))
    return fit(np.asarray(x, float), sample["y"].to_numpy(float) if len(sample) else np.zeros(0))


def score_quality(stats: DataFrame, trees: Trees) -> DataFrame:
    @F.pandas_udf(T.DoubleType())
    def score(x: pd.Series) -> pd.Series:
        return pd.Series(trees.scores(np.stack(x)) if len(x) else [], dtype="float64")

    return stats.withColumn("score", score("x"))


def quality_scores(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(doc_id, held_out, score, predicted) of every document."""
    stats = materialize(statistics(docs), "quality-statistics")
    scored = score_quality(stats, fit_quality(stats, labels))
    return scored.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score",
                         (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))
