"""Exact n-tiles from cut rows that are found by counting, without sorting a group.

The tiles of a group are fixed by the last row of each tile. Such a cut row lies at a known position, so only positions need
counting. Every cut has an interval of keys that holds it, at first the whole group. While an interval holds more rows than
one task should sort, its rows are counted in bins between its least and greatest key; the bin with the cut becomes the new
interval. Bins follow the value first and, once all values of an interval tie, the tie-breaker, so a tied run of any
length is cut as well. Counts are summed on the map side; rows move only when their interval is small enough to be sorted.
A row's tile is one more than the number of cut rows before it.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Observation, Window
from pyspark.sql import functions as F

from clickmill.operators.lookup import BROADCAST_BYTES, row_bytes
from clickmill.session import materialize

# Rows of an interval that are sorted in one place, and bins of an interval that holds more.
MOST_ROWS = 20_000
BINS = 1024


def sort_value(number: Column) -> Column:
    """A double that can be binned and sorts as Spark sorts: null, minus infinity, numbers, infinity, NaN."""
    number = number.cast("double")
    return (F.when(number.isNull(), F.lit(-1e300)).when(F.isnan(number), F.lit(1e300))
            .otherwise(F.least(F.greatest(number, F.lit(-9e299)), F.lit(9e299))))


def sort_tie(number: Column) -> Column:
    """A bigint tie-breaker with null as the least; numbers beyond 2 to the 61 would leave too little room to subtract."""
    return F.coalesce(number.cast("bigint"), F.lit(-(1 << 61)))


def _same(by: Sequence[str], left: str, right: str) -> Column:
    return reduce(lambda a, b: a & b, [F.col(f"{left}.{c}").eqNullSafe(F.col(f"{right}.{c}")) for c in (*by, "score")])


def _keys(rows: DataFrame, keys: Sequence[Column], by: Sequence[str]) -> DataFrame:
    """One row per row and score, with nothing but group, score and key."""
    pairs = [F.struct(F.lit(i).alias("score"), key.alias("key")) for i, key in enumerate(keys)]
    return rows.select(*by, F.explode(F.array(*pairs)).alias("p")).select(*by, "p.score", "p.key")


def _between(key: Column, low: Column, high: Column) -> Column:
    return (key >= low) & (key <= high)


def _bin(key: Column, low: Column, high: Column, bins: int) -> Column:
    """Bin of a key: 0 holds the least key of the interval, the last one the greatest, so every round cuts something off."""
    value = (key["v"] - low["v"]) / (high["v"] - low["v"])
    tie = (key["t"] - low["t"]).cast("double") / (high["t"] - low["t"]).cast("double")
    part = F.when(low["v"] < high["v"], value).when(low["t"] < high["t"], tie).otherwise(F.lit(0.0))
    return F.floor(part * (bins - 1)).cast("int")


class State(NamedTuple):
    """The cuts of all groups and scores, each with its interval."""
    table: DataFrame
    bytes: int
    widest: int  # rows of the largest interval

    @classmethod
    def store(cls, table: DataFrame) -> State:
        """Written once; the figures come from the write itself."""
        seen = Observation()
        stored = materialize(table.observe(
            seen, F.coalesce(F.sum(row_bytes(table) + 64), F.lit(0)).alias("bytes"),
            F.coalesce(F.max("rows"), F.lit(0)).alias("widest")), "cuts")
        return cls(stored, seen.get["bytes"], seen.get["widest"])

    def small(self, part: DataFrame) -> DataFrame:
        """Something that is no larger than the state, broadcast if that is known to be small."""
        return F.broadcast(part) if self.bytes <= BROADCAST_BYTES else part


def _narrow(keys: DataFrame, current: State, by: Sequence[str], most_rows: int, bins: int) -> State:
    """One round: intervals with too many rows shrink to the bin that holds their cut."""
    state = current.table
    wide = state.where(F.col("rows") > most_rows)
    intervals = wide.select(*by, "score", "low", "high").distinct()
    hits = keys.alias("k").join(current.small(intervals).alias("i"),
                                _same(by, "k", "i") & _between(F.col("k.key"), F.col("i.low"), F.col("i.high")))
    counted = hits.groupBy(*[F.col(f"i.{c}").alias(c) for c in (*by, "score", "low", "high")],
                           _bin(F.col("k.key"), F.col("i.low"), F.col("i.high"), bins).alias("bin")).agg(
        F.count(F.lit(1)).alias("n"), F.min("k.key").alias("least"), F.max("k.key").alias("greatest"))
    # at most ``bins`` rows per interval
    before = Window.partitionBy(*by, "score", "low", "high").orderBy("bin").rowsBetween(Window.unboundedPreceding, -1)
    placed = counted.withColumn("before", F.coalesce(F.sum("n").over(before), F.lit(0)))
    same = _same(by, "w", "c") & (F.col("w.low") == F.col("c.low")) & (F.col("w.high") == F.col("c.high"))
    found = (F.col("w.rank") > F.col("c.before")) & (F.col("w.rank") <= F.col("c.before") + F.col("c.n"))
    smaller = wide.alias("w").join(placed.alias("c"), same & found).select(
        *[F.col(f"w.{c}") for c in (*by, "score", "cut")], (F.col("w.rank") - F.col("c.before")).alias("rank"),
        F.col("c.n").alias("rows"), F.col("c.least").alias("low"), F.col("c.greatest").alias("high"))
    return State.store(state.where(F.col("rows") <= most_rows).unionByName(smaller))


def _find_intervals(rows: DataFrame, k: int, keys: Mapping[str, Column], by: Sequence[str], most_rows: int, bins: int) -> State:
    """Every cut with an interval of at most ``most_rows`` rows that holds it, and its position there."""
    ends = [F.struct(F.min(key).alias("low"), F.max(key).alias("high")).alias(f"ends_{i}") for i, key in enumerate(keys.values())]
    groups = rows.groupBy(*by).agg(F.count(F.lit(1)).alias("rows"), *ends).where("rows > 0")
    scores = F.explode(F.array(*[F.struct(F.lit(i).alias("score"), F.col(f"ends_{i}").alias("ends")) for i in range(len(keys))]))
    cuts = groups.select(*by, "rows", scores.alias("s")).select(
        *by, "rows", "s.score", "s.ends.low", "s.ends.high", F.explode(F.sequence(F.lit(1), F.lit(k - 1))).alias("cut"))
    # With N rows the first N mod k tiles hold one row more than the rest.
    rank = F.col("cut") * F.expr(f"rows div {k}") + F.least(F.col("cut"), F.expr(f"rows % {k}"))
    state = State.store(cuts.select(*by, "score", "cut", rank.cast("bigint").alias("rank"), "rows", "low", "high"))
    while state.widest > most_rows:
        state = _narrow(_keys(rows, list(keys.values()), by), state, by, most_rows, bins)
    return state


def cut_keys(rows: DataFrame, k: int, keys: Mapping[str, Column], by: Sequence[str] = (), most_rows: int = MOST_ROWS,
             bins: int = BINS) -> DataFrame:
    """One row per group with, per score, the keys of the last rows of its tiles 1 to ``k - 1`` as an array."""
    return _sorted_cuts(rows, keys, by, _find_intervals(rows, k, keys, by, most_rows, bins))


def _sorted_cuts(rows: DataFrame, keys: Mapping[str, Column], by: Sequence[str], state: State) -> DataFrame:
    """Sort the few rows of each interval and take the ones at the cuts' positions."""
    span = F.struct("cut", "rank", "low", "high")
    spans = state.table.groupBy(*by).agg(*[
        F.sort_array(F.collect_list(F.when(F.col("score") == i, span))).alias(f"__spans_{i}") for i in range(len(keys))])
    spans = spans.select(*[F.col(c).alias(f"__of_{c}") for c in by], *[f"__spans_{i}" for i in range(len(keys))])
    same = reduce(lambda a, b: a & b, [F.col(c).eqNullSafe(F.col(f"__of_{c}")) for c in by], F.lit(True))

    def near(i: int, key: Column) -> Column:
        inside = F.exists(f"__spans_{i}", lambda s: _between(key, s["low"], s["high"]))
        return F.sort_array(F.collect_list(F.when(inside, key))).alias(f"__near_{i}")

    def found(i: int, name: str) -> Column:
        # Cuts that share one interval, as in every group of at most ``most_rows`` rows, need no search for its keys. As the keys
        # are named twice, Spark sorts them once per group and not anew inside the function for each cut.
        spans, near = F.col(f"__spans_{i}"), F.col(f"__near_{i}")
        shared = F.size(F.array_distinct(F.transform(spans, lambda s: F.struct(s["low"], s["high"])))) == 1
        place = lambda keys, s: F.get(keys, (s["rank"] - 1).cast("int"))
        inside = lambda s: F.filter(near, lambda key: _between(key, s["low"], s["high"]))
        return F.when(shared, F.transform(spans, lambda s: place(near, s))).otherwise(
            F.transform(spans, lambda s: place(inside(s), s))).alias(name)

    grouped = rows.join(state.small(spans), same).groupBy(*by).agg(
        *[near(i, key) for i, key in enumerate(keys.values())], *[F.first(f"__spans_{i}").alias(f"__spans_{i}") for i in range(len(keys))])
    return grouped.select(*by, *[found(i, name) for i, name in enumerate(keys)])


def tiles(rows: DataFrame, k: int, scores: Mapping[str, tuple[Column, Column]], by: Sequence[str] = (),
          most_rows: int = MOST_ROWS, bins: int = BINS) -> DataFrame:
    """``ntile(k)`` per group for each of ``scores``, named by its key and ordered by (value, tie-breaker), both ascending.

    ``rows`` is read several times, so pass a stored table. Values are numbers (see ``sort_value``), tie-breakers bigints that
    make the order total. The scores are found together.
    """
    if k < 2:
        return rows.withColumns({name: F.lit(1) for name in scores})
    keys = {name: F.struct(value.cast("double").alias("v"), tie.cast("bigint").alias("t")) for name, (value, tie) in scores.items()}
    state = _find_intervals(rows, k, keys, by, most_rows, bins)
    cuts = _sorted_cuts(rows, keys, by, state).select(
        *[F.col(c).alias(f"__by_{c}") for c in by], *[F.col(name).alias(f"__cuts_{name}") for name in scores])
    same = reduce(lambda a, b: a & b, [F.col(c).eqNullSafe(F.col(f"__by_{c}")) for c in by], F.lit(True))
    joined = rows.join(state.small(cuts), same)
    tile = {name: (F.size(F.filter(f"__cuts_{name}", lambda cut: cut < key)) + 1).alias(name) for name, key in keys.items()}
    return joined.select(*rows.columns, *tile.values())
