"""Preference pairs: the shared prompt once, then two masked completions.

``preference_pairs`` takes chosen and rejected conversations of equal id, finds the longest common prefix of their turns,
renders it once as the prompt, and renders what follows on either side together with a mask: character spans of the
completion and whether they are trained on (assistant turns are, others are not).

Defined cases: turns without a conversation id belong to no pair; a null role or text counts as empty; turns are ordered
by number, then role, then text, a null number first, and an exactly repeated turn row counts once; a pair present on one
side only, or whose sides are equal, is left out, as it states no preference; extra columns are not carried.
A conversation is one rendered string, so it is gathered in one row; conversations are never gathered together.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

TRAINED_ROLE = "assistant"


def conversations_to_rows(turns: DataFrame) -> DataFrame:
    """One row per conversation: ``conv_id`` and its ordered ``turns`` as (role, text)."""
    text = lambda name: F.coalesce(F.col(name).cast("string"), F.lit(""))
    rows = turns.where(F.col("conv_id").isNotNull()).select(
        "conv_id", F.struct(F.col("turn").alias("turn"), text("role").alias("role"), text("text").alias("text")).alias("t"))
    ordered = F.array_distinct(F.array_sort(F.collect_list("t")))
    return rows.groupBy("conv_id").agg(
        F.transform(ordered, lambda t: F.struct(t["role"].alias("role"), t["text"].alias("text"))).alias("turns"))


def common_prefix(a: Column, b: Column) -> Column:
    """Length of the longest common prefix of two arrays of turns."""
    differs = F.transform(a, lambda t, i: ~t.eqNullSafe(F.get(b, i)))
    first = F.array_position(differs, True)
    return F.when(first > 0, first - 1).otherwise(F.size(a)).cast("int")


def render_turn(turn: Column) -> Column:
    return F.concat(F.lit("<|"), turn["role"], F.lit("|>\n"), turn["text"], F.lit("<|end|>\n"))


def render(turns: Column) -> Column:
    return F.array_join(F.transform(turns, render_turn), "")


def mask(turns: Column) -> Column:
    """Spans (start, stop, trained) of the rendered turns, in code points."""
    zero = F.array().cast("array<struct<start:int,stop:int,trained:boolean>>")

    def add(spans: Column, turn: Column) -> Column:
        start = F.coalesce(F.get(spans, F.size(spans) - 1)["stop"], F.lit(0))
        return F.concat(spans, F.array(F.struct(
            start.alias("start"), (start + F.length(render_turn(turn))).alias("stop"),
            (turn["role"] == TRAINED_ROLE).alias("trained"))))

    return F.aggregate(turns, zero, add)


def preference_pairs(chosen: DataFrame, rejected: DataFrame) -> DataFrame:
    """``chosen`` and ``rejected``: rows (pair_id, turns). Returns one row per pair with a preference."""
    pairs = (chosen.select("pair_id", F.col("turns").alias("a"))
             .join(rejected.select("pair_id", F.col("turns").alias("b")), "pair_id")
             .withColumn("k", common_prefix(F.col("a"), F.col("b"))))
    differ = (F.size("a") > F.col("k")) | (F.size("b") > F.col("k"))
    rest = lambda side: F.slice(side, F.col("k") + 1, F.greatest(F.size(side) - F.col("k"), F.lit(0)))
    return (pairs.where(differ)
            .select("pair_id", F.col("k").alias("n_prompt_turns"), render(F.slice("a", F.lit(1), F.col("k"))).alias("prompt"),
                    rest("a").alias("ta"), rest("b").alias("tb"))
            .select("pair_id", "n_prompt_turns", "prompt",
                    render(F.col("ta")).alias("chosen"), mask(F.col("ta")).alias("chosen_mask"),
                    render(F.col("tb")).alias("rejected"), mask(F.col("tb")).alias("rejected_mask")))


def reply_swaps(turns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Preference pairs out of plain conversations.

    The chosen side is a conversation up to its last assistant turn. The rejected side answers at that point with the
    last assistant turn of the neighbour conversation, whose id differs in the lowest bit, or with nothing where there is
    no neighbour. The prefix is not carried over: ``preference_pairs`` has to find it.
    """
    rows = conversations_to_rows(turns)
    last = F.array_max(F.transform("turns", lambda t, i: F.when(t["role"] == TRAINED_ROLE, i + 1)))
    cut = (rows.withColumn("last", last).where(F.col("last").isNotNull())
           .select("conv_id", F.slice("turns", F.lit(1), F.col("last")).alias("turns"), "last"))
    replies = cut.select((F.col("conv_id").bitwiseXOR(F.lit(1).cast("bigint"))).alias("conv_id"),
                         F.get("turns", F.col("last") - 1)["text"].alias("reply"))
    chosen = cut.select(F.col("conv_id").alias("pair_id"), "turns")
    swapped = F.concat(F.slice("turns", F.lit(1), F.col("last") - 1), F.array(
        F.struct(F.lit(TRAINED_ROLE).alias("role"), F.coalesce(F.col("reply"), F.lit("")).alias("text"))))
    rejected = (cut.join(replies, "conv_id", "left")
                .select(F.col("conv_id").alias("pair_id"), swapped.alias("turns")))
    return chosen, rejected


def mask_text(column: str) -> Column:
    """A mask as text: start:stop:1 or 0, comma-joined."""
    return F.array_join(F.transform(column, lambda s: F.concat_ws(
        ":", s["start"].cast("string"), s["stop"].cast("string"), s["trained"].cast("int").cast("string"))), ",")
