"""Quality rules kept as a bitmask ledger.

``ledger`` measures each document once and stores one failure bit per rule; ``apply_policy`` turns a named, versioned set
of rules into a verdict without looking at the text again; ``ablation`` tells for each rule how many documents only it
rejects. DataFrame functions only, no shuffle but the one of the ablation's counts.

Defined cases: a null text has no words; an empty table gives an empty ledger; repeated rows and repeated ids are judged
one by one; other columns pass through untouched, also when they are named like a measurement (the ledger keeps its own
measurements in the struct ``measures`` and its bits in ``failed_rules``; a document column of one of these two names is
replaced).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clickmill.llm.common import SPACE, text_of, words_of

#: Words in a window whose repetition counts.
WINDOW = 3

#: Rule name -> failing condition over the measurements ``m``. The position in this dictionary is the rule's bit.
RULES = {
    "few_words": lambda m: m["n_words"] < 50,
    "repeated_words": lambda m: 100 * m["n_repeat_words"] > 50 * m["n_words"],
    "symbols": lambda m: 10 * m["n_symbols"] > m["n_words"],
    "duplicate_lines": lambda m: 10 * m["n_dup_lines"] > 3 * m["n_lines"],
    "upper_case": lambda m: 10 * m["n_upper"] > 4 * m["word_chars"],
    "exclamations": lambda m: 10 * m["n_exclamations"] > 2 * m["n_words"],
    "word_length": lambda m: (m["word_chars"] < 2 * m["n_words"]) | (m["word_chars"] > 14 * m["n_words"]),
    "digits": lambda m: 10 * m["n_digits"] > 4 * m["word_chars"],
}

#: Policy name -> rules it applies. A new policy gets a new name; old verdicts stay reproducible.
POLICIES = {
    "base-1": ["few_words", "repeated_words"],
    "web-1": list(RULES),
}
DEFAULT_POLICY = "web-1"


def rule_bit(rule: str) -> int:
    return 1 << list(RULES).index(rule)


def policy_mask(policy: str) -> int:
    return sum(rule_bit(rule) for rule in POLICIES[policy])


def _count(text: Column, kind: str) -> Column:
    """Characters of a text that are in a character class."""
    return (F.length(text) - F.length(F.regexp_replace(text, kind, ""))).cast("bigint")


def _repeat_words(words: Column, hashes: Column, distinct: Column) -> Column:
    """Words inside three-word windows that occur more than once.

    Windows are sorted by hash, so equal ones are neighbours; the positions of those are put back in text order and
    their covered words counted without counting overlaps twice.
    """
    ranked = F.array_sort(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))

    def positions(rows: Column) -> Column:
        same = lambda e, k: e["h"] == F.get(rows, k)["h"]
        found = F.filter(rows, lambda e, k: F.coalesce(same(e, k - 1), F.lit(False)) | F.coalesce(same(e, k + 1), F.lit(False)))
        return F.array_sort(F.transform(found, lambda e: e["i"]))

    def cover(acc: Column, start: Column) -> Column:
        stop = start + WINDOW
        return F.struct((acc["n"] + stop - F.greatest(start, acc["stop"])).alias("n"), stop.alias("stop"))

    # the one-element transform binds the sorted array, so that it is computed once
    covered = F.flatten(F.transform(F.array(ranked), positions))
    zero = F.struct(F.lit(0).alias("n"), F.lit(0).alias("stop"))
    total = F.aggregate(covered, zero, cover, lambda acc: acc["n"])
    return F.when(F.size(hashes) == distinct, F.lit(0)).otherwise(total).cast("bigint")


def measure(docs: DataFrame, text: str = "text") -> DataFrame:
    """Adds the struct ``measures``."""
    spots = F.sequence(F.lit(0), F.size("__words") - WINDOW)
    hashes = F.transform(spots, lambda i: F.xxhash64(*[F.get(F.col("__words"), i + k) for k in range(WINDOW)]))
    none = F.array().cast("array<bigint>")
    lines = F.filter(F.split("__text", "\n"), lambda line: F.length(F.regexp_replace(line, SPACE + "+", "")) > 0)
    staged = (docs.withColumn("__text", text_of(text))
              .withColumn("__words", words_of(F.col("__text")))
              .withColumn("__lines", lines)
              .withColumn("__hashes", F.when(F.size("__words") >= WINDOW, hashes).otherwise(none))
              .withColumn("__distinct", F.size(F.array_distinct("__hashes"))))
    body = F.col("__text")
    measures = F.struct(
        F.size("__words").cast("bigint").alias("n_words"),
        F.length(F.array_join("__words", "")).cast("bigint").alias("word_chars"),
        _count(body, r"[#*$%&|<>]").alias("n_symbols"),
        (F.size("__lines") - F.size(F.array_distinct("__lines"))).cast("bigint").alias("n_dup_lines"),
        _repeat_words(F.col("__words"), F.col("__hashes"), F.col("__distinct")).alias("n_repeat_words"),
        F.size("__lines").cast("bigint").alias("n_lines"),
        _count(body, r"\p{Lu}").alias("n_upper"),
        _count(body, "!").alias("n_exclamations"),
        _count(body, "[0-9]").alias("n_digits"))
    return staged.withColumn("measures", measures).drop("__text", "__words", "__lines", "__hashes", "__distinct")


def ledger(docs: DataFrame, text: str = "text") -> DataFrame:
    """The documents with ``measures`` and ``failed_rules``, a bigint with one bit per rule."""
    bits = F.lit(0).cast("bigint")
    for rule, fails in RULES.items():
        bits = bits.bitwiseOR(F.when(fails(F.col("measures")), F.lit(rule_bit(rule))).otherwise(F.lit(0)).cast("bigint"))
    return measure(docs, text).withColumn("failed_rules", bits)


def apply_policy(ledgered: DataFrame, policy: str = DEFAULT_POLICY, name: str = "kept") -> DataFrame:
    """Adds the verdict of a policy: true where none of its rules failed."""
    return ledgered.withColumn(name, F.col("failed_rules").bitwiseAND(F.lit(policy_mask(policy)).cast("bigint")) == 0)


def ablation(ledgered: DataFrame, policy: str = DEFAULT_POLICY) -> DataFrame:
    """Per rule of a policy: documents it fails, documents only it fails, and documents kept without it.

    Documents are first counted per bit pattern, at most two to the number of rules, and only these counts are expanded.
    """
    mask = policy_mask(policy)
    patterns = (ledgered.groupBy(F.col("failed_rules").bitwiseAND(F.lit(mask).cast("bigint")).alias("bits"))
                .agg(F.count(F.lit(1)).alias("n")))
    rules = F.array(*[F.struct(F.lit(rule).alias("rule"), F.lit(rule_bit(rule)).cast("bigint").alias("bit"))
                      for rule in POLICIES[policy]])
    rows = patterns.select("bits", "n", F.explode(rules).alias("r"))
    fails = F.col("bits").bitwiseAND(F.col("r.bit")) != 0
    rest = F.col("bits").bitwiseAND(F.bitwise_not(F.col("r.bit")))
    return rows.groupBy(F.col("r.rule").alias("rule")).agg(
        F.sum(F.when(fails, F.col("n")).otherwise(0)).alias("n_failed"),
        F.sum(F.when(fails & (rest == 0), F.col("n")).otherwise(0)).alias("n_failed_alone"),
        F.sum(F.when(rest == 0, F.col("n")).otherwise(0)).alias("n_kept_without"))


def quality_digest(docs: DataFrame) -> DataFrame:
    """One row per document: base measurements and the verdicts."""
    judged = apply_policy(apply_policy(ledger(docs), "base-1", "__base"), DEFAULT_POLICY, "kept")
    return judged.select("doc_id", *[F.col(f"measures.{m}").alias(m) for m in (
        "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")],
        (~F.col("__base")).alias("base_failed"), "kept", "failed_rules")
