"""Token counts of every prefix of a text, by dynamic programming over prefixes.

Of the encoding of a prefix only the last token is kept. The last token of the first ``i`` bytes is the one vocabulary entry
that ends there and fits behind the last token of the bytes before it; its count is one more than theirs. Two tokens fit
when no merge ever joins bytes across their border, which is settled by undoing their merges from the latest on. So one pass
over a pretoken counts the tokens of all its prefixes, and one pass over a text those of all prefixes of the text:

* a pretoken cut in the middle stays one pretoken, but for ``'re``, ``'ve`` and ``'ll``, whose first two characters are two;
* white space before a word is one run as long as the word has not begun;
* a special string is ordinary text until its last character.

``prefix_counts`` stores one number per character, so that how long a text may get for a limit, what a cut text costs and
how far a budget reaches are look-ups (``tokens_in``, ``longest_prefix``, ``truncate``, ``fill_budget``); nothing is encoded
again. Counts do not always grow with the prefix: a longer one may take fewer tokens.

Each task works alone, without a shuffle. Distinct pretokens are solved once per worker process and forgotten when they fill
``CACHE_BYTES``; results do not depend on it. Batches are cut by bytes and long texts are taken in pieces.

The file is one of the public ``tokenizers`` library: byte-level BPE, no normaliser, no space in front, added tokens matched
plainly. Any other kind is refused. The driver reads it and ships its content.

Defined cases: a null or empty text has the single count 0; repeated rows are counted one by one; an empty table stays empty;
other columns pass through (a column called like the output is replaced).
"""

from __future__ import annotations

import json
import re
import unicodedata
from collections.abc import Iterator, Sequence
from functools import lru_cache
from itertools import chain, islice

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from tokenizers.pre_tokenizers import ByteLevel

from clickmill.llm.bpe import pretokens
from clickmill.llm.common import materialize, text_of

#: Distinct pretokens that a worker process remembers, in bytes, and pairs of tokens whose fit it remembers.
CACHE_BYTES = 64 << 20
MOST_PAIRS = 400_000
#: Characters of a text that are cut into pretokens at once.
PIECE = 1 << 19
BATCH_BYTES = 2 << 20
LIMIT = 512

SPACE = "\\t-\\r \\x85\\xa0\\u1680\\u2000-\\u200a\\u2028\\u2029\\u202f\\u205f\\u3000"
_RUN_BEFORE_WORD = re.compile(f"[{SPACE}]{{2,}}(?=[^{SPACE}])")
_SAFE_CUT = re.compile(f"(?<=[^{SPACE}])(?=[{SPACE}])")
#: The contractions that the pattern takes as one pretoken and that are two when their last letter is cut.
CUT_CONTRACTIONS = ("'re", "'ve", "'ll")
NEVER = 1 << 62


@lru_cache(maxsize=None)
def _newer(char: str) -> bool:
    """Whether this Python's database does not know a character; the library's may."""
    return unicodedata.category(char) == "Cn"


def split_pretokens(text: str) -> list[str]:
    """Pretokens of a text; one with characters newer than this Python is cut by the library itself."""
    if text.isascii() or not any(map(_newer, set(text))):
        return pretokens(text)
    cut = ByteLevel(add_prefix_space=False).pre_tokenize_str(text)
    return [text[low:high] for _, (low, high) in cut]


def byte_letters() -> dict[str, int]:
    """The printable letter that stands for each byte in the file: itself if printable, else the next one from 256 on."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    letters = {chr(b): b for b in plain}
    others = [b for b in range(256) if b not in set(plain)]
    return letters | {chr(256 + k): b for k, b in enumerate(others)}


class Merges:
    """The vocabulary with, per token, the merge that makes it."""

    def __init__(self, content: bytes) -> None:
        spec = json.loads(content)
        model, cut = spec["model"], spec["pre_tokenizer"] or {}
        odd = [name for name in ("dropout", "continuing_subword_prefix", "end_of_word_suffix", "byte_fallback", "ignore_merges")
               if model.get(name)]
        if model["type"] != "BPE" or spec.get("normalizer") or odd or cut.get("type") != "ByteLevel" \
                or cut.get("add_prefix_space") or not cut.get("use_regex", True):
            raise ValueError("only plain byte-level BPE is supported")
        letters = byte_letters()
        added = spec["added_tokens"]
        names = [t["content"] for t in added]
        if any(t[flag] for t in added for flag in ("single_word", "lstrip", "rstrip")) \
                or any(a != b and a in b for a in names for b in names):
            raise ValueError("added tokens must be matched plainly and not contain each other")
        self.special = re.compile("|".join(map(re.escape, names))) if names else None
        to_bytes = lambda piece: bytes(map(letters.__getitem__, piece))
        vocabulary = {piece: i for piece, i in model["vocab"].items() if piece not in names}
        size = max(vocabulary.values()) + 1
        self.made, self.left, self.right = [-1] * size, [0] * size, [0] * size
        self.ranks: dict[int, int] = {}
        self.known: dict[int, bool] = {}
        for rank, pair in enumerate(model["merges"]):
            one, two = pair.split(" ") if isinstance(pair, str) else pair
            a, b, both = vocabulary[one], vocabulary[two], vocabulary[one + two]
            if self.made[both] >= 0:
                raise ValueError("two merges make the same token")
            self.made[both], self.left[both], self.right[both] = rank, a, b
            self.ranks[a << 32 | b] = rank
        # A token that its own bytes are never merged to cannot end a prefix.
        sound = [made < 0 for made in self.made]
        for both in sorted(vocabulary.values(), key=self.made.__getitem__):
            rank = self.made[both]
            if rank >= 0:
                a, b = self.left[both], self.right[both]
                sound[both] = sound[a] and sound[b] and self._fits(a, b, rank, rank - 1)
        self.ids = {data: i for piece, i in vocabulary.items() if sound[i] and (self.made[i] >= 0 or len(piece) == 1)
                    for data in [to_bytes(piece)]}
        if any(bytes([b]) not in self.ids for b in range(256)):
            raise ValueError("the vocabulary cannot spell every byte")
        # the longest token by its last three bytes, so that few starts are tried
        self.reach: dict[bytes, int] = {}
        for data in self.ids:
            self.reach[data[-3:]] = max(self.reach.get(data[-3:], 2), len(data))

    def _fits(self, a: int, b: int, until_a: int = NEVER, until_b: int = NEVER) -> bool:
        """Whether no merge joins ``a`` and ``b``, or what they were made of, across their border.

        ``until``: rank of the merge that ends a node. Of equal merges the left one comes first, so a node to the left ends
        before a merge of the same rank across the border, one to the right after it.
        """
        made, ranks = self.made, self.ranks
        while True:
            rank = ranks.get(a << 32 | b)
            if rank is not None and rank < until_a and rank <= until_b:
                return False
            if made[a] > made[b]:
                until_a, a = made[a], self.right[a]
            elif made[b] >= 0:
                until_b, b = made[b], self.left[b]
            else:
                return True

    def fits(self, a: int, b: int) -> bool:
        key = a << 32 | b
        answer = self.known.get(key)
        if answer is None:
            if len(self.known) >= MOST_PAIRS:
                self.known.clear()
            answer = self.known[key] = self._fits(a, b)
        return answer

    def prefix_tables(self, words: list[bytes]) -> Iterator[list[int]]:
        """Per pretoken, in sorted order, the number of tokens of its first 0, 1, 2 ... bytes.

        Neighbours in the order share prefixes, and what is known of a shared prefix is kept.
        """
        find, reach, fits = self.ids.get, self.reach.get, self.fits
        count, last, before = [0], [-1], b""
        for data in words:
            shared = 0
            for x, y in zip(before, data):
                if x != y:
                    break
                shared += 1
            del count[shared + 1:], last[shared + 1:]
            for end in range(shared + 1, len(data) + 1):
                start = end - reach(data[end - 3:end], 2) if end > 3 else 0
                if start < 0:
                    start = 0
                while (token := find(data[start:end])) is None or start and not fits(last[start], token):
                    start += 1
                count.append(count[start] + 1)
                last.append(token)
            yield count[:]
            before = data


class _Seen(dict):
    """Pretokens numbered in the order of their first appearance."""

    def __missing__(self, word: str) -> int:
        self[word] = number = len(self)
        return number


class PrefixCounter:
    """Counts over texts; remembers the tables of the pretokens it has met."""

    def __init__(self, content: bytes) -> None:
        self.merges = Merges(content)
        self._forget()

    def _forget(self) -> None:
        self.seen, self.solved, self.bytes = _Seen(), 0, 0
        self.values, self.starts = np.zeros(0, np.int32), np.zeros(1, np.int64)

    def _solve_new(self) -> None:
        """Tables of the pretokens numbered since the last call, sampled at the ends of characters."""
        new = [(word.encode("utf-8", "surrogatepass"), word) for word in islice(self.seen, self.solved, None)]
        parts: list[list[int]] = [[]] * len(new)
        order = sorted(range(len(new)), key=new.__getitem__)
        for at, table in zip(order, self.merges.prefix_tables([new[at][0] for at in order])):
            data, word = new[at]
            if word in CUT_CONTRACTIONS:
                table[2] = 2
            if len(data) != len(word):
                table = [n for k, n in enumerate(table) if k == len(data) or data[k] & 0xC0 != 0x80]
            parts[at] = table[1:]
            self.bytes += 5 * len(word) + 180
        if parts:
            sizes = np.fromiter(map(len, parts), np.int64, len(parts))
            flat = np.fromiter(chain.from_iterable(parts), np.int32, int(sizes.sum()))
            self.values = np.concatenate([self.values, flat])
            self.starts = np.concatenate([self.starts, self.starts[-1] + np.cumsum(sizes)])
            self.solved = len(self.seen)

    def _plan(self, text: str) -> tuple[np.ndarray, list[tuple[int, int, int]]]:
        """Numbers of the pretokens, and runs of white space before a word as (start, end, number of the run)."""
        number, refs, low = self.seen.__getitem__, [], 0
        while low < len(text):
            cut = _SAFE_CUT.search(text, low + PIECE) if len(text) - low > PIECE else None
            high = cut.start() if cut else len(text)
            refs.append(np.array(list(map(number, split_pretokens(text[low:high]))), np.int32))
            low = high
        runs = [(m.start(), m.end(), number(m.group())) for m in _RUN_BEFORE_WORD.finditer(text)]
        return np.concatenate(refs) if refs else np.zeros(0, np.int32), runs

    def _assemble(self, refs: np.ndarray, runs: list[tuple[int, int, int]]) -> np.ndarray:
        begin, end = self.starts[refs], self.starts[refs + 1]
        sizes = end - begin
        totals = self.values[end - 1]
        before = np.cumsum(totals) - totals
        stops = np.cumsum(sizes)
        out = np.zeros((int(stops[-1]) if len(stops) else 0) + 1, np.int32)
        take = np.arange(len(out) - 1) + np.repeat(begin - (stops - sizes), sizes)
        out[1:] = self.values[take] + np.repeat(before, sizes)
        for start, stop, run in runs:
            out[stop] = out[start] + self.values[self.starts[run + 1] - 1]
        return out

    def counts(self, texts: list[str]) -> list[np.ndarray]:
        """Per text, the number of tokens of its first 0, 1, 2 ... characters."""
        if self.bytes > CACHE_BYTES:
            self._forget()
        plans = []
        for text in texts:
            pieces, low = [], 0
            for found in self.merges.special.finditer(text) if self.merges.special else ():
                pieces.append((low, found.start(), found.end(), *self._plan(text[low:found.end() - 1])))
                low = found.end()
            plans.append((pieces, low, *self._plan(text[low:])))
        self._solve_new()
        out = []
        for text, (pieces, low, refs, runs) in zip(texts, plans):
            whole, base = np.empty(len(text) + 1, np.int32), 0
            for start, special, stop, part, part_runs in pieces:
                whole[start:stop] = base + self._assemble(part, part_runs)
                base = whole[special] + 1
            whole[low:] = base + self._assemble(refs, runs)
            out.append(whole)
        return out


@lru_cache(maxsize=1)
def _counter(content: bytes) -> PrefixCounter:
    """One counter per worker process."""
    return PrefixCounter(content)


def prefix_counts(docs: DataFrame, path: str, text: str = "text", name: str = "prefix_counts") -> DataFrame:
    """Adds ``name``: element ``k`` is the number of tokens of the text's first ``k`` characters, from 0 to all of them."""
    with open(path, "rb") as file:
        content = file.read()
    Merges(content)  # refuse an unsuitable file before any task runs

    @F.arrow_udf("array<int>")
    def count(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        counter = _counter(content)
        for batch in batches:
            tables = counter.counts(batch.to_pylist())
            stops = np.cumsum([0, *map(len, tables)], dtype=np.int32)
            yield pa.ListArray.from_arrays(pa.array(stops), pa.array(np.concatenate(tables) if tables else np.zeros(0, np.int32)))

    return docs.withColumn(name, count(text_of(text)))


def n_tokens(counts: Column) -> Column:
    """Tokens of the whole text."""
    return F.element_at(counts, -1).cast("bigint")


def tokens_in(counts: Column, chars: Column | int) -> Column:
    """Tokens of the text cut after ``chars`` characters; a text that is shorter counts whole."""
    at = F.least(chars if isinstance(chars, Column) else F.lit(chars), F.size(counts) - 1)
    return F.get(counts, at.cast("int")).cast("bigint")


def longest_prefix(counts: Column, limit: Column | int) -> Column:
    """Characters of the longest prefix that has at most ``limit`` tokens; 0 for a negative limit."""
    limit = limit if isinstance(limit, Column) else F.lit(limit)
    from_end = F.array_position(F.reverse(F.transform(counts, lambda n: n <= limit)), True)
    scan = F.when(from_end > 0, F.size(counts) - from_end).otherwise(0)
    return F.when(F.element_at(counts, -1) <= limit, F.size(counts) - 1).otherwise(scan).cast("bigint")


def truncate(counted: DataFrame, limit: Column | int, text: str = "text", counts: str = "prefix_counts") -> DataFrame:
    """The rows with the text cut to its longest prefix of at most ``limit`` tokens, and the counts cut with it."""
    kept = longest_prefix(F.col(counts), limit).cast("int")
    return counted.withColumns({text: F.substring(F.col(text), F.lit(1), kept), counts: F.slice(F.col(counts), F.lit(1), kept + 1)})


def fill_budget(counted: DataFrame, budget: int, order: Sequence[Column], counts: str = "prefix_counts",
                name: str = "budget_chars") -> DataFrame:
    """Adds how many characters of each row a common budget of tokens pays for, rows taken in ``order``.

    Rows are paid whole until the budget is short; the row at the border gets the longest prefix that the rest pays for, those
    behind it nothing. ``order`` must be total. Rows are ranged by it and written once; tokens before a row follow from one sum
    per range and a running sum inside the range.
    """
    placed = materialize(counted.repartitionByRange(*order).sortWithinPartitions(*order)
                         .withColumn("__range", F.spark_partition_id()).withColumn("__tokens", n_tokens(F.col(counts))), "budget")
    sums = placed.groupBy("__range").agg(F.sum("__tokens").alias("__sum"))  # one row per range
    earlier = Window.orderBy("__range").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sums.select("__range", F.coalesce(F.sum("__sum").over(earlier), F.lit(0)).alias("__offset"))
    inside = Window.partitionBy("__range").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    left = F.lit(budget).cast("bigint") - F.col("__offset") - F.coalesce(F.sum("__tokens").over(inside), F.lit(0))
    paid = placed.join(F.broadcast(offsets), "__range").withColumn("__left", left)
    return paid.withColumn(name, F.when(F.col("__left") > 0, longest_prefix(F.col(counts), F.col("__left")))
                           .otherwise(F.lit(0).cast("bigint"))).drop("__range", "__tokens", "__offset", "__left")


def token_count_digest(docs: DataFrame, path: str, limit: int = LIMIT) -> DataFrame:
    """Per document: bytes, tokens, whether it exceeds the limit and how many of its characters stay within it."""
    docs.sparkSession.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))
    counted = prefix_counts(docs.select("doc_id", "text"), path)
    tokens = n_tokens(F.col("prefix_counts"))
    return counted.select(
        "doc_id", F.octet_length(text_of()).cast("bigint").alias("n_bytes"), tokens.alias("n_tokens"),
        (tokens > limit).alias("over_limit"), longest_prefix(F.col("prefix_counts"), limit).alias("chars_within_limit"))
