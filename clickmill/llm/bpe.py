"""Byte-level BPE encoding and decoding.

Encoding is one narrow pipeline without a shuffle. A task cuts its texts into pretokens, gives each distinct one a number,
folds the ranked merges over the byte arrays of the pretokens that are new to it, and puts the ids back into the documents.
The fold works on all new pretokens of a batch at once: the state is a matrix of ids and the ranks of neighbour pairs; a
step merges in every pretoken the leftmost pair of the lowest rank, and ranks come from a literal map (pair of ids -> rank).

``fold_all`` is the same fold in Spark's higher-order functions. It gives the same ids (a test holds both against each
other and against the public library), but each of its steps is interpreted, at about a hundred times the cost, which is
beyond the CPU budget of a whole corpus; figures are in the README. ``encode(..., engine="functions")`` uses it.

The numbering starts anew when a task has met ``MAX_PRETOKENS`` of them or ``MAX_PRETOKEN_CHARS`` of their characters, so memory
is bounded for any input; results do not depend on it. Pretokens longer than ``LONG_BYTES`` bytes, for which a fold over arrays would take quadratic time, are
merged with a heap, by the same rule. A lost executor repeats its tasks; nothing is kept between tasks.

Decoding looks up the bytes of each id and concatenates them.

Defined cases: a null or empty text has no ids and decodes to no bytes; an empty table stays empty; repeated rows are
encoded one by one; other columns pass through (a column called like an output is replaced).
"""

from __future__ import annotations

import base64
import heapq
import json
import re
import sys
import unicodedata
from collections.abc import Iterator
from functools import lru_cache
from itertools import islice

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

MAX_PRETOKENS = 200_000
MAX_PRETOKEN_CHARS = 8 << 20
BATCH_BYTES = 2 << 20
LONG_BYTES = 400
#: Buckets of the literal map; a look-up scans one bucket.
BUCKETS = 65_536
NO_RANK = 2**31 - 1


def load_ranks(path: str) -> list[bytes]:
    """The pieces of a rank file in the order of their ids. The file is small and read by the driver."""
    with open(path, "rb") as lines:
        pairs = [line.split() for line in lines if line.strip()]
    pieces = [b""] * len(pairs)
    for piece, rank in pairs:
        pieces[int(rank)] = base64.b64decode(piece)
    return pieces


@lru_cache(maxsize=None)
def _other_numbers() -> frozenset[str]:
    """Numbers that are no decimal digits."""
    return frozenset(c for c in map(chr, range(sys.maxunicode + 1)) if unicodedata.category(c) in ("Nl", "No"))


@lru_cache(maxsize=None)
def pretoken_pattern(other_numbers: bool = True) -> re.Pattern:
    """The published split pattern in terms of the standard library's ``re``.

    ``re`` has no general categories, so letters are the word characters that are neither numbers nor the underscore,
    and numbers are the decimal digits plus the letter-like and other numbers, listed from the character database. That
    long list slows every match, so texts without such characters are cut by the pattern without it.
    """
    more = "".join(map(re.escape, sorted(_other_numbers()))) if other_numbers else ""
    space = "\\t-\\r \\x85\\xa0\\u1680\\u2000-\\u200a\\u2028\\u2029\\u202f\\u205f\\u3000"
    letter, number, other = rf"[^\W\d_{more}]", rf"[\d{more}]", rf"(?:[^\w{space}{more}]|_)"
    return re.compile(rf"'s|'t|'re|'ve|'m|'ll|'d| ?{letter}+| ?{number}+| ?{other}+|[{space}]+(?![^{space}])|[{space}]+")


def pretokens(text: str) -> list[str]:
    return pretoken_pattern(not (text.isascii() or _other_numbers().isdisjoint(text))).findall(text)


def pair_ranks(pieces: list[bytes]) -> dict[tuple[int, int], int]:
    """Every pair of ids whose joined bytes are a piece, with that piece's rank."""
    ids = {piece: i for i, piece in enumerate(pieces)}
    return {(ids[p[:k]], ids[p[k:]]): i for p, i in ids.items() for k in range(1, len(p))
            if p[:k] in ids and p[k:] in ids}


@lru_cache(maxsize=2)
def _rank_literal(path: str) -> tuple[str, str]:
    """As JSON, the pair map in buckets of keys (left * 65536 + right) and ranks, and the ids of the 256 bytes."""
    pieces = load_ranks(path)
    buckets: list[dict] = [{"k": [], "v": []} for _ in range(BUCKETS)]
    for (left, right), rank in pair_ranks(pieces).items():
        bucket = buckets[(left * 31_337 + right) % BUCKETS]
        bucket["k"].append(left * 65_536 + right)
        bucket["v"].append(rank)
    ids = {piece: i for i, piece in enumerate(pieces)}
    return json.dumps(buckets, separators=(",", ":")), json.dumps([ids[bytes([b])] for b in range(256)])


def merge_fold(pretoken: Column, table: Column, byte_ids: Column) -> Column:
    """Ids of one pretoken, by folding the ranked merges over its bytes."""
    none = F.array().cast("array<int>")

    def rank(left: Column, right: Column) -> Column:
        bucket = F.get(table, ((left.cast("bigint") * 31_337 + right) % BUCKETS).cast("int"))
        place = F.array_position(bucket["k"], left.cast("bigint") * 65_536 + right).cast("int")
        return F.coalesce(F.get(bucket["v"], place - 1), F.lit(NO_RANK))

    one_per_byte = F.split(F.decode(F.encode(pretoken, "UTF-8"), "ISO-8859-1"), "")
    ids = F.transform(one_per_byte, lambda c: F.get(byte_ids, F.ascii(c)))

    def start(parts: Column) -> Column:
        ranks = F.transform(F.slice(parts, F.lit(2), F.size(parts)), lambda right, i: rank(F.get(parts, i), right))
        return F.struct(parts.alias("ids"), ranks.alias("ranks"))

    def merge(state: Column, pick: Column) -> Column:
        """``pick``: the lowest rank and the one-based place of the left part of its pair."""
        parts, ranks, best, at = state["ids"], state["ranks"], pick["best"], pick["at"]
        merged = F.concat(F.slice(parts, F.lit(1), at - 1), F.array(best), F.slice(parts, at + 2, F.size(parts)))
        before = F.when(at > 1, F.array(rank(F.get(parts, at - 2), best))).otherwise(none)
        after = F.when(at < F.size(ranks), F.array(rank(best, F.get(parts, at + 1)))).otherwise(none)
        around = F.concat(F.slice(ranks, F.lit(1), F.greatest(at - 2, F.lit(0))), before, after,
                          F.slice(ranks, at + 2, F.size(ranks)))
        return F.struct(merged.alias("ids"), around.alias("ranks"))

    def bound(value: Column, use) -> Column:
        """``use(value)`` with the value computed once: Spark has no let, a one-element transform does it."""
        return F.get(F.transform(F.array(value), use), 0)

    def step(state: Column, _: Column) -> Column:
        best = F.coalesce(F.array_min(state["ranks"]), F.lit(NO_RANK))
        picked = lambda b: F.struct(b.alias("best"), F.array_position(state["ranks"], b).cast("int").alias("at"))
        return bound(best, lambda b: F.when(b == NO_RANK, state).otherwise(bound(picked(b), lambda p: merge(state, p))))

    return bound(ids, lambda parts: F.aggregate(parts, start(parts), step, lambda state: state["ids"]))


def fold_all(pretokens: Column, path: str) -> Column:
    """Ids of an array of pretokens. The literals are parsed while Spark optimises the plan, and bound once."""
    pair_json, byte_json = _rank_literal(path)
    tables = F.struct(F.from_json(F.lit(pair_json), "array<struct<k:array<bigint>,v:array<int>>>").alias("pairs"),
                      F.from_json(F.lit(byte_json), "array<int>").alias("bytes"))
    return F.get(F.transform(F.array(tables), lambda t: F.transform(
        pretokens, lambda w: merge_fold(w, t["pairs"], t["bytes"]))), 0)


def merge_long(data: bytes, ids: dict[bytes, int]) -> list[int]:
    """The same merges with a heap, for a pretoken of any length."""
    n = len(data)
    parts: list[bytes | None] = [data[i:i + 1] for i in range(n)]
    after, before = list(range(1, n + 1)), list(range(-1, n - 1))
    heap: list[tuple[int, int, bytes]] = []

    def offer(i: int) -> None:
        j = after[i]
        if j < n and (rank := ids.get(joined := parts[i] + parts[j])) is not None:
            heapq.heappush(heap, (rank, i, joined))

    for i in range(n - 1):
        offer(i)
    while heap:
        _, i, joined = heapq.heappop(heap)
        if parts[i] is None or (j := after[i]) >= n or parts[i] + parts[j] != joined:
            continue
        parts[i], parts[j], after[i] = joined, None, after[j]
        if after[i] < n:
            before[after[i]] = i
        offer(i)
        if before[i] >= 0:
            offer(before[i])
    return [ids[p] for p in parts if p is not None]


class PairTable:
    """The literal map as two arrays with open addressing, for look-ups of whole arrays of pairs."""

    def __init__(self, pairs: dict[tuple[int, int], int]) -> None:
        self.bits = max(4, (4 * len(pairs)).bit_length())
        self.keys = np.full(1 << self.bits, -1, np.int64)
        self.ranks = np.full(1 << self.bits, NO_RANK, np.int32)
        keys = np.array([left << 32 | right for left, right in pairs], np.int64)
        ranks, at = np.fromiter(pairs.values(), np.int32, len(pairs)), self._slot(keys)
        while len(keys):
            free = np.flatnonzero(self.keys[at] < 0)
            _, first = np.unique(at[free], return_index=True)
            put = free[first]
            self.keys[at[put]], self.ranks[at[put]] = keys[put], ranks[put]
            left = np.setdiff1d(np.arange(len(keys)), put, assume_unique=True)
            keys, ranks, at = keys[left], ranks[left], (at[left] + 1) & (len(self.keys) - 1)

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        mixed = keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
        return (mixed >> np.uint64(64 - self.bits)).astype(np.int64)

    def get(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        keys = left.astype(np.int64) << 32 | right
        at = self._slot(keys)
        found, out = self.keys[at], np.full(len(keys), NO_RANK, np.int32)
        open_ = np.arange(len(keys))
        while len(open_):
            hit = found == keys[open_]
            out[open_[hit]] = self.ranks[at[hit]]
            go = ~hit & (found >= 0)
            open_, at = open_[go], (at[go] + 1) & (len(self.keys) - 1)
            found = self.keys[at]
        return out


def fold_matrix(words: list[bytes], byte_ids: np.ndarray, table: PairTable) -> list[np.ndarray]:
    """Ids of each word. Words of similar length share a matrix, so that it has little padding."""
    out: list[np.ndarray] = [np.zeros(0, np.int32)] * len(words)
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    order = np.argsort(lengths, kind="stable")
    for low in range(0, len(order), 8192):
        rows = order[low:low + 8192]
        rows = rows[lengths[rows] > 0]
        if not len(rows):
            continue
        size, width = lengths[rows], int(lengths[rows[-1]])
        live = np.arange(width) < size[:, None]
        ids = np.full((len(rows), width), -1, np.int32)
        ids[live] = byte_ids[np.frombuffer(b"".join([words[i] for i in rows]), np.uint8)]
        ranks = np.full((len(rows), width), NO_RANK, np.int32)
        both = live[:, 1:]
        ranks[:, :-1][both] = table.get(ids[:, :-1][both], ids[:, 1:][both])
        columns = np.arange(width)
        while len(rows):
            at = ranks.argmin(1)
            best = ranks[np.arange(len(rows)), at]
            done = best == NO_RANK
            if done.any():
                for r, parts, n in zip(rows[done].tolist(), ids[done], size[done].tolist()):
                    out[r] = parts[:n]
                go = ~done
                rows, ids, ranks, size, at, best = rows[go], ids[go], ranks[go], size[go], at[go], best[go]
                if not len(rows):
                    break
            each = np.arange(len(rows))
            take = np.minimum(columns + (columns > at[:, None]), width - 1)
            ids, ranks = np.take_along_axis(ids, take, 1), np.take_along_axis(ranks, take, 1)
            ids[each, at] = best
            size = size - 1
            ranks[each, np.minimum(size, width - 1)] = NO_RANK
            ranks[each, np.maximum(size - 1, 0)] = NO_RANK
            right = np.flatnonzero(at + 1 < size)
            ranks[right, at[right]] = table.get(ids[right, at[right]], ids[right, at[right] + 1])
            left = np.flatnonzero(at > 0)
            ranks[left, at[left] - 1] = table.get(ids[left, at[left] - 1], ids[left, at[left]])
    return out


class _Numbers(dict):
    """Numbers in the order of first appearance."""

    def __missing__(self, key: str) -> int:
        self[key] = number = len(self)
        return number


def _gather(refs: np.ndarray, starts: np.ndarray, ids: np.ndarray) -> bytes:
    """Ids of the pretokens ``refs``, packed."""
    lengths = starts[refs + 1] - starts[refs]
    ends = np.cumsum(lengths)
    take = np.arange(int(ends[-1]) if len(ends) else 0) + np.repeat(starts[refs] - (ends - lengths), lengths)
    return ids[take].astype("<u4").tobytes()


@lru_cache(maxsize=1)
def _tables(pieces: tuple[bytes, ...]) -> tuple[dict[bytes, int], PairTable, np.ndarray]:
    """Look-up tables of a vocabulary, made once per worker process."""
    by_bytes = {piece: i for i, piece in enumerate(pieces)}
    return by_bytes, PairTable(pair_ranks(list(pieces))), np.array([by_bytes[bytes([b])] for b in range(256)], np.int32)


def _encoder(pieces: tuple[bytes, ...]):
    """The whole encoding as a function over the texts of a task."""
    def run(batches: Iterator[pd.Series]) -> Iterator[list[bytes]]:
        by_bytes, table, byte_ids = _tables(pieces)
        seen, ids, starts, chars = _Numbers(), np.zeros(0, np.int32), np.zeros(1, np.int64), 0
        for batch in batches:
            if len(seen) > MAX_PRETOKENS or chars > MAX_PRETOKEN_CHARS:
                seen, ids, starts, chars = _Numbers(), np.zeros(0, np.int32), np.zeros(1, np.int64), 0
            known = len(seen)
            refs = [np.array(list(map(seen.__getitem__, pretokens(text))), np.int32) for text in batch]
            new = [w.encode() for w in islice(seen, known, None)]
            chars += sum(map(len, new))
            parts = fold_matrix([w if len(w) <= LONG_BYTES else b"" for w in new], byte_ids, table)
            for k, w in enumerate(new):
                if len(w) > LONG_BYTES:
                    parts[k] = np.array(merge_long(w, by_bytes), np.int32)
            sizes = np.fromiter(map(len, parts), np.int64, len(parts))
            ids, starts = np.concatenate([ids, *parts]), np.concatenate([starts, starts[-1] + np.cumsum(sizes)])
            yield [_gather(r, starts, ids) for r in refs]
    return run


def _spell(pieces: tuple[bytes, ...], ids: bytes | None) -> bytes:
    """The bytes of packed ids."""
    return b"".join(map(pieces.__getitem__, np.frombuffer(ids or b"", "<u4").tolist()))


def _encode_by_functions(docs: DataFrame, path: str, text: str) -> DataFrame:
    """The fold in higher-order functions, per document over its distinct pretokens."""
    @F.pandas_udf("struct<words:array<string>,refs:array<int>>")
    def cut(texts: pd.Series) -> pd.DataFrame:
        rows = []
        for t in texts:
            seen = _Numbers()
            refs = [seen[w] for w in pretokens(t)]
            rows.append((list(seen), refs))
        return pd.DataFrame(rows, columns=["words", "refs"])

    def packed(i: Column) -> Column:
        return F.concat(*[F.lpad(F.hex(F.shiftright(i, shift).bitwiseAND(255)), 2, "0") for shift in (0, 8, 16, 24)])

    parts = docs.withColumn("__cut", cut(F.coalesce(F.col(text).cast("string"), F.lit(""))))
    folded = parts.withColumn("__ids", fold_all(F.col("__cut.words"), path))
    all_ids = F.flatten(F.transform("__cut.refs", lambda r: F.get("__ids", r)))
    return folded.withColumn("ids", F.unhex(F.array_join(F.transform(all_ids, packed), ""))).drop("__cut", "__ids")


def encode(docs: DataFrame, path: str, text: str = "text", engine: str = "arrays") -> DataFrame:
    """Adds ``n_tokens`` and ``ids``, the ids as little-endian unsigned 32-bit integers."""
    if engine == "functions":
        done = _encode_by_functions(docs, path, text)
    else:
        run = _encoder(tuple(load_ranks(path)))

        @F.pandas_udf("binary")
        def ids_of(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
            for ids in run(batches):
                yield pd.Series(ids)

        done = docs.withColumn("ids", ids_of(F.coalesce(F.col(text).cast("string"), F.lit(""))))
    return done.withColumn("n_tokens", (F.octet_length("ids") / 4).cast("bigint"))


def decode(encoded: DataFrame, path: str, ids: str = "ids") -> DataFrame:
    """Adds ``decoded``, the bytes of the ids' pieces one after the other; null ids decode to no bytes."""
    pieces = tuple(load_ranks(path))

    @F.pandas_udf("binary")
    def join(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in batches:
            yield pd.Series([_spell(pieces, ids) for ids in batch])

    return encoded.withColumn("decoded", join(F.col(ids)))


def encode_and_decode(docs: DataFrame, path: str, text: str = "text") -> DataFrame:
    """Adds ``ids``, ``n_tokens`` and ``decoded`` in one pass, with one Python process a core instead of two."""
    pieces = tuple(load_ranks(path))
    run = _encoder(pieces)

    @F.pandas_udf("ids binary, decoded binary")
    def both(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for ids in run(batches):
            yield pd.DataFrame({"ids": ids, "decoded": [_spell(pieces, packed) for packed in ids]})

    docs.sparkSession.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))
    done = docs.withColumn("__both", both(F.coalesce(F.col(text).cast("string"), F.lit(""))))
    return done.withColumns({"ids": F.col("__both.ids"), "decoded": F.col("__both.decoded")}).drop("__both").withColumn(
        "n_tokens", (F.octet_length("ids") / 4).cast("bigint"))


def token_digest(docs: DataFrame, path: str) -> DataFrame:
    """Per document: token count, hash of the ids and hash of the decoded bytes."""
    both = encode_and_decode(docs.select("doc_id", "text"), path)
    return both.select("doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"),
                       F.sha2("decoded", 256).alias("decoded_sha256"))
