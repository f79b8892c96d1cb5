"""Removal of byte strings that an earlier document holds, with a sparse suffix array.

A byte goes when a string of ``MATCH`` bytes that covers it also starts in a document of smaller id. Sorting every suffix of
the corpus would move each byte many times over, so only anchors are sorted: of the ``MATCH - GRAM + 1`` grams inside a
window the one of least hash is the window's anchor. Equal windows have equal anchors, so nothing is missed, and about one
position in fourteen is an anchor. The windows of one anchor lie in one context of at most 76 bytes.

1. Tasks find the anchors of their documents and send hashes of gram and context, with document and place, to ranges of
   the gram hash. Of equal contexts inside a task only the first document's travel; the others are settled at once.
2. In a range, anchors of equal gram meet. Equal contexts settle all documents but the first. Only where a gram has different
   contexts, the first document of each context has to be compared byte by byte, and its document is asked for the context.
3. Documents answer with contexts. A gram with very many contexts is cut into its single windows, which meet by their own hash.
4. Contexts of equal gram are sorted twice by deep-shallow sorting: the bytes from the anchor on, and the bytes before
   it backwards. From the shared prefixes of neighbours follow classes of equal prefixes at any depth, and two windows are
   equal when their left and right parts are in the same classes.
5. Documents collect the settled windows, merge them and drop the bytes.

Every step hands over a table in the shared folder. Work is cut by bytes: the number of ranges and document parts grows with
the corpus, so a task holds some megabytes. One gram with different contexts in nearly all documents sends
one row of about twenty bytes per different context to one task; copies add none.

Defined cases: null and empty texts have no bytes; matches never cross documents; a document is never its own source; rows of
equal id are no source for each other, also with different texts; a null id counts as the least id; an empty table gives
an empty result; other columns pass through (a column called like an output is replaced).
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clickmill.llm.common import materialize, text_of, total_text_bytes
from clickmill.llm.suffix_sort import deep_shallow

MATCH = 50
GRAM = 24
SPAN = MATCH - GRAM + 1
#: Window starts that are hashed at once, and text that a task gathers before it sends anchors.
BLOCK = 1 << 18
CHUNK = 2 << 20
#: Text per range of gram hashes and per part of the documents.
RANGE_BYTES = 2 << 20
#: Different contexts of one gram beyond which its windows travel one by one.
MANY = 4096
PLACE_BITS = 22

U64 = np.uint64
A, B, C = U64(0x9E3779B97F4A7C15), U64(0xC2B2AE3D27D4EB4F), U64(0x165667B19E3779F9)


def mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> U64(32))) * B
    x = (x ^ (x >> U64(29))) * C
    return x ^ (x >> U64(32))


class Prefixes:
    """Hashes of any substring of a block, from prefix sums of a polynomial modulo 2 to the 64."""

    BASE = 0xD6E8FEB86659FD93

    def __init__(self, n: int) -> None:
        inverse = pow(self.BASE, -1, 1 << 64)
        self.up, self.down = np.full(n, self.BASE, U64), np.full(n, inverse, U64)
        self.up[0] = self.down[0] = 1
        self.up, self.down = np.cumprod(self.up, dtype=U64), np.cumprod(self.down, dtype=U64)

    def hashes(self, data: np.ndarray, starts: np.ndarray, stops: np.ndarray) -> np.ndarray:
        sums = np.zeros(len(data) + 1, U64)
        np.cumsum((data.astype(U64) + U64(1)) * self.up[:len(data)], dtype=U64, out=sums[1:])
        return mix((sums[stops] - sums[starts]) * self.down[starts])


def gram_hashes(data: np.ndarray) -> np.ndarray:
    """Hash of the gram at every place of a block."""
    n = len(data) - GRAM + 1
    raw = data.tobytes()
    x = [np.ndarray((n,), "<u8", raw, offset=8 * k, strides=(1,)) for k in range(GRAM // 8)]
    h = x[0] * A
    h ^= h >> U64(32)
    h += x[1]
    h *= B
    h ^= h >> U64(29)
    h += x[2]
    h *= C
    h ^= h >> U64(32)
    return h


def block_anchors(data: np.ndarray, ends: np.ndarray, prefixes: Prefixes) -> tuple[np.ndarray, ...]:
    """(gram hash, context hash, first window, last window, anchor) of a block of texts that end at ``ends``."""
    h = gram_hashes(data)
    packed = (h >> U64(PLACE_BITS) << U64(PLACE_BITS)) | np.arange(len(h), dtype=U64)
    least, width = packed, 1
    while 2 * width <= SPAN:
        least = np.minimum(least[:-width], least[width:])
        width *= 2
    if width < SPAN:
        least = np.minimum(least[:width - SPAN], least[SPAN - width:])
    anchor = (least & U64((1 << PLACE_BITS) - 1)).astype(np.int64)
    inside = np.ones(len(anchor), bool)
    for end in ends.tolist():
        inside[max(0, end - MATCH + 1):end] = False
    at = np.flatnonzero(inside)
    if not len(at):
        empty = np.zeros(0, np.int64)
        return empty.astype(U64), empty.astype(U64), empty, empty, empty
    new = np.r_[True, (np.diff(at) != 1) | (np.diff(anchor[at]) != 0)]
    first = at[new]
    last = at[np.r_[np.flatnonzero(new)[1:] - 1, len(at) - 1]]
    place = anchor[first]
    context = prefixes.hashes(data, first, last + MATCH)
    shape = ((last - first) * 64 + (place - first)).astype(U64)
    return h[place] >> U64(16), mix(context ^ (shape * A)) >> U64(16), first, last, place


#: Fields of an anchor and their bytes. ``doc`` orders sources; a row is the pair of ``doc`` and ``tag``, a hash of its text.
ANCHOR = {"gram": 6, "context": 6, "doc": 8, "tag": 8, "start": 5, "span": 1, "left": 1}
WINDOWS = {"doc": 8, "tag": 8, "start": 5, "count": 2}
REQUEST = {"gram": 6, "doc": 8, "tag": 8, "start": 5, "span": 1, "left": 1, "many": 1}


def pack(rows: dict[str, np.ndarray], fields: dict[str, int], take: np.ndarray | slice = slice(None)) -> bytes:
    """Columns as byte planes one after the other; high planes of small numbers are zeros, which compress away."""
    parts = []
    for name, width in fields.items():
        column = np.ascontiguousarray(rows[name][take]).astype("<u8" if rows[name].dtype == U64 else "<i8")
        parts.append(np.ascontiguousarray(column.view(np.uint8).reshape(-1, 8)[:, :width].T).tobytes())
    return b"".join(parts)


def unpack(blobs: list[bytes], fields: dict[str, int]) -> dict[str, np.ndarray]:
    width = sum(fields.values())
    out: dict[str, list[np.ndarray]] = {name: [] for name in fields}
    for blob in blobs:
        planes, at = np.frombuffer(blob, np.uint8).reshape(width, -1), 0
        for name, w in fields.items():
            column = np.zeros((planes.shape[1], 8), np.uint8)
            column[:, :w] = planes[at:at + w].T
            out[name].append(column.view("<i8").ravel())
            at += w
    return {name: np.concatenate(parts) if parts else np.zeros(0, np.int64) for name, parts in out.items()}


def spark_hash(ids: np.ndarray) -> np.ndarray:
    """Spark's xxhash64 of a bigint column, so that tasks can name the part of a row."""
    p1, p2, p3 = U64(0x9E3779B185EBCA87), U64(0xC2B2AE3D27D4EB4F), U64(0x165667B19E3779F9)
    p4, p5 = U64(0x85EBCA77C2B2AE63), U64(0x27D4EB2F165667C5)
    turn = lambda x, r: (x << U64(r)) | (x >> U64(64 - r))
    h = np.full(len(ids), U64(42) + p5 + U64(8))
    h ^= turn(ids.astype(U64) * p2, 31) * p1
    h = turn(h, 27) * p1 + p4
    h = (h ^ (h >> U64(33))) * p2
    h = (h ^ (h >> U64(29))) * p3
    return (h ^ (h >> U64(32))).astype(np.int64)


def _by_part(rows: dict[str, np.ndarray], fields: dict[str, int], parts: int, kind: int) -> list[tuple[int, int, bytes]]:
    """Rows packed per document part."""
    if not len(rows["doc"]):
        return []
    part = np.mod(spark_hash(rows["doc"] ^ rows["tag"]), parts)
    order = np.argsort(part, kind="stable")
    edges = np.flatnonzero(np.r_[True, np.diff(part[order]) != 0, True])
    return [(int(part[order[low]]), kind, pack(rows, fields, order[low:high])) for low, high in zip(edges[:-1], edges[1:])]


def _frame(rows: list[tuple[int, int, bytes]]) -> pd.DataFrame:
    return pd.DataFrame(rows, columns=["part", "kind", "data"]).astype({"part": "int64", "kind": "int32"})


PACKED = "part bigint, kind int, data binary"
ANCHORS, SETTLED, ASKED, CONTEXTS = range(4)


def _classes(rows: dict[str, np.ndarray]) -> tuple[dict[str, np.ndarray], np.ndarray, np.ndarray]:
    """Anchors sorted by gram, context and document; the class number of each; the first document of each class."""
    order = np.lexsort((rows["start"], rows["tag"], rows["doc"], rows["context"], rows["gram"]))
    rows = {name: column[order] for name, column in rows.items()}
    new = np.r_[True, (np.diff(rows["gram"]) != 0) | (np.diff(rows["context"]) != 0)]
    return rows, np.cumsum(new) - 1, rows["doc"][new]


def _send_anchors(ranges: int, parts: int):
    """Step 1. Batches have (doc, tag, text)."""
    def flush(rows: list[dict[str, np.ndarray]]) -> pd.DataFrame:
        joined = {name: np.concatenate([r[name] for r in rows]) for name in ANCHOR}
        if not len(joined["doc"]):
            return _frame([])
        joined, group, first = _classes(joined)
        later = joined["doc"] > first[group]
        settled = {name: joined[name][later] for name in ("doc", "tag", "start")}
        settled["count"] = joined["span"][later] + 1
        out = _by_part(settled, WINDOWS, parts, SETTLED)
        sent = {name: column[~later] for name, column in joined.items()}
        cuts = np.searchsorted(sent["gram"], [(r << 48) // ranges for r in range(ranges + 1)])
        out += [(r, ANCHORS, pack(sent, ANCHOR, slice(low, high)))
                for r, (low, high) in enumerate(zip(cuts[:-1].tolist(), cuts[1:].tolist())) if low < high]
        return _frame(out)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        prefixes = Prefixes(BLOCK + 4 * MATCH)
        rows: list[dict[str, np.ndarray]] = []
        size, block, docs = 0, [], []

        def hash_block() -> None:
            """``docs`` has (doc, tag, offset of the block in the document, length) of the texts in ``block``."""
            if not docs:
                return
            data = np.frombuffer(b"".join(block), np.uint8)
            lengths = np.array([d[3] for d in docs], np.int64)
            ends = np.cumsum(lengths)
            gram, context, first, last, place = block_anchors(data, ends, prefixes)
            owner = np.searchsorted(ends, first, side="right")
            column = lambda k: np.array([d[k] for d in docs], np.int64)[owner]
            rows.append({"gram": gram.astype(np.int64), "context": context.astype(np.int64), "doc": column(0),
                         "tag": column(1), "start": column(2) + first - (ends - lengths)[owner], "span": last - first,
                         "left": place - first})
            block.clear()
            docs.clear()

        for batch in batches:
            for doc, tag, text in zip(batch["doc"].tolist(), batch["tag"].tolist(), batch["text"]):
                data = text.encode("utf-8", "surrogatepass")
                for low in range(0, len(data) - MATCH + 1, BLOCK):
                    piece = data[low:low + BLOCK + MATCH - 1]
                    if docs and sum(d[3] for d in docs[-1:]) + sum(map(len, block)) + len(piece) > BLOCK:
                        hash_block()
                    block.append(piece)
                    docs.append((doc, tag, low, len(piece)))
                    size += len(piece)
                if size > CHUNK:
                    hash_block()
                    yield flush(rows)
                    rows, size = [], 0
        hash_block()
        if rows:
            yield flush(rows)
    return run


def _meet(parts: int):
    """Step 2, one range of gram hashes."""
    def run(group: pd.DataFrame) -> pd.DataFrame:
        rows, own, first = _classes(unpack(list(group["data"]), ANCHOR))
        later = rows["doc"] > first[own]
        settled = {name: rows[name][later] for name in ("doc", "tag", "start")} | {"count": rows["span"][later] + 1}
        gram = rows["gram"][np.flatnonzero(np.r_[True, np.diff(own) != 0])]
        start = np.flatnonzero(np.r_[True, np.diff(gram) != 0])
        of = np.cumsum(np.r_[True, np.diff(gram) != 0]) - 1
        many = np.diff(np.r_[start, len(gram)])
        differ = np.maximum.reduceat(first, start) != np.minimum.reduceat(first, start)
        ask = ~later & differ[of][own]
        asked = {name: rows[name][ask] for name in ("gram", "doc", "tag", "start", "span", "left")}
        asked["many"] = (many[of][own][ask] > MANY).astype(np.int64)
        return _frame(_by_part(settled, WINDOWS, parts, SETTLED) + _by_part(asked, REQUEST, parts, ASKED))
    return run


def _texts(docs: pd.DataFrame) -> dict[tuple[int, int], bytes]:
    return {(d, t): x.encode("utf-8", "surrogatepass") for d, t, x in zip(docs["doc"].tolist(), docs["tag"].tolist(), docs["text"])}


def _pack_contexts(asked: dict[str, np.ndarray], data: np.ndarray, starts: np.ndarray, take: np.ndarray) -> bytes:
    sizes = (asked["span"] + MATCH)[take]
    ends = np.cumsum(sizes)
    at = np.arange(int(ends[-1])) + np.repeat(starts[take] - (ends - sizes), sizes)
    head = pack(asked, REQUEST, take)
    return len(take).to_bytes(8, "little") + head + data[at].tobytes()


def _send_contexts(ranges: int, parts: int):
    """Step 3, one part of the documents with what was asked of it."""
    def run(docs: pd.DataFrame, wanted: pd.DataFrame) -> pd.DataFrame:
        asked = unpack(list(wanted["data"]), REQUEST)
        if not len(asked["doc"]):
            return _frame([])
        texts = _texts(docs)
        keys = list(dict.fromkeys(zip(asked["doc"].tolist(), asked["tag"].tolist())))
        base, offset = {}, 0
        for key in keys:
            base[key] = offset
            offset += len(texts[key])
        data = np.frombuffer(b"".join(texts[key] for key in keys), np.uint8)
        begin = np.fromiter((base[k] for k in zip(asked["doc"].tolist(), asked["tag"].tolist())), np.int64, len(asked["doc"]))
        # grams of very many contexts: one context per window, which meets by the hash of the window
        many = np.flatnonzero(asked["many"])
        if len(many):
            count = asked["span"][many] + 1
            each = np.repeat(many, count)
            step = np.arange(len(each)) - np.repeat(np.cumsum(count) - count, count)
            step_rows = {name: column[each] for name, column in asked.items()}
            step_rows["start"] = step_rows["start"] + step
            step_rows["left"] = step_rows["left"] - step
            step_rows["span"] = np.zeros(len(each), np.int64)
            begin = np.r_[begin[asked["many"] == 0], begin[each]]
            asked = {name: np.r_[asked[name][asked["many"] == 0], step_rows[name]] for name in asked}
        starts = begin + asked["start"]
        single = np.flatnonzero(asked["many"])
        if len(single):
            at = starts[single]
            asked["gram"] = asked["gram"].copy()
            # an anchor before or behind the window has no meaning here: the window is its own right part
            asked["left"][single] = 0
            windows = np.lib.stride_tricks.sliding_window_view(data, MATCH)
            powers = np.cumprod(np.full(MATCH, Prefixes.BASE, U64), dtype=U64)
            asked["gram"][single] = np.concatenate([
                (mix(((windows[at[low:low + BLOCK // 8]].astype(U64) + U64(1)) * powers).sum(1, dtype=U64)) >> U64(16)).astype(np.int64)
                for low in range(0, len(at), BLOCK // 8)])
        span = np.minimum(asked["gram"] * ranges >> 48 if ranges < 1 << 15 else (asked["gram"] >> 16) * ranges >> 32, ranges - 1)
        order = np.argsort(span, kind="stable")
        edges = np.flatnonzero(np.r_[True, np.diff(span[order]) != 0, True])
        return _frame([(int(span[order[low]]), CONTEXTS, _pack_contexts(asked, data, starts, order[low:high]))
                       for low, high in zip(edges[:-1].tolist(), edges[1:].tolist())])
    return run


def matched_windows(rows: dict[str, np.ndarray], data: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Step 4: (row, window start relative to the context) of windows that a smaller document of the gram holds."""
    n = len(starts)
    gram = np.unique(rows["gram"] * 2 + rows["many"], return_inverse=True)[1]
    left, span = rows["left"], rows["span"]
    size = span + MATCH
    order, shared = deep_shallow(data, starts + left, size - left, gram)
    # left parts backwards: the buffer is turned around
    back_order, back_shared = deep_shallow(data[::-1], len(data) - starts - left, left, gram)
    rank, back_rank = np.empty(n, np.int64), np.empty(n, np.int64)
    rank[order], back_rank[back_order] = np.arange(n), np.arange(n)
    found_row, found_start = [], []
    for j in range(int(left.max()) + 1):
        who = np.flatnonzero((left >= j) & (left - span <= j))
        if len(who) < 2:
            continue
        right = np.cumsum(shared < MATCH - j)[rank[who]]
        before = np.cumsum(back_shared < j)[back_rank[who]]
        by = np.lexsort((rows["doc"][who], before, right))
        r, b, d = right[by], before[by], rows["doc"][who][by]
        new = np.r_[True, (np.diff(r) != 0) | (np.diff(b) != 0)]
        hit = d > d[new][np.cumsum(new) - 1]
        found_row.append(who[by][hit])
        found_start.append(left[who[by][hit]] - j)
    if not found_row:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    return np.concatenate(found_row), np.concatenate(found_start)


def _compare(parts: int):
    """Step 4, one range."""
    def run(group: pd.DataFrame) -> pd.DataFrame:
        heads, bodies = [], []
        width = sum(REQUEST.values())
        for blob in group["data"]:
            n = int.from_bytes(blob[:8], "little")
            heads.append(blob[8:8 + n * width])
            bodies.append(blob[8 + n * width:])
        rows = unpack(heads, REQUEST)
        data = np.frombuffer(b"".join(bodies), np.uint8)
        size = rows["span"] + MATCH
        row, at = matched_windows(rows, data, np.cumsum(size) - size)
        doc, tag, start = rows["doc"][row], rows["tag"][row], rows["start"][row] + at
        order = np.lexsort((start, tag, doc))
        doc, tag, start = doc[order], tag[order], start[order]
        if not len(doc):
            return _frame([])
        new = np.r_[True, (np.diff(doc) != 0) | (np.diff(tag) != 0) | (np.diff(start) > 1)]
        first = np.flatnonzero(new)
        last = np.r_[first[1:] - 1, len(doc) - 1]
        runs = {"doc": doc[first], "tag": tag[first], "start": start[first], "count": start[last] - start[first] + 1}
        # a count has two bytes; longer runs, of a gram that repeats inside a document, are cut
        pieces = (runs["count"] + 65_534) // 65_535
        each = np.repeat(np.arange(len(pieces)), pieces)
        step = (np.arange(len(each)) - np.repeat(np.cumsum(pieces) - pieces, pieces)) * 65_535
        cut = {"doc": runs["doc"][each], "tag": runs["tag"][each], "start": runs["start"][each] + step,
               "count": np.minimum(runs["count"][each] - step, 65_535)}
        return _frame(_by_part(cut, WINDOWS, parts, SETTLED))
    return run


def _drop(docs: pd.DataFrame, found: pd.DataFrame) -> pd.DataFrame:
    """Step 5, one part of the documents with its settled windows."""
    rows = unpack(list(found["data"]), WINDOWS)
    order = np.lexsort((rows["start"], rows["tag"], rows["doc"]))
    rows = {name: column[order] for name, column in rows.items()}
    new = np.flatnonzero(np.r_[True, (np.diff(rows["doc"]) != 0) | (np.diff(rows["tag"]) != 0)]) if len(order) else np.zeros(0, int)
    where = {(int(rows["doc"][a]), int(rows["tag"][a])): (a, b) for a, b in zip(new.tolist(), np.r_[new[1:], len(order)].tolist())}
    out = []
    for doc, tag, text in zip(docs["doc"].tolist(), docs["tag"].tolist(), docs["text"]):
        data = text.encode("utf-8", "surrogatepass")
        low, high = where.get((doc, tag), (0, 0))
        if low == high:
            out.append((len(data), [], data))
            continue
        edge = np.zeros(len(data) + 1, np.int64)
        np.add.at(edge, rows["start"][low:high], 1)
        np.add.at(edge, rows["start"][low:high] + rows["count"][low:high] + MATCH - 1, -1)
        gone = np.cumsum(edge[:-1]) > 0
        turns = np.flatnonzero(np.diff(np.r_[False, gone, False]))
        out.append((len(data), turns.tolist(), np.frombuffer(data, np.uint8)[~gone].tobytes()))
    return pd.DataFrame({"row": list(docs["row"]), "n_bytes": [o[0] for o in out], "cuts": [o[1] for o in out], "kept": [o[2] for o in out]})


def remove_repeats(docs: DataFrame, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """The documents with ``n_bytes``, ``cuts`` (start, end, start, end ... of the removed runs) and ``kept``, the bytes left."""
    docs.sparkSession.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(CHUNK))
    size = total_text_bytes(docs, text)
    parts = ranges = max(1, -(-size // RANGE_BYTES))
    doc = F.coalesce(F.col(f"`{doc_id}`").cast("bigint"), F.lit(-2**63))
    repeated = docs.groupBy(doc.alias("doc")).agg(F.count(F.lit(1)).alias("n")).where("n > 1").limit(1).count() > 0
    body = text_of(text)
    # Rows of one id are told apart by a hash of their text, if there are any; equal rows share it and lose the same bytes.
    tag: Column = F.xxhash64(body) if repeated else F.lit(0).cast("bigint")
    part = F.pmod(F.xxhash64(F.col("doc").bitwiseXOR(F.col("tag"))), F.lit(parts).cast("bigint"))
    names = [c for c in docs.columns if c not in ("n_bytes", "cuts", "kept")]
    keyed = docs.select(doc.alias("doc"), tag.alias("tag"), body.alias("text"),
                        F.struct(*[F.col(f"`{c}`") for c in names if c != text]).alias("row"))
    texts = keyed.select("doc", "tag", "text")
    placed = texts.withColumn("part", part)

    sent = texts.mapInPandas(_send_anchors(ranges, parts), PACKED)
    meet, passed = _meet(parts), SETTLED

    def range_step(group: pd.DataFrame) -> pd.DataFrame:
        own = group[group["kind"] == ANCHORS]
        rest = group[group["kind"] == passed]
        return pd.concat([rest, meet(own)]) if len(own) else rest

    first = materialize(sent.groupBy("part").applyInPandas(range_step, PACKED), "suffix-settled")
    asked = first.where(F.col("kind") == ASKED)
    contexts = (placed.groupBy("part").cogroup(asked.groupBy("part"))
                .applyInPandas(_send_contexts(ranges, parts), PACKED))
    second = materialize(contexts.groupBy("part").applyInPandas(_compare(parts), PACKED), "suffix-compared")
    found = first.where(F.col("kind") == SETTLED).unionByName(second)
    whole = keyed.withColumn("part", part)
    row_type = keyed.schema["row"].dataType.simpleString()
    done = whole.groupBy("part").cogroup(found.groupBy("part")).applyInPandas(
        _drop, f"row {row_type}, n_bytes bigint, cuts array<bigint>, kept binary")
    return done.select("row.*", "n_bytes", "cuts", "kept")


def suffix_digest(docs: DataFrame) -> DataFrame:
    done = remove_repeats(docs.select("doc_id", "text"))
    removed = F.when(F.size("cuts") > 0, F.col("n_bytes") - F.octet_length("kept")).otherwise(0)
    return done.select("doc_id", "n_bytes", removed.cast("bigint").alias("n_removed"),
                       (F.size("cuts") / 2).cast("bigint").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"))
