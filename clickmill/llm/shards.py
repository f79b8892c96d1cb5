"""Shards of near equal bytes by histogram sort.

Documents are ordered by a key of 48 hexadecimal digits: the MD5 of the text, then the id. Equal texts are neighbours in
this order, yet a group of any size can be cut between two of its ids. The shard boundaries are found by counting:
every round puts probes into the intervals that still hold a boundary, counts exact bytes between probes over all
partitions in one small aggregation, and keeps the probe interval that holds the boundary, until it lies within
``tolerance`` bytes of its target or a single key is left. The same rounds cut each shard into ranges of about
``RANGE_BYTES``, with a quarter of that as tolerance, so a range is never wider for a group of equal texts. Only counts reach the driver:
at most shards * ``PROBES`` cells and two per range and round. Then the documents are exchanged once, one partition per range, and
numbered inside their shard.

The law is ``bytes``: a document belongs to the shard in which the bytes before it, by key order, fall. Defined cases: a
null text has no bytes and sorts as the empty text, a null id before all ids; rows equal in text and id have one key and
stay together, their slots in no particular order; an empty table gives an empty result; other columns pass through
(columns called like an output are replaced).
DataFrame functions only.
"""

from __future__ import annotations

from bisect import bisect_right

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from clickmill.llm.common import discard, materialize, text_of

#: Cells that an interval is cut into in one round; fewer where there are more intervals than shards.
PROBES = 256
#: Rows, bytes of a row besides its text.
ROW_BYTES = 8
#: Bytes that one range of the exchange should hold.
RANGE_BYTES = 64 << 20
DIGITS = 48
TOP = 1 << (4 * DIGITS)


def key_of(text: Column, doc_id: Column) -> Column:
    """The sort key. The sign bit of the id is flipped, so that hexadecimal order is numeric order."""
    number = F.coalesce(doc_id.cast("bigint"), F.lit(-2**63)).bitwiseXOR(F.lit(-2**63))
    return F.concat(F.md5(text), F.lower(F.lpad(F.hex(number), 16, "0")))


def as_key(number: int) -> str:
    return f"{number:0{DIGITS}x}"


def place(key: Column, bounds: list[str]) -> Column:
    """How many of the sorted ``bounds`` are at or below the key: a binary search in an array literal."""
    if not bounds:
        return F.lit(0)
    steps = max(1, len(bounds).bit_length())
    array = F.split(F.lit(",".join(bounds)), ",")
    jumps = F.array(*[F.lit(1 << s) for s in reversed(range(steps))])

    def jump(low: Column, width: Column) -> Column:
        bound = F.get(array, low + width - 1)  # null beyond the last bound
        return F.when(bound <= key, low + width).otherwise(low)

    return F.aggregate(jumps, F.lit(0), jump)


def _cells(keys: DataFrame, bounds: list[str]) -> dict[int, tuple[int, int, str, str]]:
    """Bytes, rows, least and greatest key per cell between neighbouring bounds."""
    rows = (keys.groupBy(place(F.col("key"), bounds).alias("cell"))
            .agg(F.sum("size").alias("bytes"), F.count(F.lit(1)).alias("rows"), F.min("key").alias("low"), F.max("key").alias("high"))
            .collect())  # at most one row per bound
    return {r["cell"]: (r["bytes"], r["rows"], r["low"], r["high"]) for r in rows}


def splitters(keys: DataFrame, shards: int, tolerance: int = 0, range_bytes: int = RANGE_BYTES) -> tuple[list[str], list[str]]:
    """The least key of each shard but the first, and of each range but the first. ``keys``: (key, size)."""
    total = int(keys.agg(F.coalesce(F.sum("size"), F.lit(0)).alias("n")).first()["n"])
    ranges = max(1, -(-total // (range_bytes * shards)))  # per shard
    targets = [total * r // (shards * ranges) for r in range(1, shards * ranges)]
    slack = [max(tolerance, range_bytes // 4) if r % ranges else tolerance for r in range(1, shards * ranges)]
    probes_each = max(2, PROBES // ranges)
    # per target: interval [low, high) of keys that holds the boundary, and the bytes below low
    state = [[0, TOP, 0] for _ in targets]
    found: list[int | None] = [None] * len(targets)
    while total and any(f is None for f in found):
        probes: set[int] = set()
        for (low, high, _), f in zip(state, found):
            if f is None:
                step = max(1, (high - low) // probes_each)
                probes.update(range(low, high, step))
                probes.add(high)
        bounds = sorted(p for p in probes if p < TOP)
        cells = _cells(keys, [as_key(b) for b in bounds])
        below, so_far = [], cells.get(0, (0,))[0]
        for i in range(len(bounds)):
            below.append(so_far)  # bytes of keys under bounds[i]
            so_far += cells.get(i + 1, (0,))[0]
        for t, target in enumerate(targets):
            if found[t] is not None:
                continue
            # the boundary is the least key whose bytes below reach the target
            i = bisect_right(below, target - 1)
            if i < len(bounds) and below[i] - target <= slack[t]:
                found[t] = bounds[i]
                continue
            size, rows, low, high = cells[i]  # the cell where the bytes pass the target
            if low == high:
                found[t] = int(high, 16) + 1
            else:
                state[t] = [int(low, 16), int(high, 16) + 1, below[i - 1] if i else 0]
    cuts = [as_key(min(f, TOP - 1)) if f is not None else as_key(0) for f in found]
    return cuts[ranges - 1::ranges], cuts


def assign_shards(docs: DataFrame, shards: int = 24, tolerance: int = 0, text: str = "text", doc_id: str = "doc_id",
                  range_bytes: int = RANGE_BYTES) -> DataFrame:
    """The documents with ``size``, ``shard`` and ``slot``; each range of the exchange is sorted by key."""
    body = text_of(text)
    size = (F.octet_length(body) + ROW_BYTES).cast("bigint")
    keys = materialize(docs.select(key_of(body, F.col(f"`{doc_id}`")).alias("key"), size.alias("size")), "shard-keys")
    bounds, cuts = splitters(keys, shards, tolerance, range_bytes)
    bounds, cuts = sorted(bounds), sorted(set(cuts))
    cells = _cells(keys, cuts)
    starts, slots = [0] * shards, []
    shard_of = []
    for i in range(len(cuts) + 1):
        shard = bisect_right(bounds, cuts[i - 1]) if i else 0
        shard_of.append(shard)
        slots.append(starts[shard])
        starts[shard] += cells.get(i, (0, 0))[1]
    discard(keys)
    lookup = lambda values: F.get(F.split(F.lit(",".join(map(str, values))), ","), F.col("__range"))
    placed = (docs.drop("size", "shard", "slot").withColumn("size", size)
              .withColumn("__key", key_of(body, F.col(f"`{doc_id}`"))).withColumn("__range", place(F.col("__key"), cuts)))
    order = Window.partitionBy("__range").orderBy("__key")
    return (placed.repartitionById(len(cuts) + 1, F.col("__range").cast("int")).withColumn("__row", F.row_number().over(order) - 1)
            .withColumn("shard", lookup(shard_of).cast("int"))
            .withColumn("slot", lookup(slots).cast("bigint") + F.col("__row"))
            .drop("__row", "__key", "__range"))


def shard_digest(docs: DataFrame, shards: int = 24, range_bytes: int = RANGE_BYTES) -> DataFrame:
    done = assign_shards(docs, shards, range_bytes=range_bytes)
    return done.select("doc_id", "size", F.crc32(F.encode(text_of(), "UTF-8")).alias("text_crc32"),
                       F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))
