"""Compression of vectors to one byte per part, with codebooks of integers and per-dimension dictionaries.

Components become integers, floor(256 x). A vector is cut into equal parts; each part position has a codebook, and a vector is
stored as the number of the nearest entry per part. Codebooks are refined by rounds of assigning and averaging.

Distances never touch single vectors. Integers repeat, so a block of vectors keeps, per dimension, a dictionary of its distinct
integers and one code per vector. For a round the squared differences of every distinct integer to all entries are tabulated
once; the distance of a part to all entries is then a gather per dimension, added up. The blocks are written once, as dictionary
and codes, and every round reads them again; vectors are not parsed twice.

A round is one pass without a shuffle of vectors: each task adds up sums and counts per entry of its blocks, Spark adds those up
per (part, entry), and the driver gets the codebooks: at most ``entries`` rows per part, whatever the number of vectors. All
arithmetic is in integers, so results depend neither on order nor on partitions.

Defined cases: rows whose vector is null, or holds a null, NaN or infinity, are left out; with fewer kept rows than entries the
codebooks are shorter; the first entries come from the least ids, null ids last, equal ids in the order of their vectors;
repeated rows count each; an empty table gives an empty result; only id, vector and label are read. Lengths must be equal and
a multiple of ``parts``, and integers so small that every distance fits 64 bits (of 64 components up to 2 to the 27); anything
else is an error.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from clickmill.llm.common import materialize
from clickmill.operators.lookup import attach

PARTS = 16
ENTRIES = 64
ROUNDS = 2
SCALE = 256
#: Vectors of a block.
BLOCK_ROWS = 8192

BLOCKS = "dim int, entries array<int>, dictionary binary, codes binary"


def finite_vectors(rows: DataFrame, vector: str) -> DataFrame:
    """Rows whose vector is there and has finite components only."""
    infinity = F.lit(float("inf"))
    return rows.where(F.col(vector).isNotNull() & F.forall(
        vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < infinity)))


def to_integers(flat: np.ndarray, dim: int) -> np.ndarray:
    """Components of vectors of length ``dim`` as rows of integers."""
    scaled = np.floor(flat.astype(np.float64) * SCALE)
    if len(scaled) and dim * (2 * np.abs(scaled).max()) ** 2 >= 2.0**63:
        raise ValueError("a component is too large for exact distances")
    return scaled.astype(np.int64).reshape(-1, dim) if dim else np.zeros((0, 0), np.int64)


def _matrix(vectors: pa.Array) -> np.ndarray:
    """The vectors as rows of integers."""
    if isinstance(vectors, pa.ChunkedArray):
        vectors = vectors.combine_chunks()
    sizes = np.diff(vectors.offsets.to_numpy())
    if len(sizes) and (sizes != sizes[0]).any():
        raise ValueError("vectors differ in length")
    if not len(sizes) or not sizes[0]:
        return np.zeros((len(sizes), 0), np.int64)
    return to_integers(vectors.flatten().to_numpy(zero_copy_only=False), int(sizes[0]))


class Block:
    """Integers of some vectors as one dictionary per dimension and codes, a row of codes per dimension."""

    def __init__(self, dictionaries: list[np.ndarray], codes: np.ndarray) -> None:
        self.dictionaries, self.codes = dictionaries, codes

    @classmethod
    def build(cls, matrix: np.ndarray) -> Block:
        pairs = [np.unique(column, return_inverse=True) for column in matrix.T]
        codes = np.array([inverse for _, inverse in pairs], np.uint16).reshape(matrix.shape[::-1])
        return cls([values for values, _ in pairs], codes)

    @classmethod
    def load(cls, dim: int, sizes: list[int], dictionary: bytes, codes: bytes) -> Block:
        edges = np.cumsum([0, *sizes])
        values = np.frombuffer(dictionary, "<i8")
        return cls([values[a:b] for a, b in zip(edges[:-1], edges[1:])], np.frombuffer(codes, "<u2").reshape(dim, -1))

    def distances(self, part: int, codebook: np.ndarray) -> np.ndarray:
        """Squared distances of one part of all vectors (rows) to the entries of its codebook (columns)."""
        width = codebook.shape[1]
        total = None
        for k in range(width):
            at = part * width + k
            # the table: every distinct integer of the dimension against every entry
            table = np.square(self.dictionaries[at][:, None] - codebook[None, :, k])
            step = table[self.codes[at]]
            total = step if total is None else np.add(total, step, out=total)
        return np.zeros((self.codes.shape[1], len(codebook)), np.int64) if total is None else total

    def nearest(self, part: int, codebook: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Number of the nearest entry, the least of equally near ones, and its distance."""
        distances = self.distances(part, codebook)
        entry = distances.argmin(1)
        return entry, distances[np.arange(len(entry)), entry]

    def sums(self, part: int, width: int, entry: np.ndarray, entries: int) -> tuple[np.ndarray, np.ndarray]:
        """Number of vectors per entry and the sum of their parts, again by way of the dictionaries."""
        totals = np.zeros((entries, width), np.int64)
        for k in range(width):
            at = part * width + k
            values = self.dictionaries[at]
            seen = np.bincount(entry * len(values) + self.codes[at], minlength=entries * len(values))
            totals[:, k] = seen.reshape(entries, -1) @ values
        return np.bincount(entry, minlength=entries), totals


def encode_blocks(kept: DataFrame, vec_id: str, vector: str, label: str) -> DataFrame:
    """One row per block: ids, labels, and the vectors as dictionaries and codes."""
    schema = T.StructType([T.StructField("ids", T.ArrayType(kept.schema[vec_id].dataType)),
                           T.StructField("labels", T.ArrayType(kept.schema[label].dataType)),
                           *T.StructType.fromDDL(BLOCKS).fields])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for low in range(0, batch.num_rows, BLOCK_ROWS):
                piece = batch.slice(low, BLOCK_ROWS)
                block = Block.build(_matrix(piece.column(1)))
                whole = [0, piece.num_rows]
                yield pa.RecordBatch.from_arrays([
                    pa.ListArray.from_arrays(whole, piece.column(0)), pa.ListArray.from_arrays(whole, piece.column(2)),
                    pa.array([len(block.dictionaries)], pa.int32()),
                    pa.array([[len(d) for d in block.dictionaries]], pa.list_(pa.int32())),
                    pa.array([b"".join(d.astype("<i8").tobytes() for d in block.dictionaries)], pa.binary()),
                    pa.array([block.codes.astype("<u2").tobytes()], pa.binary())], schema.names)

    return kept.select(vec_id, vector, label).mapInArrow(run, schema)


def _blocks_of(batch: pa.RecordBatch) -> Iterator[tuple[pa.RecordBatch, Block]]:
    for k in range(batch.num_rows):
        row = batch.slice(k, 1)
        yield row, Block.load(*[row.column(name)[0].as_py() for name in ("dim", "entries", "dictionary", "codes")])


def _check(dim: int, parts: int, width: int) -> None:
    if dim != parts * width:
        raise ValueError("vectors differ in length")


def refine(blocks: DataFrame, codebooks: np.ndarray) -> np.ndarray:
    """One round: the codebooks (part, entry, position) with every entry at the mean of its parts, rounded down."""
    parts, entries, width = codebooks.shape

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts, sums = np.zeros((parts, entries), np.int64), np.zeros((parts, entries, width), np.int64)
        for batch in batches:
            for _, block in _blocks_of(batch):
                _check(len(block.dictionaries), parts, width)
                for part in range(parts):
                    entry, _ = block.nearest(part, codebooks[part])
                    n, total = block.sums(part, width, entry, entries)
                    counts[part] += n
                    sums[part] += total
        part, entry = np.nonzero(counts)
        if len(part):
            yield pa.RecordBatch.from_arrays([
                pa.array(part, pa.int32()), pa.array(entry, pa.int32()), pa.array(counts[part, entry]),
                pa.array(list(sums[part, entry]), pa.list_(pa.int64()))], ["part", "entry", "n", "sums"])

    partial = blocks.select("dim", "entries", "dictionary", "codes").mapInArrow(run, "part int, entry int, n bigint, sums array<bigint>")
    means = partial.groupBy("part", "entry").agg(
        F.sum("n").alias("n"), *[F.sum(F.get("sums", F.lit(k)).cast("decimal(38,0)")).alias(f"s{k}") for k in range(width)])
    out = codebooks.copy()
    for row in means.collect():  # at most parts * entries rows
        out[row["part"], row["entry"]] = [int(row[f"s{k}"]) // row["n"] for k in range(width)]
    return out


def first_codebooks(kept: DataFrame, vec_id: str, vector: str, parts: int, entries: int) -> np.ndarray:
    """The parts of the vectors of the least ids; the driver gets ``entries`` rows."""
    rows = kept.orderBy(F.col(vec_id).asc_nulls_last(), F.col(vector).asc()).select(vector).limit(entries).collect()
    if len({len(row[0]) for row in rows}) > 1 or (rows and len(rows[0][0]) % parts):
        raise ValueError("vectors differ in length or cannot be cut into equal parts")
    width = len(rows[0][0]) // parts if rows else 0
    flat = to_integers(np.array([x for row in rows for x in row[0]], np.float64), parts * width)
    return flat.reshape(len(rows), parts, width).transpose(1, 0, 2).copy()


def assign(blocks: DataFrame, codebooks: np.ndarray, vec_id: str, label: str) -> DataFrame:
    """Per vector its id, label, ``code`` (one byte per part) and ``error``, the squared distances summed over the parts."""
    parts, _, width = codebooks.shape
    types = {f.name: f.dataType.elementType for f in blocks.schema.fields if f.name in ("ids", "labels")}
    schema = T.StructType([T.StructField(vec_id, types["ids"]), T.StructField(label, types["labels"]),
                           T.StructField("code", T.BinaryType()), T.StructField("error", T.LongType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row, block in _blocks_of(batch):
                _check(len(block.dictionaries), parts, width)
                n = len(row.column("ids")[0])
                code, error = np.zeros((n, parts), np.uint8), np.zeros(n, np.int64)
                for part in range(parts):
                    entry, distance = block.nearest(part, codebooks[part])
                    code[:, part] = entry
                    error += distance
                edges = pa.array(np.arange(n + 1, dtype=np.int32) * parts).buffers()[1]
                yield pa.RecordBatch.from_arrays([
                    row.column("ids").flatten(), row.column("labels").flatten(),
                    pa.Array.from_buffers(pa.binary(), n, [None, edges, pa.py_buffer(code.tobytes())]), pa.array(error)], schema.names)

    return blocks.mapInArrow(run, schema)


def compress(rows: DataFrame, vec_id: str = "vec_id", vector: str = "embedding", label: str = "label", parts: int = PARTS,
             entries: int = ENTRIES, rounds: int = ROUNDS) -> tuple[DataFrame, np.ndarray]:
    """(codes and errors of the kept vectors, final codebooks by part, entry and position)."""
    if not 0 < entries <= 256:
        raise ValueError("a code is one byte, so a codebook has 1 to 256 entries")
    kept = finite_vectors(rows.select(vec_id, vector, label), vector)
    blocks = materialize(encode_blocks(kept, vec_id, vector, label), "vector-blocks")
    codebooks = first_codebooks(kept, vec_id, vector, parts, entries)
    for _ in range(rounds if codebooks.shape[1] else 0):
        codebooks = refine(blocks, codebooks)
    return assign(blocks, codebooks, vec_id, label), codebooks


def decompress(codes: DataFrame, codebooks: np.ndarray, code: str = "code", name: str = "approximate") -> DataFrame:
    """Adds the vector that a code stands for, in the scale of the original."""
    table = F.lit((codebooks / SCALE).tolist())
    places = F.sequence(F.lit(0), F.lit(len(codebooks) - 1))
    byte = lambda p: F.conv(F.hex(F.substring(F.col(code), p + 1, F.lit(1))), 16, 10).cast("int")
    return codes.withColumn(name, F.flatten(F.transform(places, lambda p: F.get(F.get(table, p), byte(p)))))


def code_digest(rows: DataFrame) -> DataFrame:
    """Codes and errors of all vectors, the error summed per label, and the hash of the codebooks."""
    codes, codebooks = compress(rows)
    codes = materialize(codes, "vector-codes").withColumn(
        "group", F.when(F.col("label").isNull(), "-").otherwise(F.concat(F.lit("+"), F.col("label").cast("string"))))
    per_label = codes.groupBy("group").agg(F.sum("error").alias("label_error"))
    done = attach(codes, per_label, "group", weigh=codes.select("group"))
    numbers = hashlib.sha256(",".join(map(str, codebooks.ravel().tolist())).encode()).hexdigest()
    return done.select("vec_id", F.lower(F.hex("code")).alias("code"), "error", "label_error",
                       F.lit(numbers).alias("codebooks_sha256"))
