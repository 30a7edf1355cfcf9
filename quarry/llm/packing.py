"""Packing of documents along a space-filling curve.

A document's vector is the sum over its token ids of a hashed row of signs, projected to `DIMENSIONS` numbers and scaled
to uniform ranks; its Hilbert key orders documents so that neighbours on the curve have neighbouring vectors. Keys and
lengths, not tokens, are range-sorted; each range partition adds up its lengths, the sums of the partitions give every
document its place in one stream, and the stream is cut into sequences. Tokens then travel once, to meet their place.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.llm.common import spans, written
from quarry.llm.tokens import encoder

DIMENSIONS, DEPTH = 3, 10
#: Bytes of whole texts that are taken out of Arrow and encoded together.
ENCODE_BYTES = 1 << 18
SIGNS = np.random.RandomState(7).choice(np.array([-1, 1], np.int8), size=(DIMENSIONS, 1 << 16))


def hilbert(points: np.ndarray, depth: int = DEPTH) -> np.ndarray:
    """Place on the Hilbert curve of points (rows) with integer coordinates below 2**depth: bits are turned to the
    curve's frame from the highest down, then Gray-decoded and interleaved."""
    x = points.astype(np.int64).T.copy()
    dims = len(x)
    q = 1 << (depth - 1)
    while q > 1:
        low = q - 1
        for i in range(dims):
            high = (x[i] & q) != 0
            swap = np.where(high, 0, (x[0] ^ x[i]) & low)
            x[0] = np.where(high, x[0] ^ low, x[0] ^ swap)
            x[i] ^= swap
        q >>= 1
    for i in range(1, dims):
        x[i] ^= x[i - 1]
    turn = np.zeros(x.shape[1], np.int64)
    q = 1 << (depth - 1)
    while q > 1:
        turn = np.where((x[-1] & q) != 0, turn ^ (q - 1), turn)
        q >>= 1
    x ^= turn
    key = np.zeros(x.shape[1], np.int64)
    for b in range(depth - 1, -1, -1):
        for i in range(dims):
            key = (key << 1) | ((x[i] >> b) & 1)
    return key


def curve_keys(ids: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Hilbert key of each document, given all ids one after another: a projected sum over sqrt(length) is about normal,
    and its quantile (by a logistic curve close to the normal one) is cut into 2**DEPTH cells."""
    sums = np.zeros((len(counts), DIMENSIONS))
    some = counts > 0
    if some.any():
        begin = (np.cumsum(counts) - counts)[some]
        for d in range(DIMENSIONS):
            sums[some, d] = np.add.reduceat(SIGNS[d][ids & np.uint32(0xFFFF)], begin, dtype=np.int64)
    vector = sums / np.sqrt(np.maximum(counts, 1))[:, None]
    cells = np.minimum((1 << DEPTH) / (1 + np.exp(-1.702 * np.clip(vector, -30, 30))), (1 << DEPTH) - 1)
    return hilbert(cells.astype(np.int64))


def stored(flat: np.ndarray, counts: np.ndarray, end_id: int) -> tuple[pa.Array, pa.Array]:
    """Whether each document has an id over 16 bits, and its ids, then `end_id`, in as many bits."""
    own = np.full(len(flat) + len(counts), end_id, np.uint32)
    ends = np.cumsum(counts + 1)
    inner = np.ones(len(own), bool)
    inner[ends - 1] = False
    own[inner] = flat
    if int(own.max(initial=0)) <= 0xFFFF and 2 * len(own) < 1 << 31:
        borders = np.append(0, 2 * ends).astype(np.int32)
        return pa.array(np.zeros(len(counts), bool)), pa.Array.from_buffers(pa.binary(), len(counts), [None, pa.py_buffer(borders), pa.py_buffer(own.astype("<u2"))])
    each = np.split(own, ends[:-1])
    wide = [bool(x.max() > 0xFFFF) for x in each]
    return pa.array(wide), pa.array([x.astype("<u4" if w else "<u2").tobytes() for x, w in zip(each, wide, strict=True)], pa.binary())


def tokenized(docs: DataFrame, path: str, end_id: int) -> DataFrame:
    """doc_id, key, doc_tokens and ids (little-endian, 16 bits where all ids fit, else 32) of each row."""
    schema = f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, key long, doc_tokens long, wide boolean, ids binary"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(path)
        for batch in batches:
            sizes = pc.fill_null(pc.binary_length(batch.column("text").cast(pa.binary())), 0)
            for a, b in spans(sizes.to_pylist(), ENCODE_BYTES):
                flat, counts = encode([t or "" for t in batch.column("text").slice(a, b - a).to_pylist()])
                keys = curve_keys(flat, counts)
                wide, ids = stored(flat, counts, end_id)
                yield pa.RecordBatch.from_arrays([batch.column("doc_id").slice(a, b - a), pa.array(keys), pa.array(counts + 1), wide, ids], names=["doc_id", "key", "doc_tokens", "wide", "ids"])

    return docs.select("doc_id", "text").mapInArrow(run, schema)


def pack(docs: DataFrame, path: str, length: int = 2048, end_id: int = 1) -> DataFrame:
    """doc_id, start, length, doc_tokens, sequence_id, offset and ids (little-endian unsigned 32 bits) of each piece.

    Every document is its token ids followed by `end_id`; a null or empty text is `end_id` alone. Sequences hold exactly
    `length` ids but for the last; each id lies in one piece. Documents come in the order of their curve key, ties by
    doc_id (nulls first) and then by ids, so repeated rows are each packed. Other columns are ignored; an empty table
    gives no piece.
    """
    spark = docs.sparkSession
    own = written(tokenized(docs, path, end_id).withColumn("row", F.monotonically_increasing_id()), "pack")
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))

    def local(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at = 0
        for batch in batches:
            ends = np.cumsum(batch.column("doc_tokens").to_numpy()) + at
            at = int(ends[-1]) if len(ends) else at
            yield pa.RecordBatch.from_arrays([batch.column("row"), batch.column("part"), batch.column("doc_tokens"), pa.array(ends - batch.column("doc_tokens").to_numpy())], names=["row", "part", "n", "local"])

    along = own.select("row", "doc_id", "key", "doc_tokens").repartitionByRange(parts, "key", "doc_id", "row").sortWithinPartitions("key", "doc_id", "row")
    ranged = written(along.select("row", F.spark_partition_id().alias("part"), "doc_tokens").mapInArrow(local, "row long, part int, n long, local long"), "pack-order")
    base, at = [], 0
    for r in ranged.groupBy("part").agg(F.sum("n").alias("n")).orderBy("part").collect():
        base.append((r["part"], at))
        at += r["n"]
    # one row per range partition
    bases = F.broadcast(spark.createDataFrame(base, "part int, base long"))
    placed = ranged.join(bases, "part").select("row", (F.col("base") + F.col("local")).alias("place"))
    schema = f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, start long, length long, doc_tokens long, sequence_id long, offset long, ids binary"

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            which, starts, lens, ids = [], [], [], []
            place = batch.column("place").to_numpy()
            for i, (p, n, wide, raw) in enumerate(zip(place.tolist(), batch.column("doc_tokens").to_pylist(), batch.column("wide").to_pylist(), batch.column("ids").to_pylist(), strict=True)):
                own, a = np.frombuffer(raw, "<u4" if wide else "<u2").astype("<u4"), 0
                while a < n:
                    size = min(n - a, length - (p + a) % length)
                    which.append(i)
                    starts.append(a)
                    lens.append(size)
                    ids.append(own[a : a + size].tobytes())
                    a += size
            at = np.array(which, np.int64)
            begin = np.array(starts, np.int64)
            spot = place[at] + begin if len(at) else begin
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id").take(pa.array(at)), pa.array(begin), pa.array(lens, pa.int64()), batch.column("doc_tokens").take(pa.array(at)), pa.array(spot // length), pa.array(spot % length), pa.array(ids, pa.binary())],
                names=["doc_id", "start", "length", "doc_tokens", "sequence_id", "offset", "ids"],
            )

    return own.join(placed, "row").select("doc_id", "place", "doc_tokens", "wide", "ids").mapInArrow(cut, schema)

