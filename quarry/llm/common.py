"""Shared plumbing: working tables, hashing of words, and gapless distributed numbering."""

from __future__ import annotations

import re
import tempfile
import uuid
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

#: Text handled at once in a Python worker; documents are never cut, so one long document may exceed it.
CHUNK_BYTES = 4 << 20
#: The bytes that separate words in operators which split on ASCII white space only.
ASCII_SPACE = b" \t\n\r\x0b\x0c"

_M1, _M2 = np.uint64(0xFF51AFD7ED558CCD), np.uint64(0xC4CEB9FE1A85EC53)
_S33 = np.uint64(33)


#: Working tables written so far; a result may need them until it has been read.
_WRITTEN: list[str] = []


def work_dir(spark: SparkSession) -> str:
    """The shared folder the session names. Where none is named, a temporary one on this machine, which will do for a
    local session only."""
    where = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not where:
        current = spark.sparkContext._jsc.sc().getCheckpointDir()
        where = current.get() if current.isDefined() else None
    if not where:
        if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        where = "file://" + tempfile.mkdtemp(prefix="quarry-")
        spark.sparkContext.setCheckpointDir(where)
    return where.rstrip("/")


def written(df: DataFrame, tag: str) -> DataFrame:
    """`df` as a table in the shared folder: cuts lineage, and survives lost executors."""
    path = f"{work_dir(df.sparkSession)}/{tag}-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    _WRITTEN.append(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def clear(spark: SparkSession) -> int:
    """Delete the working tables of all operators run so far, once their results have been read; returns how many."""
    n = len(_WRITTEN)
    for name in _WRITTEN:
        path = spark._jvm.org.apache.hadoop.fs.Path(name)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
    _WRITTEN.clear()
    return n


def dropped(df: DataFrame, *tables: DataFrame) -> DataFrame:
    """`df`, after the folders of working tables that nothing needs any more are deleted."""
    jvm = df.sparkSession._jvm
    for table in tables:
        for name in {f.rsplit("/", 1)[0] for f in table.inputFiles()}:
            path = jvm.org.apache.hadoop.fs.Path(name)
            path.getFileSystem(df.sparkSession._jsc.hadoopConfiguration()).delete(path, True)
    return df


def without(df: DataFrame, *names: str) -> DataFrame:
    """Drop columns that an operator is about to add; names clash without regard to case."""
    taken = {n.lower() for n in names}
    return df.select(*[F.col(f"`{c}`") for c in df.columns if c.lower() not in taken])


#: Bits of a filter over ids; it takes an eighth of that in bytes, whatever it is built from, so it may be broadcast.
FILTER_BITS = 1 << 26


def marked(df: DataFrame, key: str, ids: DataFrame, out: str = "_in") -> DataFrame:
    """`df` with a boolean `out` that is true wherever `key` is among `ids` (one column), and true by chance elsewhere:
    a hashed bitmap keeps rows that surely have no partner out of a shuffle. An exact join has to follow. Where ids are
    so many that the bitmap fills up, it only stops saving. A null key is not among any."""
    place = lambda c: F.pmod(F.xxhash64(c), F.lit(FILTER_BITS)) + 1
    rows = ids.select(place(F.col(ids.columns[0])).alias("_x")).groupBy(F.bitmap_bucket_number("_x").alias("_bucket"))
    bits = written(rows.agg(F.bitmap_construct_agg(F.bitmap_bit_position("_x")).alias("_bits")), "ids")
    keyed = df.withColumn("_x", place(F.col(key))).withColumn("_p", F.bitmap_bit_position("_x")).withColumn("_k", F.bitmap_bucket_number("_x"))
    both = keyed.join(F.broadcast(bits), F.col("_k") == F.col("_bucket"), "left")  # FILTER_BITS / 8 bytes at most
    byte = "cast(conv(hex(substring(_bits, cast(_p div 8 as int) + 1, 1)), 16, 10) as int)"
    hit = F.expr(f"coalesce((shiftright({byte}, cast(_p % 8 as int)) & 1) = 1, false)") & F.col(key).isNotNull()
    return both.select(*df.columns, hit.alias(out))


def spans(sizes: Iterable[int], limit: int) -> Iterator[tuple[int, int]]:
    """Index ranges of whole items of about `limit` together."""
    start = size = end = 0
    for i, n in enumerate(sizes):
        if size and size + n > limit:
            yield start, i
            start, size = i, 0
        size += n
        end = i + 1
    if start < end:
        yield start, end


def chunks(texts: list[bytes], limit: int = CHUNK_BYTES) -> Iterator[tuple[int, int]]:
    """Index ranges of whole texts of about `limit` bytes together."""
    return spans(map(len, texts), limit)


def utf8(column: pa.Array) -> list[bytes | None]:
    """An Arrow string column as bytes, without decoding."""
    return column.cast(pa.binary()).to_pylist()


def mix(x: np.ndarray) -> np.ndarray:
    """Finaliser of a 64-bit hash, elementwise."""
    with np.errstate(over="ignore"):
        x = (x ^ (x >> _S33)) * _M1
        x = (x ^ (x >> _S33)) * _M2
        return x ^ (x >> _S33)


class WordHasher:
    """64-bit hashes of words, remembered between calls up to a bounded number of words."""

    def __init__(self, most: int = 300_000) -> None:
        self.most, self.known = most, {}

    def __call__(self, words: list[bytes]) -> np.ndarray:
        if len(self.known) > self.most:
            self.known = {}
        known, of = self.known, xxhash.xxh3_64_intdigest
        for w in set(words).difference(known):
            known[w] = of(w)
        return np.fromiter(map(known.__getitem__, words), np.uint64, len(words))


def hashed_words(data: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """64-bit hash, begin and end of the words of a text, in arrays: words are separated by one blank or line end each,
    with none before the first or after the last. Eight bytes of every word are mixed in at a time."""
    if not data:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int64)
    raw = np.frombuffer(data, np.uint8)
    gaps = np.flatnonzero((raw == 32) | (raw == 10))
    begin, end = np.append(0, gaps + 1), np.append(gaps, len(data))
    at8 = np.ndarray((len(data),), "<u8", data + bytes(8), strides=(1,))  # the eight bytes from each place on
    left = end - begin
    out = mix(left.astype(np.uint64))
    todo, at = np.arange(len(begin)), begin
    while len(todo):
        part = at8[at]
        short = left < 8
        part[short] &= (np.uint64(1) << (np.uint64(8) * left[short].astype(np.uint64))) - np.uint64(1)
        out[todo] = mix(out[todo] ^ part)
        more = left > 8
        todo, at, left = todo[more], at[more] + 8, left[more] - 8
    return out, begin, end


def shingles(words: np.ndarray, k: int) -> np.ndarray:
    """Hashes of all runs of k word hashes."""
    n = len(words) - k + 1
    out = np.zeros(max(n, 0), np.uint64)
    with np.errstate(over="ignore"):
        for i in range(k):
            out = mix(out * np.uint64(0x9E3779B97F4A7C15) + words[i : i + n] + np.uint64(i + 1)) if n > 0 else out
    return out


def numbered(df: DataFrame, group: list[str], order: list[Column], out: str, buckets: int) -> DataFrame:
    """Adds `out`: 0, 1, 2, ... without gaps within `group`, in the order of (first element of `order`, hash bucket,
    rest), where the first element is a small integer. Each window covers one bucket of one group, so no task holds a
    group; what is collected in between is one count per group and bucket."""
    first, *rest = order
    keyed = df.withColumn("_b", F.pmod(F.xxhash64(*rest), F.lit(buckets)).cast("int")).withColumn("_f", first)
    sizes = keyed.groupBy(*group, "_f", "_b").agg(F.count("*").alias("_n"))
    before = Window.partitionBy(*group).orderBy("_f", "_b").rowsBetween(Window.unboundedPreceding, -1)
    by = [*group, "_f", "_b"]
    starts = sizes.select(*[F.col(c).alias(f"_s{i}") for i, c in enumerate(by)], F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start"))
    ranked = keyed.withColumn("_r", F.row_number().over(Window.partitionBy(*by).orderBy(*rest)) - 1)
    joined = ranked.join(starts, [F.col(c).eqNullSafe(F.col(f"_s{i}")) for i, c in enumerate(by)])
    return joined.select(*df.columns, (F.col("_r") + F.col("_start")).cast("long").alias(out))
