"""Removal of repeated word windows by super-k-mer partitioning.

A window is `width` consecutive words of one document. The minimiser of a window is the smallest hash among its runs of
`MINI` words, where runs that are common in a bounded sample of documents come after all others; so a window is only
dealt by a common run if it holds nothing else, and such windows are few. Consecutive windows with one minimiser form a
super-k-mer, which travels as one packed string to the bucket of its minimiser. Equal windows have equal minimisers
whatever the sample, so each bucket sees every place of its windows, sorts them by hash, compares the words of windows
with equal hashes, and marks all places but the first.

Before they travel, equal strings of one worker's chunk fold into the earliest place, the others being marked at once;
so a passage that a third of all documents share reaches its bucket once per chunk. Strings travel in compressed blocks,
one per chunk and bucket. A bucket is read as a stream and keeps only strings that hold the first place of a window.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quarry.llm.common import chunks, hashed_words, mix, shingles, utf8, written

MINI = 4
#: Text that a worker packs at once, and unpacked strings that a bucket handles at once.
PACK_BYTES, SORT_BYTES = 8 << 20, 12 << 20
#: Unpacked strings that a bucket is meant to hold; they take about three times the bytes of the text.
BUCKET_BYTES = 8 << 20
#: Buckets that one task should read, so that tasks grow in number and not in size.
TASK_BUCKETS = 16
#: Documents in whose sample a run of MINI words is sought, how many of these must have it to be common, and how many
#: runs count as common at most. They decide which bucket a window goes to, and nothing else.
SAMPLE_ROWS, COMMON, MOST_COMMON = 4000, 8, 1 << 16
#: Columns of the places in a block, one array each: document, what tells rows of one doc_id apart, first window, windows.
_HEAD = (("doc", "<i8"), ("tie", "<i8"), ("start", "<i4"), ("windows", "<i4"))
_HEAD_BYTES = 24


def _sliding_min(x: np.ndarray, n: int) -> np.ndarray:
    """Minimum of each n consecutive values."""
    have, out = 1, x
    while have * 2 <= n:
        out = np.minimum(out[:-have], out[have:])
        have *= 2
    return np.minimum(out[: len(x) - n + 1], out[n - have : n - have + len(x) - n + 1]) if have < n else out


def super_kmers(data: bytes, begin: np.ndarray, end: np.ndarray, hashes: np.ndarray, width: int, common: np.ndarray) -> Iterator[tuple[int, int, int, bytes]]:
    """(minimiser, first window, number of windows, packed words) of one document with at least `width` words, whose
    words lie at `begin` to `end` in `data`; `common` holds the sorted hashes of common runs."""
    runs = shingles(hashes, MINI)
    rank = runs >> np.uint64(1)
    if len(common):
        often = common[np.minimum(np.searchsorted(common, runs), len(common) - 1)] == runs
        rank |= often.astype(np.uint64) << np.uint64(63)
    low = _sliding_min(rank, width - MINI + 1)
    cut = np.flatnonzero(low[1:] != low[:-1]) + 1
    starts = np.concatenate([[0], cut])
    ends = np.append(cut, len(low))
    left, right = begin[starts].tolist(), end[ends + width - 2].tolist()
    for m, a, n, i, j in zip(low[starts].tolist(), starts.tolist(), (ends - starts).tolist(), left, right, strict=True):
        yield m, a, n, data[i:j]


def common_runs(rows: DataFrame, total: int) -> np.ndarray:
    """Sorted hashes of runs of MINI words that are in at least COMMON of about SAMPLE_ROWS documents."""
    share = F.pmod(F.xxhash64("doc_id", "text"), F.lit(1 << 30)) < int(min(1.0, SAMPLE_ROWS / max(total, 1)) * (1 << 30))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            own = [np.unique(shingles(hashed_words(b" ".join(t.split()))[0], MINI)) for t in utf8(batch.column("text")) if t]
            key, n = np.unique(np.concatenate(own), return_counts=True) if own else (np.zeros(0, np.uint64), np.zeros(0, np.int64))
            yield pa.RecordBatch.from_arrays([pa.array(key.astype(np.int64)), pa.array(n.astype(np.int64))], names=["run", "n"])

    found = rows.where(share).select("text").mapInArrow(run, "run long, n long").groupBy("run").agg(F.sum("n").alias("n")).where(F.col("n") >= COMMON)
    top = found.orderBy(F.desc("n"), "run").limit(MOST_COMMON).toArrow()  # bounded by its limit
    return np.sort(top.column("run").to_numpy().astype(np.uint64))


def _heads(places: list[tuple[int, int, int, int]]) -> bytes:
    """Places as one array for each column."""
    columns = zip(*places, strict=True)
    return b"".join(np.array(c, t).tobytes() for c, (_, t) in zip(columns, _HEAD, strict=True))


def _columns(raw: bytes, n: int) -> dict[str, np.ndarray]:
    out, at = {}, 0
    for name, t in _HEAD:
        out[name] = np.frombuffer(raw, t, n, at).astype(np.int64)
        at += n * np.dtype(t).itemsize
    return out


def _pack(docs: DataFrame, width: int, buckets: int, common: np.ndarray) -> DataFrame:
    """bucket, kind, block: kind 0 holds super-k-mers, kind 1 places that are repeats already."""
    Place = tuple[int, int, int, int]

    def blocks(held: dict[int, dict[bytes, Place]], late: list[Place], turn: int) -> Iterator[tuple[int, int, bytes]]:
        press = zstandard.ZstdCompressor(level=3)
        for bucket, strings in held.items():
            yield bucket, 0, press.compress(len(strings).to_bytes(8, "little") + _heads(list(strings.values())) + b"\n".join(strings))
        if late:
            yield turn % buckets, 1, press.compress(_heads(late))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        turn = 0
        for batch in batches:
            ids, ties, texts = batch.column("doc_id").to_pylist(), batch.column("tie").to_pylist(), [t or b"" for t in utf8(batch.column("text"))]
            for a, b in chunks(texts, PACK_BYTES):
                held: dict[int, dict[bytes, Place]] = {}
                late: list[Place] = []
                own = [(i, b" ".join(texts[i].split())) for i in range(a, b) if ids[i] is not None]
                own = [(i, text, text.count(b" ") + 1) for i, text in own if text.count(b" ") + 1 >= width]
                data = b"\n".join([text for _, text, _ in own])
                hashes, begin, end = hashed_words(data)
                at = 0
                for i, _, size in own:
                    words, doc, tie = slice(at, at + size), ids[i], ties[i]
                    at += size
                    for m, start, n, packed in super_kmers(data, begin[words], end[words], hashes[words], width, common):
                        strings = held.setdefault(m % buckets, {})
                        place, first = (doc, tie, start, n), strings.get(packed)
                        if first is None:
                            strings[packed] = place
                        elif place < first:
                            late.append(first)
                            strings[packed] = place
                        elif place > first:
                            late.append(place)
                turn += 1
                out = list(blocks(held, late, turn))
                for i in range(0, len(out), 64):
                    yield pa.RecordBatch.from_arrays([pa.array([x[k] for x in out[i : i + 64]], t) for k, t in enumerate((pa.int64(), pa.int32(), pa.binary()))], names=["bucket", "kind", "block"])

    return docs.mapInArrow(run, "bucket long, kind int, block binary")


def _hashed(hashes: np.ndarray, at: np.ndarray, width: int) -> np.ndarray:
    """Hash of the `width` words from each position in `at`."""
    every = np.zeros(len(hashes) - width + 1, np.uint64)
    with np.errstate(over="ignore"):
        for i in range(width):
            every = every * np.uint64(0x9E3779B97F4A7C15) + hashes[i : i + len(every)]
    return mix(every[at])


def _same(data: bytes, begin: np.ndarray, end: np.ndarray, at: np.ndarray, lead: np.ndarray) -> bool:
    """Whether the windows at words `at` read like those at `lead`. Runs of neighbouring windows are compared at once."""
    if not len(at):
        return True
    by = np.argsort(at, kind="stable")
    at, lead = at[by], lead[by]
    head = np.append(True, (at[1:] != at[:-1] + 1) | (lead[1:] != lead[:-1] + 1))
    first = np.flatnonzero(head)
    last = np.append(first[1:], len(at)) - 1
    spans = zip(begin[at[first]].tolist(), end[at[last]].tolist(), begin[lead[first]].tolist(), end[lead[last]].tolist(), strict=True)
    return all(data[a:b] == data[c:d] for a, b, c, d in spans)


def marked_windows(heads: dict[str, np.ndarray], data: bytes, width: int, hashed: Callable = hashed_words) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """doc, tie and start of each window of the super-k-mers (strings in `data`, one a line) that also starts earlier,
    and which strings hold the first place of a window."""
    hashes, begin, end = hashed(data)
    n = heads["windows"]
    first = np.cumsum(n + width - 1) - (n + width - 1)
    order = np.lexsort((heads["start"], heads["tie"], heads["doc"]))  # then windows are in the order of their places
    owner = np.repeat(order, n[order])
    nth = np.arange(len(owner)) - np.repeat(np.cumsum(n[order]) - n[order], n[order])
    at = first[owner] + nth
    doc, tie, start = heads["doc"][owner], heads["tie"][owner], heads["start"][owner] + nth
    key = _hashed(hashes, at, width)
    end = end[width - 1 :]  # of the window from each word
    while True:
        by = np.argsort(key, kind="stable")
        new = np.append(True, key[by][1:] != key[by][:-1])[: len(by)]
        lead = by[np.maximum.accumulate(np.where(new, np.arange(len(by)), 0))]
        if _same(data, begin, end, at[by[~new]], at[lead[~new]]):
            break
        known: dict[bytes, int] = {}  # two sequences share a hash: number the sequences themselves
        key = np.array([known.setdefault(data[a:b], len(known)) for a, b in zip(begin[at].tolist(), end[at].tolist(), strict=True)], np.uint64)
    again = (doc[by] != doc[lead]) | (tie[by] != tie[lead]) | (start[by] != start[lead])
    late = by[again]
    return doc[late], tie[late], start[late], np.unique(owner[by[new]])


def _repeats(packed: DataFrame, width: int) -> DataFrame:
    """doc_id, tie, first, last: ranges of words covered by repeated windows, from blocks sorted by bucket."""

    def ranges(doc: np.ndarray, tie: np.ndarray, start: np.ndarray, count: np.ndarray) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(doc), pa.array(tie), pa.array(start), pa.array(start + count + width - 2)], names=["doc_id", "tie", "first", "last"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        open_press = zstandard.ZstdDecompressor()
        heads: list[dict[str, np.ndarray]] = []
        texts: list[bytes] = []
        size, limit, current = 0, SORT_BYTES, None

        def settle(last: bool) -> Iterator[pa.RecordBatch]:
            nonlocal heads, texts, size, limit
            if texts:
                head = {name: np.concatenate([h[name] for h in heads]) for name, _ in _HEAD}
                data = b"\n".join(texts)
                doc, tie, start, firsts = marked_windows(head, data, width)
                if len(doc):
                    by = np.lexsort((start, tie, doc))
                    doc, tie, start = doc[by], tie[by], start[by]
                    at = np.flatnonzero(np.append(True, (doc[1:] != doc[:-1]) | (tie[1:] != tie[:-1]) | (start[1:] > start[:-1] + 1)))
                    ends = np.append(at[1:], len(doc)) - 1
                    yield ranges(doc[at], tie[at], start[at], start[ends] - start[at] + 1)
            if last or not texts:
                heads, texts, size, limit = [], [], 0, SORT_BYTES
            else:  # strings with a first place stay; the next round is as large as these, so all rounds cost twice the bucket
                strings = data.split(b"\n")
                heads, texts = [{name: x[firsts] for name, x in head.items()}], [b"\n".join([strings[i] for i in firsts.tolist()])]
                size = len(texts[0])
                limit = size + max(SORT_BYTES, size)

        for batch in batches:
            for bucket, kind, block in zip(batch.column("bucket").to_pylist(), batch.column("kind").to_pylist(), batch.column("block").to_pylist(), strict=True):
                raw = open_press.decompress(block)
                if kind:
                    late = _columns(raw, len(raw) // _HEAD_BYTES)
                    yield ranges(late["doc"], late["tie"], late["start"], late["windows"])
                    continue
                if bucket != current:
                    yield from settle(True)
                    current = bucket
                elif size + len(raw) > limit:
                    yield from settle(False)
                n = int.from_bytes(raw[:8], "little")
                heads.append(_columns(raw[8 : 8 + n * _HEAD_BYTES], n))
                texts.append(raw[8 + n * _HEAD_BYTES :])
                size += len(raw)
        yield from settle(True)

    return packed.mapInArrow(run, "doc_id long, tie long, first long, last long")


def remove_repeats(docs: DataFrame, width: int = 20, buckets: int | None = None) -> DataFrame:
    """doc_id, n_words, n_removed, kept (the kept words joined by one space) for docs (doc_id, text).

    Words are runs without ASCII white space. Each word that some `width`-word window covers goes if the same window
    also starts earlier: in a document of smaller doc_id, or earlier in the same one. Windows are judged on the input.
    A null, empty or blank text has no words; a text of fewer than `width` words loses none. Rows with a null doc_id
    have no place in the order: they keep all words and remove none elsewhere. Rows that repeat a doc_id with the same
    text are one place, so they stay equal; with different texts they are documents of their own, in the order of a hash
    of the text. Other columns are ignored. doc_id is taken as a long.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    size, total = rows.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0)), F.count("*")).first()
    buckets = buckets or max(16, 3 * size // BUCKET_BYTES)
    own = F.xxhash64(F.coalesce("text", F.lit("")))
    told = rows.groupBy(F.col("doc_id").alias("twice")).agg(F.min(own).alias("a"), F.max(own).alias("b")).where("a <> b AND twice IS NOT NULL").select("twice")
    if told.isEmpty():
        rows = rows.withColumn("tie", F.lit(0).cast("long"))
    else:
        rows = rows.join(written(told, "ss-twice"), F.col("doc_id") == F.col("twice"), "left").select("doc_id", "text", F.when(F.col("twice").isNotNull(), own).otherwise(F.lit(0)).alias("tie"))
    spark = docs.sparkSession
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), buckets // TASK_BUCKETS)
    packed = _pack(rows, width, buckets, common_runs(rows, total)).repartition(parts, "bucket").sortWithinPartitions("bucket")
    found = _repeats(packed, width).groupBy("doc_id", "tie").agg(F.collect_list(F.struct("first", "last")).alias("gone"))
    schema = T.StructType.fromDDL("doc_id long, n_words long, n_removed long, kept binary")

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n_words, n_removed, kept = [], [], []
            for text, gone in zip(utf8(batch.column("text")), batch.column("gone").to_pylist(), strict=True):
                words = (text or b"").split()
                n_words.append(len(words))
                if gone:
                    step = np.zeros(len(words) + 1, np.int64)
                    np.add.at(step, [g["first"] for g in gone], 1)
                    np.add.at(step, np.minimum([g["last"] + 1 for g in gone], len(words)), -1)
                    stay = np.flatnonzero(np.cumsum(step)[:-1] == 0)
                    n_removed.append(len(words) - len(stay))
                    words = [words[i] for i in stay]
                else:
                    n_removed.append(0)
                kept.append(b" ".join(words))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(n_words, pa.int64()), pa.array(n_removed, pa.int64()), pa.array(kept, pa.binary())], names=schema.names)

    return rows.join(found, ["doc_id", "tie"], "left").select("doc_id", "text", "gone").mapInArrow(keep, schema)

