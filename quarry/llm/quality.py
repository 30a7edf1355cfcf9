"""Quality rules: counting rules, and perplexity under a modified Kneser-Ney model of byte n-grams.

Texts are read as UTF-8 bytes with A-Z lowered, digits as one and white space as one, so an n-gram of `ORDER` bytes
tells any script's letters apart and packs into one 64-bit key. Spark counts, for each language, in how many documents
each n-gram is, over all documents: the counts grow with the corpus, without a bound or a least count. Lower orders use
continuation counts, each order has the three discounts of modified Kneser-Ney, and probabilities are made by joins.

A document must not vouch for itself. An n-gram of one document alone is never looked up by another, so leaving each
document out of its own judgement comes to leaving these n-grams out of what is looked up: they take part in every count
and discount, and are then scored as unseen. What is left is kept in sorted arrays of keys with log probabilities, one
for each language and order, and looked up by binary search. Where they take more than `MODEL_BYTES`, they are cut into
blocks by the last byte but one of the n-gram, texts pass each block in turn, and the partial sums add up, exactly.

Bands are per language too: the centre is the median of ln(perplexity) over the documents that pass the counting rules,
the widths are multiples of its spread, both taken from exact histograms over all documents.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quarry.llm.common import chunks, mix, utf8, written

ORDER = 6
BLANK = 32
#: Bytes of the arrays that are broadcast at once.
MODEL_BYTES = 256 << 20
#: N-grams that a task adds up before it sends them on, and bytes of text whose n-grams it sorts at once.
HELD_GRAMS, RUN_BYTES = 2_000_000, 1 << 20
#: Bins per unit of ln(perplexity) in the histograms.
BINS = 200
_SYMBOLS = re.compile(r"[#*$%&|<>]")


def _fold() -> np.ndarray:
    out = np.arange(256, dtype=np.uint64)
    out[65:91] += 32
    out[48:58] = 48
    out[[9, 10, 11, 12, 13]] = BLANK
    return out


_FOLD = _fold()


def grams(s: np.ndarray) -> np.ndarray:
    """The n-gram of ORDER bytes that ends at each folded byte but the first ORDER - 1."""
    out = np.zeros(max(len(s) - ORDER + 1, 0), np.uint64)
    for i in range(ORDER):
        out = (out << np.uint64(8)) | s[i : i + len(out)]
    return out


def placed(texts: list[bytes]) -> Iterator[tuple[int, bool, np.ndarray]]:
    """Sorted (n-gram, text) pairs of runs of texts, in one number each: the n-gram in the upper 48 bits, below it the
    text's place in the run; with the place of the first text, and whether the run is only a part of one long text.
    A text starts after blanks."""
    blank = b" " * (ORDER - 1)
    for a, b in chunks(texts, RUN_BYTES):
        if b == a + 1 and len(texts[a]) > RUN_BYTES:
            for i in range(0, len(texts[a]), RUN_BYTES):
                before = texts[a][i - ORDER + 1 : i] if i else blank
                yield a, True, np.sort(grams(_FOLD[np.frombuffer(before + texts[a][i : i + RUN_BYTES], np.uint8)]) << np.uint64(16))
            continue
        for c in range(a, b, 1 << 16):
            own = texts[c : min(b, c + (1 << 16))]
            lens = np.fromiter(map(len, own), np.int64, len(own))
            text = np.repeat(np.arange(len(own)), lens)
            every = grams(_FOLD[np.frombuffer(blank + blank.join(own), np.uint8)])
            yield c, False, np.sort((every[np.arange(len(text)) + text * (ORDER - 1)] << np.uint64(16)) | text.astype(np.uint64))


def _heads(x: np.ndarray) -> np.ndarray:
    """Where a sorted array has a new value."""
    return np.append(True, x[1:] != x[:-1])[: len(x)]


def _summed(keys: list[np.ndarray], counts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct keys with the sums of their counts."""
    key, n = np.concatenate(keys), np.concatenate(counts)
    by = np.argsort(key, kind="stable")
    key, n = key[by], n[by]
    at = np.flatnonzero(np.append(True, key[1:] != key[:-1])[: len(key)])
    return key[at], np.add.reduceat(n, at) if len(at) else n


def _packed(key: np.ndarray, n: np.ndarray) -> bytes:
    """Sorted keys as differences, and their counts."""
    return zstandard.compress(np.diff(key, prepend=np.uint64(0)).tobytes() + n.astype("<u4").tobytes(), 3)


def _unpacked(raw: bytes) -> tuple[np.ndarray, np.ndarray]:
    data = zstandard.decompress(raw)
    n = len(data) // 12
    return np.cumsum(np.frombuffer(data, np.uint64, n)), np.frombuffer(data, "<u4", n, 8 * n).astype(np.int64)


def count(docs: DataFrame) -> DataFrame:
    """lang, key, n: in how many texts of docs (lang, text) each n-gram is. Tasks add up their rows, send sorted keys in
    packs to the bucket of the key's hash, and buckets add up packs as they come."""
    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))

    def tally(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, list[tuple[np.ndarray, np.ndarray]]] = {}
        size = 0

        def flush() -> Iterator[pa.RecordBatch]:
            rows = []
            for lang, found in held.items():
                key, n = _summed([k for k, _ in found], [c for _, c in found])
                bucket = (mix(key) % np.uint64(parts)).astype(np.int64)
                by = np.argsort(bucket, kind="stable")
                edges = np.searchsorted(bucket[by], np.arange(parts + 1)).tolist()
                for i, (a, b) in enumerate(zip(edges[:-1], edges[1:], strict=True)):
                    if b > a:
                        rows.append((lang, i, _packed(key[by[a:b]], n[by[a:b]])))
            held.clear()
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], t) for k, t in enumerate((pa.string(), pa.int32(), pa.binary()))], names=["lang", "bucket", "pack"])

        for batch in batches:
            texts = utf8(batch.column("text"))
            langs = batch.column("lang").to_pylist()
            for lang in sorted(set(langs)):
                own = [t for t, of in zip(texts, langs, strict=True) if of == lang and t]
                long: dict[int, np.ndarray] = {}
                for at, part, pairs in placed(own):
                    key = pairs[_heads(pairs)] >> np.uint64(16)
                    if part:  # a long text counts each n-gram once over all its parts
                        both = np.sort(np.concatenate([long.get(at, key[:0]), key]))
                        long[at] = both[_heads(both)]
                        continue
                    first = np.flatnonzero(_heads(key))
                    held.setdefault(lang, []).append((key[first], np.diff(np.append(first, len(key)))))
                    size += len(first)
                    if size > HELD_GRAMS:
                        held = {k: [_summed([x for x, _ in v], [c for _, c in v])] for k, v in held.items()}
                        size = sum(len(v[0][0]) for v in held.values())
                        if size > HELD_GRAMS // 2:
                            yield from flush()
                            size = 0
                for key in long.values():
                    held.setdefault(lang, []).append((key, np.ones(len(key), np.int64)))
        yield from flush()

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, keys, counts, size, limit = None, [], [], 0, HELD_GRAMS

        def out() -> Iterator[pa.RecordBatch]:
            key, n = _summed(keys, counts)
            yield pa.RecordBatch.from_arrays([pa.array([current[0]] * len(key), pa.string()), pa.array(key.astype(np.int64)), pa.array(n)], names=["lang", "key", "n"])

        for batch in batches:
            for lang, bucket, raw in zip(*(batch.column(c).to_pylist() for c in ("lang", "bucket", "pack")), strict=True):
                if current is not None and current != (lang, bucket):
                    yield from out()
                    keys, counts, size, limit = [], [], 0, HELD_GRAMS
                current = (lang, bucket)
                key, n = _unpacked(raw)
                keys.append(key)
                counts.append(n)
                size += len(key)
                if size > limit:
                    key, n = _summed(keys, counts)
                    keys, counts, size, limit = [key], [n], len(key), len(key) + HELD_GRAMS
        if current is not None:
            yield from out()

    sent = docs.select("lang", "text").mapInArrow(tally, "lang string, bucket int, pack binary")
    return sent.repartition(parts, "lang", "bucket").sortWithinPartitions("lang", "bucket").mapInArrow(merge, "lang string, key long, n long")


def discounts(n1: int, n2: int, n3: int, n4: int) -> tuple[float, float, float]:
    """Of modified Kneser-Ney for counts 1, 2, 3 and more, from how many n-grams have counts 1 to 4."""
    c1, c2, c3, c4 = (max(n, 1) for n in (n1, n2, n3, n4))
    y = c1 / (c1 + 2 * c2)
    own = (1 - 2 * y * c2 / c1, 2 - 3 * y * c3 / c2, 3 - 4 * y * c4 / c3)
    return tuple(min(max(d, 0.05), i + 0.95) for i, d in enumerate(own))


def estimate(counted: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Modified Kneser-Ney from (lang, key, n): entries (lang, k, key, p, single) of the n-grams of each order k, and
    contexts (lang, k, key, gamma, single), whose key is the n-gram without its last byte. `single` marks what surely
    comes from one document alone."""
    spark = counted.sparkSession
    levels = {ORDER: written(counted.withColumn("single", F.col("n") == 1), "lm-count")}
    for k in range(ORDER - 1, 0, -1):  # continuation counts: how many bytes precede the shorter n-gram
        shorter = F.col("key").bitwiseAND((1 << (8 * k)) - 1)
        lower = levels[k + 1].groupBy("lang", shorter.alias("key")).agg(F.count("*").alias("n"), F.every("single").alias("single"))
        levels[k] = written(lower.withColumn("single", F.col("single") & (F.col("n") == 1)), "lm-count")
    entries, contexts, below = [], [], None
    for k in range(1, ORDER + 1):
        of = levels[k].groupBy("lang").agg(*[F.count_if(F.col("n") == i).alias(f"n{i}") for i in (1, 2, 3, 4)]).collect()  # a row a language
        cut = F.broadcast(spark.createDataFrame([(r["lang"], *discounts(r["n1"], r["n2"], r["n3"], r["n4"])) for r in of], "lang string, d1 double, d2 double, d3 double"))
        own = levels[k].join(cut, "lang").withColumn("d", F.when(F.col("n") == 1, F.col("d1")).when(F.col("n") == 2, F.col("d2")).otherwise(F.col("d3")))
        own = own.select("lang", "key", "n", "d", "single", F.shiftrightunsigned("key", 8).alias("h"))
        at = own.groupBy("lang", "h").agg((F.sum("d") / F.sum("n")).alias("gamma"), F.sum("n").alias("total"), (F.every("single") & (F.count("*") == 1)).alias("alone"))
        at = written(at, "lm-context")
        joined = own.join(at, ["lang", "h"])
        if below is None:
            low = joined.withColumn("low", F.lit(1 / 256))
        else:
            shorter = F.col("key").bitwiseAND((1 << (8 * (k - 1))) - 1)
            low = joined.withColumn("short", shorter).join(below.select("lang", F.col("key").alias("short"), F.col("p").alias("low")), ["lang", "short"])
        p = (F.col("n") - F.col("d")) / F.col("total") + F.col("gamma") * F.col("low")
        below = written(low.select("lang", "key", p.alias("p"), "single"), "lm-entry")
        entries.append(below.select("lang", F.lit(k).alias("k"), "key", "p", "single"))
        contexts.append(at.select("lang", F.lit(k).alias("k"), F.col("h").alias("key"), "gamma", F.col("alone").alias("single")))
    return reduce(DataFrame.unionByName, entries), reduce(DataFrame.unionByName, contexts)


#: Sorted keys with log2 values, by language and order.
Arrays = dict[tuple[str, int], tuple[np.ndarray, np.ndarray]]


@dataclass(frozen=True)
class NgramModel:
    """One block of a model: n-grams with log2 probabilities, contexts with log2 back-off weights, of all languages."""

    languages: tuple[str, ...]
    entries: Arrays
    contexts: Arrays

    def bits(self, lang: str, keys: np.ndarray) -> np.ndarray:
        """Code length of the last byte of each n-gram of ORDER bytes after the others: from the longest order that has
        it, with the weights of the contexts passed on the way down."""
        out = np.zeros(len(keys))
        todo = np.arange(len(keys))
        for k in range(ORDER, 0, -1):
            own = keys[todo] & np.uint64((1 << (8 * k)) - 1)
            hit, value = _find(self.entries.get((lang, k)), own)
            out[todo] -= value
            todo, own = todo[~hit], own[~hit]
            out[todo] -= _find(self.contexts.get((lang, k)), own >> np.uint64(8))[1]
        out[todo] += 8
        return out


def _find(table: tuple[np.ndarray, np.ndarray] | None, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Whether a sorted array has each key, and its value, 0 where it has not."""
    if table is None or not len(table[0]):
        return np.zeros(len(keys), bool), np.zeros(len(keys))
    at = np.minimum(np.searchsorted(table[0], keys), len(table[0]) - 1)
    hit = table[0][at] == keys
    return hit, np.where(hit, table[1][at], 0.0)


def _arrays(rows: DataFrame, value: str) -> Arrays:
    """Collect (lang, k, key, value) as sorted arrays."""
    table = rows.select("lang", "k", "key", F.log2(value).cast("float").alias("v")).toArrow()
    named = table.column("lang").combine_chunks().dictionary_encode()
    lang, k = named.indices.to_numpy(), table.column("k").to_numpy()
    key, v = table.column("key").to_numpy().view(np.uint64), table.column("v").to_numpy()
    out = {}
    for i, one in enumerate(named.dictionary.to_pylist()):
        for order in range(1, ORDER + 1):
            own = np.flatnonzero((lang == i) & (k == order))
            by = own[np.argsort(key[own])]
            out[one, order] = key[by], v[by]
    return out


def blocks(entries: DataFrame, contexts: DataFrame, most: int) -> Iterator[tuple[int, int, NgramModel]]:
    """(block, number of blocks, model) with arrays of about `most` bytes each. A block has the n-grams whose last byte
    but one is its own, and the contexts that end with such a byte; what has no such byte is in every block."""
    seen, ways = entries.where("NOT single"), contexts.where("NOT single")
    sizes = seen.groupBy("lang").agg(F.count("*").alias("n")).collect(), ways.groupBy("lang").agg(F.count("*").alias("n")).collect()
    languages = tuple(sorted({r["lang"] for rows in sizes for r in rows}))
    many = min(256, max(1, -(-12 * sum(r["n"] for rows in sizes for r in rows) // most)))
    for block in range(many):
        last = lambda key: F.pmod(key.bitwiseAND(255), F.lit(many)) == block  # noqa: B023, E731
        own = seen.where((F.col("k") == 1) | last(F.shiftrightunsigned("key", 8)))
        yield block, many, NgramModel(languages, _arrays(own, "p"), _arrays(ways.where((F.col("k") == 1) | last(F.col("key"))), "gamma"))


def text_bits(model: NgramModel, texts: list[bytes], block: int = 0, many: int = 1) -> np.ndarray:
    """Bits of each text (rows) in each language (columns) over the n-grams of a block. Each distinct n-gram of a run of
    texts is looked up once."""
    out = np.zeros((len(texts), len(model.languages)))
    for at, part, pairs in placed(texts):
        key = pairs >> np.uint64(16)
        head = _heads(key)
        each, which = key[head], np.cumsum(head) - 1
        text = (pairs & np.uint64(0xFFFF)).astype(np.int64)
        here = (each >> np.uint64(8)) & np.uint64(255)
        mine = np.flatnonzero(here % np.uint64(many) == block)
        for j, lang in enumerate(model.languages):
            cost = np.zeros(len(each))
            cost[mine] = model.bits(lang, each[mine])
            bits = np.bincount(text, cost[which])
            out[at : at + len(bits), j] += bits
    return out


def rules(text: str | None) -> tuple[int, int, int, int, int]:
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words of one text; see the contract in `judged`."""
    if not text:
        return 0, 0, 0, 0, 0
    words = text.encode("utf-8", "surrogatepass").split()
    n = len(words)
    if not n:
        return 0, 0, len(_SYMBOLS.findall(text)), 0, 0
    spaces = sum(map(text.count, " \t\n\r\x0b\x0c"))
    lines = [x for x in text.split("\n") if x.strip(" \t\r\x0b\x0c")] if "\n" in text else []
    known: dict[bytes, int] = {}
    ids = np.fromiter((known.setdefault(w, len(known)) for w in words), np.int64, n)
    repeated = 0
    if n > 3:
        v = len(known)
        pair = ids[:-2] * v + ids[1:-1]
        if v < 2_000_000:
            window = pair * v + ids[2:]
        else:
            window = np.unique(pair, return_inverse=True)[1] * v + ids[2:]
        by = np.argsort(window, kind="stable")
        same = window[by[1:]] == window[by[:-1]]
        hit = np.zeros(len(window) + 2, bool)
        hit[by[1:][same]] = True
        hit[by[:-1][same]] = True
        covered = hit.copy()
        covered[1:] |= hit[:-1]
        covered[2:] |= hit[:-2]
        repeated = int(covered.sum())
    return n, len(text) - spaces, len(_SYMBOLS.findall(text)), len(lines) - len(set(lines)), repeated


def _bands(scored: DataFrame, wide: float, least: float) -> dict[str, tuple[float, float]]:
    """Lowest and highest ln(perplexity) kept, by language. Collects one row per language and bin, which are bounded:
    ln(perplexity) lies between 0 and 28."""
    found = scored.where("NOT base_failed AND ln_ppl IS NOT NULL").groupBy("lang", F.floor(F.col("ln_ppl") * BINS).alias("bin")).agg(F.count("*").alias("n")).collect()
    out = {}
    for lang in {r["lang"] for r in found}:
        own = sorted((r["bin"], r["n"]) for r in found if r["lang"] == lang)
        bins, n = (np.array(x, np.float64) for x in zip(*own, strict=True))

        def middle(x: np.ndarray, n: np.ndarray = n) -> float:
            by = np.argsort(x, kind="stable")
            return float(x[by][np.searchsorted(np.cumsum(n[by]), n.sum() / 2)])

        centre = middle(bins)
        half = max(least, wide * 1.4826 * (middle(np.abs(bins - centre)) + 0.5) / BINS)
        out[lang] = ((centre + 0.5) / BINS - half, (centre + 0.5) / BINS + half)
    return out


def judged(docs: DataFrame, wide: float = 6.0, least: float = 0.05, min_words: int = 50, repeat_percent: int = 50) -> DataFrame:
    """doc_id, lang, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, perplexity, base_failed, kept for
    docs (doc_id, text, lang).

    base_failed: fewer than `min_words` words, or more than `repeat_percent` % of the words in repeated 3-word windows.
    lang: the learned language under which the text has the lowest perplexity, so that a wrong label harms no document.
    kept: not base_failed, and the perplexity per byte within that language's band: median of ln(perplexity) plus and
    minus `wide` spreads (1.4826 * median absolute deviation), `least` at least. Rows with a null label teach a model
    of their own; every label has its own model and band, however many there are. A null or empty text has all
    counts 0, a null perplexity, and fails. Repeated rows count as often as they occur, and get equal results. Other
    columns are ignored.
    """
    spark = docs.sparkSession
    rows = docs.select("doc_id", "text", F.coalesce("lang", F.lit("")).alias("lang"), F.xxhash64("text").alias("h1"), F.xxhash64(F.lit(17), "text").alias("h2"))
    entries, contexts = estimate(count(rows))
    first = T.StructType([rows.schema["doc_id"], *T.StructType.fromDDL("h1 long, h2 long, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, n_bytes long, bits array<double>").fields])
    table, languages = None, ()
    for block, many, model in blocks(entries, contexts, MODEL_BYTES):
        shared, languages = spark.sparkContext.broadcast(model), model.languages

        def run(batches: Iterator[pa.RecordBatch], shared=shared, block: int = block, many: int = many) -> Iterator[pa.RecordBatch]:  # noqa: ANN001
            for batch in batches:
                raws = [t or b"" for t in utf8(batch.column("text"))]
                bits = text_bits(shared.value, raws, block, many)
                scores = pa.array(list(bits), pa.list_(pa.float64()))
                own = [batch.column("h1"), batch.column("h2")]
                if block:
                    yield pa.RecordBatch.from_arrays([*own, scores], names=["h1", "h2", "bits"])
                    continue
                found = [rules(text) for text in batch.column("text").to_pylist()]
                columns = [pa.array(c, pa.int64()) for c in zip(*found, strict=True)] or [pa.array([], pa.int64())] * 5
                yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *own, *columns, pa.array([len(t) for t in raws], pa.int64()), scores], names=first.names)

        if block == 0:
            table = written(rows.mapInArrow(run, first), "quality")
        else:  # texts are known by their hashes from here on; equal ones have equal sums
            more = rows.mapInArrow(run, "h1 long, h2 long, bits array<double>").groupBy("h1", "h2").agg(F.first("bits").alias("more"))
            table = written(table.join(more, ["h1", "h2"]).withColumn("bits", F.zip_with("bits", "more", lambda a, b: a + b)).select(first.names), "quality")
    best = F.array_min("bits")
    names = F.array(*[F.lit(x) for x in languages]) if languages else F.array().cast("array<string>")
    said = F.when((F.col("n_bytes") > 0) & (F.size("bits") > 0), F.element_at(names, F.array_position("bits", best).cast("int")))
    table = table.withColumn("lang", said).withColumn("ln_ppl", F.when(F.col("lang").isNotNull(), best / F.col("n_bytes") * math.log(2)))
    failed = (F.col("n_words") < min_words) | (100 * F.col("n_repeat_words") > repeat_percent * F.col("n_words"))
    scored = table.withColumn("base_failed", failed)
    bands = _bands(scored, wide, least)
    fits = F.lit(False)
    for lang, (low, high) in sorted(bands.items()):
        fits = fits | ((F.col("lang") == lang) & F.col("ln_ppl").between(low, high))
    return scored.select("doc_id", "lang", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", F.exp("ln_ppl").alias("perplexity"), "base_failed", (~F.col("base_failed") & F.coalesce(fits, F.lit(False))).alias("kept"))
