"""Language identification by prediction by partial matching (PPM).

Fitting counts, per language, which bytes follow each context of up to `order` bytes in a bounded sample of labelled
rows. The contexts that occur most often in any language form one trie, closed under dropping a byte at either end; a
context of the trie is a state, and the state after a byte is the longest context that ends there. The statistics are
then frozen: for each state, byte and language the exact PPM code length (escape method C, no exclusion, down through
shorter contexts to a uniform byte) is a table entry. A text's cost in a language is the sum of the entries along its
states; the cheapest language wins.

The model has at most `max_states` states whatever the corpus, so its broadcast is bounded by
max_states * symbols * (languages + 1) * 4 bytes, and `fit` lowers the number of states to stay under `MODEL_BYTES`.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from quarry.llm.common import chunks, utf8, without

UNDETERMINED = "und"
#: Bound of the broadcast tables.
MODEL_BYTES = 48 << 20
#: Bounds of the sample that a model is fitted on.
MOST_LANGUAGES, MOST_ROWS = 64, 4000
#: Bytes in one scoring lane; a long text is scored as several lanes that overlap by the order.
LANE = 1024
_LETTER = re.compile(r"[^\W\d_]")


@dataclass(frozen=True)
class PpmModel:
    """languages; order; symbol of each byte; next state and code lengths by state * symbols + symbol."""

    languages: tuple[str, ...]
    order: int
    symbol: np.ndarray
    step: np.ndarray
    cost: np.ndarray

    @property
    def symbols(self) -> int:
        return int(self.symbol.max()) + 1


def sample(docs: DataFrame, rows_per_language: int, text: str = "text", label: str = "lang", key: str = "doc_id") -> list[tuple[str, bytes]]:
    """At most `rows_per_language` whole labelled texts of each of the `MOST_LANGUAGES` most frequent languages, and
    `MOST_ROWS` in all, chosen by a hash of the key. The thinning by hash happens before the shuffle, so what moves is
    bounded too."""
    rows = docs.where(F.col(label).isNotNull() & F.col(text).isNotNull()).select(F.col(label).alias("l"), F.col(text).alias("t"), F.xxhash64(F.col(key)).alias("h"))
    counts = {r["l"]: r["n"] for r in rows.groupBy("l").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "l").limit(MOST_LANGUAGES).collect()}
    if not counts:
        return []
    rows_per_language = max(1, min(rows_per_language, MOST_ROWS // len(counts)))
    top = 1 << 30
    share = F.create_map(*[x for k, n in sorted(counts.items()) for x in (F.lit(k), F.lit(min(top, int(top * 2 * rows_per_language / n) + 1)))])
    some = rows.where(F.pmod("h", F.lit(top)) < share[F.col("l")])
    ranked = some.withColumn("r", F.row_number().over(Window.partitionBy("l").orderBy("h", "t")))
    return sorted((r["l"], r["t"].encode()) for r in ranked.where(F.col("r") <= rows_per_language).select("l", "t").collect())


def _grams(data: np.ndarray, k: int) -> np.ndarray:
    """All runs of k bytes as integers, the last byte lowest."""
    out = np.zeros(max(len(data) - k + 1, 0), np.uint64)
    for i in range(k):
        out = (out << np.uint64(8)) | data[i : i + len(out)].astype(np.uint64)
    return out


def fit(labelled: list[tuple[str, bytes]], order: int = 4, max_states: int = 6000) -> PpmModel:
    """Freeze the statistics of the labelled texts. Without any text the model knows no language."""
    languages = tuple(sorted({label for label, _ in labelled}))
    streams = [np.frombuffer(b"\n" + b"\n".join(t for label, t in labelled if label == lang), np.uint8) for lang in languages]
    seen = np.unique(np.concatenate(streams)) if streams else np.zeros(0, np.uint8)
    symbol = np.full(256, len(seen), np.int32)
    symbol[seen] = np.arange(len(seen))
    wide = len(seen) + 1
    most = max(1, min(max_states, MODEL_BYTES // (4 * wide * (len(languages) + 1))))
    followed = []  # per order and language: context + next byte, and how often
    contexts: list[dict[int, int]] = []
    for k in range(order + 1):
        per = [np.unique(_grams(s, k + 1), return_counts=True) for s in streams]
        followed.append(per)
        total: dict[int, int] = {}
        for grams, n in per:
            ctx, at = np.unique(grams >> np.uint64(8), return_index=True)
            for c, x in zip(ctx.tolist(), np.add.reduceat(n, at).tolist() if len(at) else [], strict=True):
                total[c] = total.get(c, 0) + x
        contexts.append(total)
    counts = np.sort(np.array([n for k in range(1, order + 1) for n in contexts[k].values()], np.int64))[::-1]
    least = int(counts[most - 1]) + 1 if len(counts) >= most else 1
    state: dict[tuple[int, int], int] = {(0, 0): 0}
    for k in range(1, order + 1):
        for c in sorted(c for c, n in contexts[k].items() if n >= least):
            state[k, c] = len(state)
    size, count = len(state), len(languages)
    cost = np.zeros((size, wide, count), np.float32)
    step = np.zeros((size, wide), np.int32)
    shorter = np.zeros(size, np.int64)
    for (k, c), s in state.items():
        shorter[s] = state[k - 1, c & ((1 << (8 * (k - 1))) - 1)] if k else 0
    cost[0] = 8.0  # beyond the empty context: a uniform byte, plus the escape added below
    by_order = [np.array([s for (j, _), s in state.items() if j == k], np.int64) for k in range(order + 1)]
    keys = [np.array([c for (j, c) in state if j == k], np.uint64) for k in range(order + 1)]
    for k in range(order + 1):
        if not len(by_order[k]):
            continue
        own = by_order[k]
        base = cost[shorter[own]] if k else cost[own]
        for lang in range(count):
            grams, n = followed[k][lang]
            ctx = grams >> np.uint64(8)
            at = np.searchsorted(keys[k], ctx)
            ok = (at < len(keys[k])) & (keys[k][np.minimum(at, len(keys[k]) - 1)] == ctx)
            table = np.zeros((len(own), wide), np.float64)
            table[at[ok], symbol[(grams[ok] & np.uint64(255)).astype(np.int64)]] = n[ok]
            total, kinds = table.sum(1), (table > 0).sum(1)
            with np.errstate(divide="ignore", invalid="ignore"):
                hit = np.log2((total + kinds)[:, None] / table)
                escape = np.where(total > 0, np.log2((total + kinds) / np.maximum(kinds, 1)), 0.0)
            base[:, :, lang] = np.where(table > 0, hit, base[:, :, lang] + escape[:, None])
        cost[own] = base
    for (k, c), s in state.items():
        for b in range(wide - 1):
            longer = (c << 8) | int(seen[b])
            j = min(k + 1, order)
            longer &= (1 << (8 * j)) - 1
            while (j, longer) not in state:
                j -= 1
                longer &= (1 << (8 * j)) - 1
            step[s, b] = state[j, longer]
    return PpmModel(languages, order, symbol, step.reshape(-1), cost.reshape(size * wide, count))


def code_lengths(model: PpmModel, texts: list[bytes]) -> np.ndarray:
    """Bits of each text (rows) in each language (columns), exactly as if each were coded alone from its start."""
    out = np.zeros((len(texts), len(model.languages)))
    lens = np.array([len(t) for t in texts], np.int64)
    if not lens.sum() or not model.languages:
        return out
    data = model.symbol[np.frombuffer(b"".join(texts), np.uint8)]
    begin = np.cumsum(lens) - lens
    lanes = -(-lens // LANE)
    doc = np.repeat(np.arange(len(texts)), lanes)
    nth = np.arange(lanes.sum()) - np.repeat(np.cumsum(lanes) - lanes, lanes)
    skip = np.where(nth > 0, model.order, 0)
    start = begin[doc] + nth * LANE - skip
    length = np.minimum(lens[doc] - nth * LANE, LANE) + skip
    by = np.argsort(-length, kind="stable")
    doc, skip, start, length = doc[by], skip[by], start[by], length[by]
    longest, wide = int(length[0]), model.symbols
    active = np.searchsorted(-length, -np.arange(longest), side="left")
    state = np.zeros(len(doc), np.int64)
    total = np.zeros((len(doc), len(model.languages)), np.float64)
    for t in range(longest):
        n = active[t]
        at = state[:n] * wide + data[start[:n] + t]
        bits = np.take(model.cost, at, axis=0)
        if t < model.order:
            bits = np.where((skip[:n] > t)[:, None], np.float32(0), bits)
        total[:n] += bits
        state[:n] = model.step[at]
    for lang in range(out.shape[1]):
        out[:, lang] = np.bincount(doc, total[:, lang], len(texts))
    return out


def predict(docs: DataFrame, model: PpmModel, text: str = "text") -> DataFrame:
    """Adds lang_pred (a learned language, or `und` for a null text or one without a letter), score (0 to 1: weight of
    the cheapest language among all, over at most 64 bytes' worth of evidence) and bits_per_byte (its code length).

    Columns of these names in `docs` are replaced. An empty text is `und` with score 0. Ties go to the language that
    sorts first. Each row is judged alone, so repeated rows get equal results; any text length is scored whole.
    """
    base = without(docs, "lang_pred", "score", "bits_per_byte")
    schema = T.StructType([*base.schema.fields, T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType()), T.StructField("bits_per_byte", T.DoubleType())])
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ppm = shared.value
        for batch in batches:
            raw = utf8(batch.column(text))
            texts = [t or b"" for t in raw]
            langs, scores, rates = [], [], []
            for a, b in chunks(texts):
                bits = code_lengths(ppm, texts[a:b])
                for i in range(a, b):
                    n, own = len(texts[i]), bits[i - a]
                    if not n or not len(own) or not _LETTER.search(texts[i].decode("utf-8", "replace")):
                        langs.append(UNDETERMINED)
                        scores.append(0.0)
                        rates.append(float(own.min() / n) if n and len(own) else None)
                        continue
                    best = int(np.argmin(own))
                    odds = np.exp2(-np.minimum((own - own[best]) * min(1.0, 64.0 / n), 1000))
                    langs.append(ppm.languages[best])
                    scores.append(float(1 / odds.sum()))
                    rates.append(float(own[best] / n))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(langs, pa.string()), pa.array(scores, pa.float64()), pa.array(rates, pa.float64())], names=schema.names)

    return base.mapInArrow(score, schema)
