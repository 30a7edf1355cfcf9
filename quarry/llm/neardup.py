"""MinHash near-duplicate detection by a signature-coordinate inverted join.

A document's set holds the 64-bit hashes of its distinct word shingles. Equal sets fold into one class. A class has a
signature of `COORDINATES` coordinates; each coordinate joins `ROWS` MinHash values, so two classes of similarity J
agree on one with probability J^ROWS. Classes are posted under each (coordinate, value) pair. Two classes that agree on
at least `MATCHES` coordinates meet under at least one of the first COORDINATES - MATCHES + 1, so postings stop there
(prefix). A pair that meets has its collisions counted coordinate by coordinate from the posting's own on; it is left
as soon as it agreed before, where an earlier posting counts it, or as the rest cannot reach `AGREEING` values (skip).
Pairs above that threshold are confirmed on the full sets.

Postings hold up to a third of all classes, so their pairs are never written out. First a star: each class is paired
with the smallest class it shares a posting with, and the confirmed pairs give components; a posting of near copies is
then connected at the cost of one pair per member. Postings that still hold several components are compared in blocks:
a task holds the signatures of two blocks, counts collisions between classes of different components, and names the
classes that have a partner above the threshold. Only the texts of these travel, once for each pair of blocks they have
a partner in; there common shingles are counted through an inverted index over the full sets, and a spanning forest of
the links comes out, so what comes out grows with the members of a posting and not with their pairs, and no link that a
posting holds is passed over.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.llm.common import WordHasher, dropped, marked, mix, shingles, utf8, written

COORDINATES, ROWS, MATCHES = 32, 4, 2
#: Agreeing MinHash values, of COORDINATES * ROWS, that a pair must have to be confirmed on full sets: 5 standard
#: deviations under the mean at the similarity threshold 0.8.
AGREEING = 80
#: Classes of a posting whose signatures a task compares with as many others at once.
BLOCK = 2048
#: Pairs whose collisions are counted at once.
PAIRS, FEW_PAIRS = 1 << 18, 256
_LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))
_RNG = np.random.RandomState(20240229)
_A = (_RNG.randint(0, 2**31 - 1, COORDINATES * ROWS).astype(np.uint64) * np.uint64(2) + np.uint64(1)).astype(np.uint32)
_B = _RNG.randint(0, 2**32 - 1, COORDINATES * ROWS, dtype=np.uint64).astype(np.uint32)


def shingle_set(text: bytes | None, k: int, hasher: WordHasher) -> np.ndarray:
    """Sorted hashes of the distinct k-word shingles of the A-Z-lowered text; fewer words make one shingle."""
    words = text.translate(_LOWER).split() if text else []
    if not words:
        return np.zeros(0, np.uint64)
    return np.unique(shingles(hasher(words), min(k, len(words))))


def signature(members: np.ndarray) -> np.ndarray:
    """The smallest value of each of COORDINATES * ROWS hash functions over a set that is not empty."""
    x = (members >> np.uint64(32)).astype(np.uint32)
    best = np.full(len(_A), 0xFFFFFFFF, np.uint32)
    with np.errstate(over="ignore"):
        for i in range(0, len(x), 256):
            h = x[i : i + 256, None] * _A
            h += _B
            h ^= h >> np.uint32(15)
            h *= np.uint32(0x2C1B3C6D)
            np.minimum(best, h.min(0), out=best)
    return best


def _classes(docs: DataFrame, k: int) -> DataFrame:
    """id, th (hash of the text), n, h1, h2 (two sums that stand for the set) and sig of each row (id, th, text)."""
    schema = "id long, th long, n long, h1 long, h2 long, sig binary"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = WordHasher()
        for batch in batches:
            texts = utf8(batch.column("text"))
            n, h1, h2, sig = [], [], [], []
            for t in texts:
                s = shingle_set(t, k, hasher)
                n.append(len(s))
                with np.errstate(over="ignore"):
                    h1.append(int(s.sum(dtype=np.uint64).astype(np.int64)))
                    h2.append(int(mix(s).sum(dtype=np.uint64).astype(np.int64)))
                sig.append(signature(s).tobytes() if len(s) else None)
            yield pa.RecordBatch.from_arrays([batch.column("id"), batch.column("th"), pa.array(n, pa.int64()), pa.array(h1, pa.int64()), pa.array(h2, pa.int64()), pa.array(sig, pa.binary())], names=["id", "th", "n", "h1", "h2", "sig"])

    return docs.mapInArrow(run, schema)


def _signatures(column: pa.Array) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.uint32).reshape(-1, COORDINATES, ROWS)


def coordinate_keys(sig: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each coordinate and its value, by class and coordinate."""
    key = np.broadcast_to(np.arange(COORDINATES, dtype=np.uint64), sig.shape[:2]).copy()
    for r in range(ROWS):
        with np.errstate(over="ignore"):
            key = mix(key * np.uint64(0x9E3779B97F4A7C15) + sig[:, :, r])
    return key


def _postings(reps: DataFrame) -> DataFrame:
    """key, id: classes under their coordinates' keys, for the prefix of each signature."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        prefix = COORDINATES - MATCHES + 1
        for batch in batches:
            if not batch.num_rows:
                continue
            key = coordinate_keys(_signatures(batch.column("sig")))[:, :prefix]
            ids = np.repeat(batch.column("id").to_numpy(), prefix)
            yield pa.RecordBatch.from_arrays([pa.array(key.reshape(-1).astype(np.int64)), pa.array(ids)], names=["key", "id"])

    return reps.select("id", "sig").mapInArrow(run, "key long, id long")


def partners(left: np.ndarray, right: np.ndarray, first: int, sizes: tuple[np.ndarray, np.ndarray] | None, percent: int, apart: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Which signatures of `left` have a partner in `right`, and the other way round, all of which agree on coordinate
    `first`. A pair counts here if it agrees on no earlier coordinate, and has AGREEING values and MATCHES coordinates
    in common; `apart` (one row for each of `left`) forbids pairs, and sizes that are too far apart do too."""
    has = np.zeros(len(left), bool), np.zeros(len(right), bool)
    step = max(1, PAIRS // max(len(right), 1))
    for low in range(0, len(left), step):
        rows = left[low : low + step]
        ok = np.ones((len(rows), len(right)), bool) if apart is None else apart[low : low + step].copy()
        if sizes is not None:
            a, b = sizes[0][low : low + step, None], sizes[1][None, :]
            ok &= 100 * np.minimum(a, b) >= percent * np.maximum(a, b)
        i, j = np.nonzero(ok)
        if len(i) <= FEW_PAIRS:  # too few to be worth leaving any early
            same = rows[i] == right[j]
            whole = same.all(2)
            good = (same.sum((1, 2)) >= AGREEING) & (whole.sum(1) >= MATCHES) & ~whole[:, :first].any(1)
            has[0][low + i[good]] = True
            has[1][j[good]] = True
            continue
        values, whole = np.zeros(len(i), np.int16), np.zeros(len(i), np.int16)
        for c in range(COORDINATES):
            same = (rows[i, c] == right[j, c]).sum(1).astype(np.int16)
            values += same
            whole += same == ROWS
            stay = values + ROWS * (COORDINATES - 1 - c) >= AGREEING
            if c < first:
                stay &= same < ROWS
            i, j, values, whole = i[stay], j[stay], values[stay], whole[stay]
            if not len(i):
                break
        good = whole >= MATCHES
        has[0][low + i[good]] = True
        has[1][j[good]] = True
    return has


def _agreeing(pairs: DataFrame, reps: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) whose signatures agree on enough values and coordinates, and whose set sizes allow a link."""
    sigs = reps.select("id", "n", "sig")
    both = pairs.join(sigs.toDF("a", "na", "sa"), "a").join(sigs.toDF("b", "nb", "sb"), "b").where(100 * F.least("na", "nb") >= percent * F.greatest("na", "nb"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            same = _signatures(batch.column("sa")) == _signatures(batch.column("sb"))
            enough = (same.sum((1, 2)) >= AGREEING) & (same.all(2).sum(1) >= MATCHES)
            yield pa.RecordBatch.from_arrays([batch.column("a"), batch.column("b")], names=["a", "b"]).filter(pa.array(enough))

    return both.select("a", "b", "sa", "sb").mapInArrow(run, "a long, b long")


def _confirmed(pairs: DataFrame, texts: DataFrame, reps: DataFrame, k: int, percent: int) -> DataFrame:
    """The pairs whose full sets have 100 * intersection >= percent * union."""
    own = written(_texts_of(texts, pairs.select(F.explode(F.array("a", "b")).alias("id")), reps), "nd-texts")
    both = pairs.join(own.toDF("a", "ta"), "a").join(own.toDF("b", "tb"), "b")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher, last = WordHasher(), (None, None)
        for batch in batches:
            keep = []
            ta, tb = utf8(batch.column("ta")), utf8(batch.column("tb"))
            for a, b in zip(ta, tb, strict=True):
                if last[0] != b:
                    last = (b, shingle_set(b, k, hasher))
                x, y = shingle_set(a, k, hasher), last[1]
                common = len(np.intersect1d(x, y, assume_unique=True))
                keep.append(100 * common >= percent * (len(x) + len(y) - common))
            yield pa.RecordBatch.from_arrays([batch.column("a"), batch.column("b")], names=["a", "b"]).filter(pa.array(keep, pa.bool_()))

    return both.select("a", "b", "ta", "tb").mapInArrow(run, "a long, b long")


def _block_links(k: int, percent: int):  # noqa: ANN202
    """Pairs of components that have a link in one pair of blocks (x, y) of a posting, as a spanning forest."""

    def run(block: pa.Table) -> pa.Table:
        none = pa.table({"a": pa.array([], pa.int64()), "b": pa.array([], pa.int64())})
        comp = block.column("comp").to_numpy()
        if (comp == comp[0]).all():
            return none
        blk, x, y = block.column("blk").to_numpy(), block.column("x")[0].as_py(), block.column("y")[0].as_py()
        hasher = WordHasher()
        sets = [shingle_set(t, k, hasher) for t in utf8(block.column("text").combine_chunks())]
        size = np.array([len(s) for s in sets], np.int64)
        of = np.repeat(np.arange(len(sets)), size)
        shingle = np.unique(np.concatenate(sets), return_inverse=True)[1]
        by = np.argsort(shingle, kind="stable")
        holders, begin = of[by], np.searchsorted(shingle[by], np.arange(shingle.max() + 2))
        ends, own = np.cumsum(size), {}
        for c in comp.tolist():
            own.setdefault(c, c)

        def root(c: int) -> int:
            while own[c] != c:
                own[c] = own[own[c]]
                c = own[c]
            return c

        left, right = [], []
        for i in range(len(sets)):
            if x != y and blk[i] != x:
                continue
            mine = shingle[ends[i] - size[i] : ends[i]]
            lens = begin[mine + 1] - begin[mine]
            stop = np.cumsum(lens)
            met = holders[np.repeat(begin[mine] - (stop - lens), lens) + np.arange(stop[-1])]
            common = np.bincount(met, minlength=len(sets))
            good = (100 * common >= percent * (size + size[i] - common)) & (comp != comp[i])
            if x != y:
                good &= blk == y
            for j in np.flatnonzero(good).tolist():
                a, b = root(int(comp[i])), root(int(comp[j]))
                if a != b:
                    own[max(a, b)] = min(a, b)
                    left.append(min(comp[i], comp[j]))
                    right.append(max(comp[i], comp[j]))
        return pa.table({"a": pa.array(left, pa.int64()), "b": pa.array(right, pa.int64())})

    return run


def _survivors(percent: int):  # noqa: ANN202
    """The rows of a pair of blocks (x, y) of a posting that have a partner of another component."""

    def run(block: pa.Table) -> pa.Table:
        comp = block.column("comp").to_numpy()
        keep = np.zeros(len(comp), bool)
        if (comp != comp[0]).any():
            sig = _signatures(block.column("sig").combine_chunks())
            keys = coordinate_keys(sig[:1])[0].astype(np.int64)
            first = int(np.flatnonzero(keys == block.column("key")[0].as_py())[0])
            size, blk = block.column("n").to_numpy(), block.column("blk").to_numpy()
            x, y = block.column("x")[0].as_py(), block.column("y")[0].as_py()
            a, b = np.flatnonzero(blk == x), np.flatnonzero(blk == y)
            apart = comp[a][:, None] != comp[b][None, :]
            if x == y:
                apart &= np.arange(len(a))[:, None] < np.arange(len(b))[None, :]
            mine, theirs = partners(sig[a], sig[b], first, (size[a], size[b]), percent, apart)
            keep[a[mine]] = True
            keep[b[theirs]] = True
        return block.select(["key", "x", "y", "id", "comp", "blk"]).filter(pa.array(keep))

    return run


def _between(posted: DataFrame, comp: DataFrame, reps: DataFrame, texts: DataFrame, k: int, percent: int) -> DataFrame:
    """Pairs of components with a link that meet in a posting; posted: (key, id), comp: (id, comp)."""
    lab = posted.join(comp, "id", "left").withColumn("comp", F.coalesce("comp", "id"))
    mixed = lab.groupBy("key").agg(F.min("comp").alias("lo"), F.max("comp").alias("hi"), F.count("*").alias("m")).where("lo <> hi")
    sized = mixed.select("key", F.ceil(F.col("m") / BLOCK).cast("int").alias("blocks"))
    live = lab.join(sized, "key").join(reps.select("id", "n", "sig"), "id")
    rows = live.withColumn("blk", F.pmod(F.xxhash64("id"), F.col("blocks")).cast("int"))
    other = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("o")
    dealt = rows.select("key", "id", "comp", "n", "sig", "blk", other).select("key", F.least("blk", "o").alias("x"), F.greatest("blk", "o").alias("y"), "id", "comp", "n", "sig", "blk")
    named = written(dealt.groupBy("key", "x", "y").applyInArrow(_survivors(percent), "key long, x int, y int, id long, comp long, blk int"), "nd-named")
    both = named.join(_texts_of(texts, named.select("id"), reps), "id")
    return both.groupBy("key", "x", "y").applyInArrow(_block_links(k, percent), "a long, b long").distinct()


def _texts_of(texts: DataFrame, ids: DataFrame, reps: DataFrame) -> DataFrame:
    """id, text of the classes in `ids`: the text of the row that stands for a class. Only texts in use travel."""
    used = reps.join(ids.distinct(), "id", "left_semi").select("id", "doc", "th")
    some = marked(texts, "th", used.select("th")).where("_in").select(F.col("id").alias("doc"), "th", "text")
    return some.join(used, ["doc", "th"]).groupBy("id").agg(F.first("text").alias("text"))


def components(edges: DataFrame, rounds: int = 60) -> DataFrame:
    """id, comp: the smallest id reachable over `edges` (a, b). Alternates large-star and small-star steps, in which a
    vertex hands its neighbours to the smallest one; only minima are gathered per vertex, never lists."""
    now = written(edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where("u <> v").distinct(), "cc")
    before = None
    for _ in range(rounds):
        sides = now.select("u", "v").union(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = sides.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = sides.join(low, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()
        down = large.groupBy("u").agg(F.min("v").alias("m"))
        hung = large.join(down, "u")
        small = hung.select(F.col("v").alias("u"), F.col("m").alias("v")).union(down.select("u", F.col("m").alias("v"))).where("u <> v").distinct()
        after = written(small, "cc")
        state = after.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        dropped(after, now)
        now = after
        if state == before:
            break
        before = state
    else:
        raise RuntimeError(f"components did not settle in {rounds} rounds")
    return now.groupBy("u").agg(F.min("v").alias("comp")).withColumnRenamed("u", "id")


def near_duplicates(docs: DataFrame, k: int = 5, percent: int = 80) -> DataFrame:
    """doc_id, n_shingles, component_id, kept, text_hash, first for documents (doc_id, text).

    Documents link where 100 * |intersection| >= percent * |union| of their k-word shingle sets (words: bytes outside
    ASCII white space; A-Z lowered). component_id is the smallest doc_id reachable over links; kept marks that one. A
    document without words (null, empty or blank text) has n_shingles 0, links with nothing and is kept. Equal texts
    always link. A row whose doc_id is null stands alone with a null component_id and is kept. Rows that repeat a
    doc_id are documents of their own, told apart by their texts: `first` marks the rows of the smallest
    (doc_id, text_hash) of each component, text_hash being xxhash64 of the text. Other columns are ignored; an empty
    table gives an empty result.

    Links are found by MinHash: a pair of similarity 0.8 meets under a posted coordinate with probability above
    0.9999999, and has enough values in common with probability above 0.999999; confirmation on full sets makes every
    reported link exact.
    """
    rows = docs.select(F.col("doc_id").alias("id"), F.xxhash64(F.coalesce("text", F.lit(""))).alias("th"), "text")
    sets = written(_classes(rows, k), "nd-sets")
    alike = sets.where("n > 0 AND id IS NOT NULL").groupBy("n", "h1", "h2").agg(F.min(F.struct("id", "th")).alias("r"), F.min_by("sig", F.struct("id", "th")).alias("sig"))
    reps = written(alike.select(F.monotonically_increasing_id().alias("id"), F.col("r.id").alias("doc"), F.col("r.th").alias("th"), "n", "h1", "h2", "sig"), "nd-reps")
    posted = _postings(reps)
    shared = posted.groupBy("key").agg(F.count("*").alias("c"), F.min("id").alias("least")).where("c > 1")
    active = written(posted.join(shared.select("key", "least"), "key"), "nd-post")
    texts = rows.where("id IS NOT NULL")
    # a star from each posting's smallest member; each member takes only its smallest hub
    pairs = active.where("id <> least").groupBy(F.col("id").alias("b")).agg(F.min("least").alias("a"))
    likely = written(_agreeing(pairs, reps, percent), "nd-pairs")
    links = written(_confirmed(likely, texts, reps, k, percent), "nd-links")
    comp = written(components(links), "nd-comp")
    more = written(_between(active.select("key", "id"), comp, reps, texts, k, percent), "nd-links")
    joined = written(components(more), "nd-comp").toDF("c", "to")
    label = reps.join(comp, "id", "left").select("n", "h1", "h2", "doc", "th", F.coalesce("comp", "id").alias("c"))
    label = label.join(joined, "c", "left").select("n", "h1", "h2", "doc", "th", F.coalesce("to", "c").alias("c"))
    least = label.groupBy("c").agg(F.min(F.struct("doc", "th")).alias("least"))
    named = label.join(least, "c").select("n", "h1", "h2", "least")
    out = sets.join(named, ["n", "h1", "h2"], "left")
    grouped = (F.col("n") > 0) & F.col("id").isNotNull()
    component = F.when(grouped, F.col("least.doc")).otherwise(F.col("id"))
    first = F.when(grouped, (F.col("id") == F.col("least.doc")) & (F.col("th") == F.col("least.th"))).otherwise(F.lit(True))
    return out.select(F.col("id").alias("doc_id"), F.col("n").alias("n_shingles"), component.alias("component_id"), F.coalesce(component == F.col("id"), F.lit(True)).alias("kept"), F.col("th").alias("text_hash"), first.alias("first"))
