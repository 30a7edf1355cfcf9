"""Main text of web pages: structure tells what is certainly not text; a suffix array over the pages of a host finds the
boilerplate among the rest, wherever it stands.

A page falls into blocks, each in a zone: article, main part, elsewhere, or chrome (menus, headers, footers, sidebars,
notices, adverts, forms, comments). Scripts, styles and other raw elements give no block. The blocks in articles and
those outside feed two token streams of their host, page after page; the suffix array of a stream, sorted to a depth of
`LONG` tokens, puts repeated substrings side by side, and neighbours from different pages are counted. Any longer
repeated substring is a chain of these. A block of fewer tokens counts as a substring of its own where it is repeated
whole. Pages of equal content are one page, and so are articles of equal content.

A substring is boilerplate outside articles if it is in two pages, and in one of `ONE_IN` of the host's; articles may
share passages, so there it has to be in `ARTICLE_PAGES` articles and half of the host's. A page's text is all its blocks
but chrome, without the tokens of boilerplate inside a block and without blocks that boilerplate covers wholly, across
their borders too; unique runs stay, in articles or not.

Pages travel once, in compressed packs, to units of about `CHUNK_PAGES` pages of one host, dealt by content, so equal
contents meet. What is frequent in a host is as frequent in one of its units at least: units name their candidates, all
units of the host count these, and the sums decide. So the result is that of one array over the whole host, while only
substrings that are frequent somewhere travel, by their 64-bit hash.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass
from html import unescape

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quarry.llm.common import WordHasher, shingles, written

#: Tokens of a long substring; a power of two, as the suffix array doubles its depth.
LONG = 8
#: Pages of a host that one task should hold.
CHUNK_PAGES = 2000
#: Outside articles, a substring has to be in one of so many pages of the host.
ONE_IN = 50
#: Different articles of a host that a substring has to be in, at least, to be boilerplate in articles.
ARTICLE_PAGES = 5
#: Rows of a table by host, and substrings in it, that may be broadcast (about 30 bytes each).
BROADCAST_ROWS, BROADCAST_KEYS = 200_000, 500_000
CHROME, ELSEWHERE, MAIN, ARTICLE = -1, 0, 1, 2
#: Elements by what they mean here.
RAW = frozenset("script style noscript template iframe svg math textarea title object canvas audio video select".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
OUTSIDE = frozenset("nav aside footer form menu dialog button fieldset head".split())
BLOCK = frozenset("address article aside blockquote body br button caption center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol optgroup option p pre search section summary table tbody td tfoot th thead tr ul".split())
#: Words in class, id or role that tell chrome.
CHROME_WORDS = frozenset("ad ads advert adverts advertisement advertising adsense banner breadcrumb breadcrumbs comment comments consent contentinfo cookie cookies disqus footer gdpr header login masthead menu modal nav navbar navigation newsletter notice notices pager pagination popup promo promoted related respond search share sharing sidebar signup skip social sponsor sponsored subscribe subscription toolbar topbar widget widgets complementary alert".split())
_TAG = re.compile(r"""<!--.*?(?:-->|\Z)|<(/?)([a-zA-Z][a-zA-Z0-9:-]*)((?>[^>"']+|"[^"]*"|'[^']*')*+)>|<(/?)([a-zA-Z][a-zA-Z0-9:-]*)([^>]*)>|<[!?/][^>]*>""", re.DOTALL)
_NAMED = re.compile(r"""(?<![\w-])(?:class|id|role|itemprop)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.IGNORECASE)
_WORDS = re.compile(r"[A-Z]?[a-z]+|[A-Z]+|\d+")
_HIDDEN = re.compile(r"""(?<![\w-])hidden(?![\w-])|aria-hidden\s*=\s*["']?true|display\s*:\s*none""", re.IGNORECASE)


def _zone(name: str, attrs: str, zone: int) -> int:
    """Zone of an element inside one of zone `zone`."""
    if zone == CHROME or name in OUTSIDE or (name == "header" and zone != ARTICLE):
        return CHROME
    named = " ".join(a or b or c for a, b, c in _NAMED.findall(attrs)) if attrs else ""
    words = {w.lower() for w in _WORDS.findall(named)}
    if name not in ("body", "html", "main", "article") and (words & CHROME_WORDS or (attrs and _HIDDEN.search(attrs))):
        return CHROME
    if name == "article":
        return CHROME if words & {"comment", "comments", "related", "ad", "promo"} else ARTICLE
    if "articleBody" in named:
        return ARTICLE
    if name == "main" or "main" in named.split():
        return max(zone, MAIN)
    return zone


def blocks(html: str) -> list[tuple[int, str]]:
    """(zone, text) of the blocks of a page in order; white space inside is one blank, and no block is empty."""
    out: list[tuple[int, str]] = []
    open_, zone, held, at, n = [], ELSEWHERE, [], 0, len(html)

    def flush() -> None:
        text = " ".join("".join(held).split())
        if text:
            out.append((zone, text))
        held.clear()

    while at < n:
        m = _TAG.search(html, at)
        text = html[at : m.start() if m else n]
        if text:
            held.append(unescape(text))
        if not m:
            break
        at = m.end()
        name = (m[2] or m[5] or "").lower()
        if not name:
            continue
        closing, attrs = bool(m[1] or m[4]), m[3] or m[6] or ""
        if name in RAW and not closing:
            if not attrs.endswith("/"):
                end = re.compile(rf"</{name}\b[^>]*>", re.IGNORECASE).search(html, at)
                at = end.end() if end else n
            continue
        block = name in BLOCK
        if block:
            flush()
        if name in VOID:
            continue
        if closing:
            for i in range(len(open_) - 1, -1, -1):
                if open_[i][0] == name:
                    flush()
                    zone = open_[i][1]
                    del open_[i:]
                    break
            continue
        if block and open_ and open_[-1][0] == "p":
            flush()
            zone = open_.pop()[1]
        inner = _zone(name, attrs, zone)
        if inner != zone or (block and name != "p"):
            if inner != zone:
                flush()
            open_.append((name, zone))
            zone = inner
    flush()
    return out


def suffix_ranks(ids: np.ndarray, depth: int) -> np.ndarray:
    """Rank of each suffix among all, sorted by its first `depth` tokens (a power of two); equal prefixes share one."""
    rank, k = np.unique(ids, return_inverse=True)[1].astype(np.int64), 1
    while k < depth:
        after = np.full(len(rank), 0, np.int64)
        after[: max(len(rank) - k, 0)] = rank[k:] + 1
        rank = np.unique(rank * (len(rank) + 2) + after, return_inverse=True)[1].astype(np.int64)
        k *= 2
    return rank


@dataclass(frozen=True)
class Stream:
    """The tokens (hashes) of one side of pages, one after another, and where each page begins. Substrings are the
    windows of LONG tokens inside a page, over the borders of its blocks, and then the whole blocks of fewer tokens:
    their page, place, width and key."""

    tokens: np.ndarray
    begin: np.ndarray
    long: int
    page: np.ndarray
    at: np.ndarray
    width: np.ndarray
    key: np.ndarray


Page = tuple[list[int], list[str]]


def stream(pages: list[Page], side: int, hasher: WordHasher) -> Stream:
    """The stream of pages (zones, texts) outside (0) or inside (1) articles."""
    own = [[t.encode("utf-8", "surrogatepass").split() for z, t in zip(*p, strict=True) if (z == ARTICLE) == side] for p in pages]
    lens = np.array([len(b) for p in own for b in p], np.int64)
    tokens = hasher([w for p in own for b in p for w in b])
    of_block = np.repeat(np.arange(len(pages)), [len(p) for p in own])
    start = np.cumsum(lens) - lens
    page = np.repeat(of_block, lens)
    at = np.arange(max(len(tokens) - LONG + 1, 0))
    at = at[page[at] == page[at + LONG - 1]]
    places, widths, keys, owners = [at], [np.full(len(at), LONG)], [shingles(tokens, LONG)[at]], [page[at]]
    for n in range(1, LONG):
        some = lens == n
        if some.any():
            places.append(start[some])
            widths.append(np.full(int(some.sum()), n))
            run = tokens[start[some][:, None] + np.arange(n)].reshape(-1)
            keys.append(shingles(run, n)[::n])
            owners.append(of_block[some])
    return Stream(tokens, np.searchsorted(page, np.arange(len(pages) + 1)), len(at), np.concatenate(owners), np.concatenate(places), np.concatenate(widths), np.concatenate(keys))


def _pages_with(rank: np.ndarray, page: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """A place of each distinct rank, and how many pages have it."""
    order = np.lexsort((page, rank))
    r, o = rank[order], page[order]
    head = np.append(True, r[1:] != r[:-1])[: len(r)]
    fresh = head | np.append(True, o[1:] != o[:-1])[: len(r)]
    at = np.flatnonzero(head)
    return order[at], np.add.reduceat(fresh.astype(np.int64), at) if len(at) else np.zeros(0, np.int64)


def counted(own: Stream) -> tuple[np.ndarray, np.ndarray]:
    """The distinct substrings of a stream by key, and how many pages have each, from its suffix array."""
    n = own.long
    at, many = _pages_with(suffix_ranks(own.tokens, LONG)[own.at[:n]], own.page[:n])
    short, few = _pages_with(own.key[n:], own.page[n:])
    return np.concatenate([own.key[:n][at], own.key[n:][short]]), np.concatenate([many, few])


def among(own: Stream, keys: np.ndarray) -> np.ndarray:
    """Which substrings of a stream have one of the sorted keys."""
    if not len(keys):
        return np.zeros(0, np.int64)
    return np.flatnonzero(keys[np.minimum(np.searchsorted(keys, own.key), len(keys) - 1)] == own.key)


def boilerplate(n: np.ndarray, pages: int, side: int) -> np.ndarray:
    """Which substrings are boilerplate, given how many of a host's distinct pages (articles for side 1) have them."""
    return (n >= ARTICLE_PAGES) & (2 * n >= pages) if side else (n >= 2) & (ONE_IN * n >= pages)


def frequent(n: np.ndarray, pages: int, side: int) -> np.ndarray:
    """Which substrings of a unit could be boilerplate in the host: one that is must be as frequent in some unit."""
    return 2 * n >= pages if side else ONE_IN * n >= pages


def _left(page: Page, covered: list[np.ndarray], hits: list[list[tuple[int, int]]]) -> str:
    """The text of a page without its boilerplate: tokens inside a block that one substring covers, and blocks that
    substrings cover wholly together. Places count from the start of the page's side."""
    out, start, nth = [], [0, 0], [0, 0]
    for z, t in zip(*page, strict=True):
        side, tokens = int(z == ARTICLE), t.split()
        a, b = start[side], start[side] + len(tokens)
        start[side] = b
        drop = np.full(len(tokens), bool(len(covered[side]) and covered[side][a:b].all()))
        own = hits[side]
        while nth[side] < len(own) and own[nth[side]][0] < b:
            at, width = own[nth[side]]
            nth[side] += 1
            if a <= at and at + width <= b:
                drop[at - a : at - a + width] = True
        if z != CHROME:
            out += [t] if not drop.any() else [x for x, d in zip(tokens, drop.tolist(), strict=True) if not d]
    return " ".join(out)


def main_texts(pages: list[Page], gone: list[np.ndarray], hasher: WordHasher) -> list[str]:
    """The texts of pages, given the sorted keys of their host's boilerplate on each side."""
    if not any(len(x) for x in gone):
        return [" ".join(t for z, t in zip(*p, strict=True) if z != CHROME) for p in pages]
    found = []
    for side, keys in enumerate(gone):
        if not len(keys):
            found.append(None)
            continue
        own = stream(pages, side, hasher)
        hit = among(own, keys)
        hit = hit[np.lexsort((own.at[hit], own.page[hit]))]
        step = np.zeros(len(own.tokens) + 1, np.int64)
        np.add.at(step, own.at[hit], 1)
        np.add.at(step, own.at[hit] + own.width[hit], -1)
        edges = np.searchsorted(own.page[hit], np.arange(len(pages) + 1))
        found.append((np.cumsum(step)[:-1] > 0, own.begin.tolist(), edges.tolist(), own.at[hit].tolist(), own.width[hit].tolist()))
    out, nothing = [], np.zeros(0, bool)
    for i, page in enumerate(pages):
        covered, hits = [nothing, nothing], [[], []]
        for side, own in enumerate(found):
            if own is not None:
                cover, begin, edges, at, width = own
                covered[side] = cover[begin[i] : begin[i + 1]]
                hits[side] = [(at[j] - begin[i], width[j]) for j in range(edges[i], edges[i + 1])]
        # chrome goes anyway; a page with nothing else to lose is joined as it is
        plain = not any(hits) or not any(c.any() for c in covered)
        out.append(" ".join(t for z, t in zip(*page, strict=True) if z != CHROME) if plain else _left(page, covered, hits))
    return out


def _pack(table: pa.Table) -> bytes:
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, table.schema) as writer:
        writer.write_table(table)
    return zstandard.compress(sink.getvalue().to_pybytes(), 3)


def _unpack(raw: bytes) -> pa.Table:
    return pa.ipc.open_stream(zstandard.decompress(raw)).read_all()


def _contents(table: pa.Table) -> tuple[dict[bytes, Page], list[bytes]]:
    """The distinct contents of packed rows, and the content of each row."""
    of, held = table.column("whole").to_pylist(), {}
    for whole, zones, texts in zip(of, table.column("zones").to_pylist(), table.column("texts").to_pylist(), strict=True):
        if zones is not None and whole not in held:
            held[whole] = (zones, texts)
    return held, of


def _sides(table: pa.Table, hasher: WordHasher) -> list[tuple[Stream, int]]:
    """For each side, the stream of the distinct pages (articles) of packed rows, and how many these are."""
    held, of = _contents(table)
    articles = dict(zip(table.column("art").to_pylist(), of, strict=True))
    outside = [p for p in held.values() if any(z != ARTICLE for z in p[0])]
    inside = [held[whole] for art, whole in articles.items() if art is not None]
    return [(stream(outside, 0, hasher), len(outside)), (stream(inside, 1, hasher), len(inside))]


def _digest(page: Page) -> bytes:
    return xxhash.xxh3_128_digest("\0".join(f"{z}{t}" for z, t in zip(*page, strict=True)).encode("utf-8", "surrogatepass"))


def _keys(found: list | None, side: int) -> np.ndarray:
    """The sorted keys of one side among collected (side, key) pairs."""
    return np.sort(np.array([g["key"] for g in found or () if g["side"] == side], np.int64).astype(np.uint64))


def bounded(df: DataFrame, most: int, keys: str | None = None) -> DataFrame:
    """`df`, marked for broadcast if it has few rows, and few elements in its array column `keys`."""
    n, held = df.agg(F.count("*"), F.coalesce(F.sum(F.size(keys)), F.lit(0)) if keys else F.lit(0)).first()
    return F.broadcast(df) if n <= most and held <= BROADCAST_KEYS else df


def extract(pages: DataFrame) -> DataFrame:
    """page_id, url, text, n_chars for pages (page_id, url, html).

    White space inside a block is one blank; blocks join in page order by one blank. A null or empty html, or one
    without visible text, has an empty text. A null url counts as a host of its own name. Rows of equal content are
    one page when repetition is counted, and each keeps its text. Markup may be cut off or unbalanced anywhere.
    Other columns are ignored; nothing is dropped or capped.
    """
    spark = pages.sparkSession
    base = pages.select("page_id", "url", "html")
    host = F.lower(F.coalesce(F.regexp_extract("url", r"^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)", 1), F.lit("")))
    named = base.withColumn("home", F.xxhash64(host))
    sizes = written(named.groupBy("home").agg(F.ceil(F.count("*") / CHUNK_PAGES).cast("long").alias("many")).where("many > 1").withColumnRenamed("home", "large"), "html-hosts")
    sized = named.join(bounded(sizes, BROADCAST_ROWS), F.col("home") == F.col("large"), "left").select("page_id", "url", "html", "home", F.coalesce("many", F.lit(1)).alias("many"))
    own_types = base.schema.fields[:2]

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            units: dict[tuple[int, int, int], list[int]] = {}
            homes, many = batch.column("home").to_pylist(), batch.column("many").to_pylist()
            found: list[Page] = []
            for html in batch.column("html").to_pylist():
                own = blocks(html or "")
                found.append(([z for z, _ in own], [t for _, t in own]))
            whole = [_digest(p) for p in found]
            art = [_digest(([z for z in p[0] if z == ARTICLE], [t for z, t in zip(*p, strict=True) if z == ARTICLE])) if ARTICLE in p[0] else None for p in found]
            for i, (home, n) in enumerate(zip(homes, many, strict=True)):
                units.setdefault((home, n, int.from_bytes((art[i] or whole[i])[:8], "little") % n), []).append(i)
            rows = []
            for (home, n, nth), at in units.items():
                seen: set[bytes] = set()
                fresh = [not (whole[i] in seen or seen.add(whole[i])) for i in at]
                take = pa.array(at)
                table = pa.table(
                    {
                        "page_id": batch.column("page_id").take(take),
                        "url": batch.column("url").take(take),
                        "whole": pa.array([whole[i] for i in at], pa.binary()),
                        "art": pa.array([art[i] for i in at], pa.binary()),
                        "zones": pa.array([found[i][0] if f else None for i, f in zip(at, fresh, strict=True)], pa.list_(pa.int8())),
                        "texts": pa.array([found[i][1] if f else None for i, f in zip(at, fresh, strict=True)], pa.list_(pa.string())),
                    }
                )
                rows.append((home, n, nth, _pack(table)))
            yield pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], t) for k, t in enumerate((pa.int64(), pa.int64(), pa.int64(), pa.binary()))], names=["home", "many", "nth", "pack"])

    def gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher, now, packs = WordHasher(), None, []

        def unit() -> pa.RecordBatch:
            table = pa.concat_tables([_unpack(p) for p in packs])
            keys, total = [], []
            for side, (own, n) in enumerate(_sides(table, hasher)):
                key, many = counted(own)
                rule = boilerplate if now[1] == 1 else frequent
                keys += [(side, int(k)) for k in key[rule(many, n, side)].astype(np.int64)]
                total.append(n)
            held = pa.array([[{"side": s, "key": k} for s, k in keys]], pa.list_(pa.struct([("side", pa.int32()), ("key", pa.int64())])))
            return pa.RecordBatch.from_arrays([pa.array([now[0]]), pa.array([now[1]]), *(pa.array([t], pa.int64()) for t in total), pa.array([_pack(table)], pa.binary()), held], names=["home", "many", "outside", "inside", "pack", "keys"])

        for batch in batches:
            for home, n, nth, raw in zip(*(batch.column(c).to_pylist() for c in ("home", "many", "nth", "pack")), strict=True):
                if now is not None and now != (home, n, nth):
                    yield unit()
                    packs.clear()
                now = (home, n, nth)
                packs.append(raw)
        if packs:
            yield unit()

    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    sent = sized.mapInArrow(pack, "home long, many long, nth long, pack binary").repartition(parts, "home", "nth").sortWithinPartitions("home", "nth")
    pair = "array<struct<side: int, key: long>>"
    units = written(sent.mapInArrow(gather, f"home long, many long, outside long, inside long, pack binary, keys {pair}"), "html-units")
    large = units.where("many > 1")
    named_keys = large.select("home", F.explode("keys").alias("k")).distinct()
    asked = written(named_keys.groupBy("home").agg(F.collect_list("k").alias("asked")), "html-asked")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = WordHasher()
        for batch in batches:
            for home, raw, wanted in zip(*(batch.column(c).to_pylist() for c in ("home", "pack", "asked")), strict=True):
                for side, (own, _) in enumerate(_sides(_unpack(raw), hasher)):
                    hit = among(own, _keys(wanted, side))
                    at, n = _pages_with(own.key[hit], own.page[hit])
                    key = own.key[hit][at].astype(np.int64)
                    yield pa.RecordBatch.from_arrays([pa.array(np.full(len(key), home)), pa.array(np.full(len(key), side, np.int32)), pa.array(key), pa.array(n)], names=["home", "side", "key", "n"])

    answers = large.select("home", "pack").join(bounded(asked, BROADCAST_ROWS, "asked"), "home").select("home", "pack", "asked").mapInArrow(count, "home long, side int, key long, n long")
    total = large.groupBy("home").agg(F.sum("outside").alias("outside"), F.sum("inside").alias("inside"))
    summed = answers.groupBy("home", "side", "key").agg(F.sum("n").alias("n")).join(total, "home")
    rule = F.when(F.col("side") == 1, (F.col("n") >= ARTICLE_PAGES) & (2 * F.col("n") >= F.col("inside"))).otherwise((F.col("n") >= 2) & (ONE_IN * F.col("n") >= F.col("outside")))
    decided = written(summed.where(rule).groupBy("home").agg(F.collect_list(F.struct("side", "key")).alias("gone")).withColumnRenamed("home", "large"), "html-gone")
    out = T.StructType([*own_types, T.StructField("text", T.StringType())])

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = WordHasher()
        for batch in batches:
            for raw, gone in zip(batch.column("pack").to_pylist(), batch.column("gone").to_pylist(), strict=True):
                table = _unpack(raw)
                held, of = _contents(table)
                text = dict(zip(held, main_texts(list(held.values()), [_keys(gone, 0), _keys(gone, 1)], hasher), strict=True))
                made = pa.table({"page_id": table.column("page_id"), "url": table.column("url"), "text": pa.array([text[x] for x in of], pa.string())})
                yield from made.combine_chunks().to_batches()

    told = units.join(bounded(decided, BROADCAST_ROWS, "gone"), F.col("home") == F.col("large"), "left")
    gone = F.when(F.col("many") == 1, F.col("keys")).otherwise(F.col("gone"))
    return told.select("pack", gone.alias("gone")).mapInArrow(keep, out).withColumn("n_chars", F.char_length("text").cast("long"))
