"""Balanced label propagation of documents over shards, with DataFrame functions only.

Documents with equal texts are linked to their group (a star, not all pairs). Groups of more than a `PIECES`-th of a
shard are few, so their shards are planned from their sizes, largest first: a group that fits into what is left of a
shard goes there whole, another fills the emptiest shards one after the other by counted quotas. All other documents
start on the shard their hash gives, in proportion to the room left. In each round a join counts, per group, how many
members each shard has; members elsewhere wish to move to the fullest one. A move from shard i to j is granted within a
quota: as many as wish to move from j to i, plus j's free capacity, of which documents without links may yield a part. A
last step moves single documents, least linked first and planned ones never, until the law `rows` holds exactly: the
counts of any two shards differ by one at most.

All state lies in tables of a few numbers per document; the driver sees counts per shard, pair of shards and planned
group only.
"""

from __future__ import annotations

from heapq import heapify, heappop, heappush

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarry.llm.common import dropped, numbered, written

#: Groups of more than one shard's capacity divided by this are planned; there are fewer than shards * PIECES * 2.
PIECES = 4
#: A group of more than one in so many documents joins by a broadcast, not by a shuffle: no key of a shuffle is hot, and
#: there are fewer than so many such groups.
SPREAD = 8000
#: Documents that one numbering window should hold.
WINDOW_ROWS = 20_000
#: The same for members of one planned group.
GROUP_ROWS = 1000


def _chance(*of: Column) -> Column:
    """A number from 0 to 1 by hash."""
    return F.pmod(F.xxhash64(*of), F.lit(1 << 30)) / float(1 << 30)


def _grid(values: dict[tuple[int, int], float], i: Column, j: Column) -> Column:
    """Look up (i, j) in a table with one entry per pair of shards."""
    made = F.lit(0.0)
    for (a, b), v in sorted(values.items()):
        made = F.when((i == a) & (j == b), F.lit(float(v))).otherwise(made)
    return made


def propagate(docs: DataFrame, shards: int = 8, rounds: int = 4) -> DataFrame:
    """doc_id, size (UTF-8 bytes plus 1), text_crc32, law, shard, slot, grown_shard for docs (doc_id, text).

    Every row is placed: a null text has size 1 and groups with the empty text. Slots are 0, 1, 2, ... within a shard.
    Repeated rows are placed each on its own. The law is `rows` for any input; an empty table gives an empty result.
    Other columns are ignored. A text's group is its two 64-bit hashes and its size. A group stays whole where the
    plan finds a shard with room for it.
    """
    text = F.coalesce("text", F.lit(""))
    own = docs.select("doc_id", (F.octet_length(text) + 1).cast("long").alias("size"), F.crc32(text.cast("binary")).alias("text_crc32"), F.xxhash64(text).alias("h1"), F.xxhash64(F.lit(17), text).alias("h2"), F.monotonically_increasing_id().alias("row"))
    own = written(own, "shard-docs")
    total = own.count()
    want = {s: total // shards + (s < total % shards) for s in range(shards)}
    groups = written(own.groupBy("h1", "h2", "size").agg(F.count("*").alias("members")).where("members > 1"), "shard-groups")
    limit = max(1, total // shards // PIECES)
    large = groups.where(F.col("members") > limit).orderBy(F.desc("members"), "h1", "h2", "size").collect()
    spots, room = planned([r["members"] for r in large], want)
    known = own.sparkSession.createDataFrame([(r["h1"], r["h2"], r["size"], g) for g, r in enumerate(large)], "h1 long, h2 long, size long, g int")
    told = own.select("row", "h1", "h2", "size").join(F.broadcast(known), ["h1", "h2", "size"], "left")  # a few dozen rows
    ranked = numbered(told.where("g IS NOT NULL").select("row", "g"), ["g"], [F.lit(0), F.col("row")], "rank", max(1, max((r["members"] for r in large), default=0) // GROUP_ROWS))
    held = ranked.select("row", F.col("g").cast("long").alias("piece"), _spot(spots).alias("shard"), F.lit(True).alias("held"))
    most = max(2, total // SPREAD)
    named = groups.where(F.col("members") <= limit).select("h1", "h2", "size", F.xxhash64("h1", "h2", "size").alias("piece"), (F.col("members") > most).alias("spread"))
    middle = F.broadcast(named.where("spread").select("h1", "h2", "size", F.col("piece").alias("wide")))  # fewer than SPREAD rows
    spread = told.where("g IS NULL").join(middle, ["h1", "h2", "size"], "left")
    few = spread.where("wide IS NULL").join(named.where("NOT spread").drop("spread"), ["h1", "h2", "size"], "left").select("row", "piece", F.lit(False).alias("spread"))
    rest = spread.where("wide IS NOT NULL").select("row", F.col("wide").alias("piece"), F.lit(True).alias("spread")).unionByName(few)
    state = written(held.withColumn("spread", F.lit(False)).unionByName(rest.select("row", "piece", _start(room).alias("shard"), F.lit(False).alias("held"), "spread")), "shard-state")
    for turn in range(rounds):
        state, settled = _round(state, shards, total, turn)
        if settled:
            break
    state = _settle(state, want, total)
    placed = state.join(own.select("row", "doc_id", "size", "text_crc32"), "row")
    out = numbered(placed, ["shard"], [F.lit(0), F.col("row")], "slot", max(1, total // shards // WINDOW_ROWS))
    return out.select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))


def planned(members: list[int], want: dict[int, int]) -> tuple[list[list[tuple[int, int]]], dict[int, int]]:
    """(shard, members there) of each group, given group sizes and shard capacities, and the room that is left. What is
    largest goes first: into the tightest shard that holds it, or else it fills the emptiest one and the rest waits."""
    room, spots = dict(want), [[] for _ in members]
    queue = [(-n, g) for g, n in enumerate(members)]
    heapify(queue)
    while queue:
        n, g = heappop(queue)
        fits = [s for s in room if room[s] >= -n]
        to = min(fits, key=lambda s: (room[s], s)) if fits else max(room, key=lambda s: (room[s], -s))
        put = min(-n, room[to])
        spots[g].append((to, put))
        room[to] -= put
        if n + put:
            heappush(queue, (n + put, g))
    return spots, room


def _spot(spots: list[list[tuple[int, int]]]) -> Column:
    """Shard of a planned row from its group `g` and its `rank` in it."""
    made = F.lit(0)
    for g, own in enumerate(spots):
        at = 0
        for to, n in own:
            made = F.when((F.col("g") == g) & F.col("rank").between(at, at + n - 1), F.lit(to)).otherwise(made)
            at += n
    return made.cast("int")


def _start(room: dict[int, int]) -> Column:
    """A shard by hash, in proportion to the room left."""
    at, place, made = sum(room.values()), F.pmod(F.xxhash64("row"), F.lit(max(1, sum(room.values())))), F.lit(0)
    for s in sorted(room, reverse=True):
        made = F.when(place < at, F.lit(s)).otherwise(made)
        at -= room[s]
    return made.cast("int")


def _round(state: DataFrame, shards: int, total: int, turn: int) -> tuple[DataFrame, bool]:
    """Members of linked pieces move towards the shard that most of their piece is on, within quotas; and whether nobody
    wished to move. A shard may run over by half its share of unlinked documents, which the last step can move away
    without cutting a link."""
    free = state.where("piece IS NULL").count()
    votes = state.where("piece IS NOT NULL AND NOT held").groupBy("piece", "shard", "spread").agg(F.count("*").alias("n"))
    best = votes.groupBy("piece", "spread").agg(F.max_by("shard", F.struct("n", F.xxhash64("piece", "shard"))).alias("target"))
    columns = ["row", "piece", "shard", "target", "held", "spread"]
    moving = state.where("piece IS NOT NULL AND NOT held")
    few = moving.where("NOT spread").join(best.where("NOT spread").drop("spread"), "piece")
    wide = moving.where("spread").join(F.broadcast(best.where("spread").drop("spread")), "piece")  # fewer than SPREAD rows
    alone = state.where("piece IS NULL OR held").withColumn("target", F.col("shard"))
    wish = written(few.select(columns).unionByName(wide.select(columns)).unionByName(alone.select(columns)), "shard-wish")
    asked = {(r["shard"], r["target"]): r["n"] for r in wish.groupBy("shard", "target").agg(F.count("*").alias("n")).collect()}
    if all(a == b for a, b in asked):
        return dropped(state, wish), True
    load = {s: sum(n for (a, _), n in asked.items() if a == s) for s in range(shards)}
    most = -(-(total + free // 2) // shards)
    room = {s: max(0, most - load[s]) for s in range(shards)}
    share = {}
    for (a, b), n in asked.items():
        if a != b:
            into = sum(m for (x, y), m in asked.items() if y == b and x != b)
            share[a, b] = min(1.0, (asked.get((b, a), 0) + room[b] * n / into) / n)
    granted = _chance(F.col("piece"), F.col("shard"), F.lit(turn)) < _grid(share, F.col("shard"), F.col("target"))
    moved = written(wish.select("row", "piece", F.when((F.col("shard") != F.col("target")) & granted, F.col("target")).otherwise(F.col("shard")).alias("shard"), "held", "spread"), "shard-state")
    return dropped(moved, wish, state), False


def _settle(state: DataFrame, want: dict[int, int], total: int) -> DataFrame:
    """Move the fewest documents so that counts are as wanted: unlinked ones first, then by piece; planned ones, of
    which no shard has more than it should, stay."""
    have = {r["shard"]: r["n"] for r in state.groupBy("shard").agg(F.count("*").alias("n")).collect()}
    shards, over = len(want), {s: have.get(s, 0) - n for s, n in want.items()}
    if not any(over.values()):
        return state
    ranked = numbered(state, ["shard"], [F.col("piece").isNotNull().cast("int") + F.col("held").cast("int"), F.coalesce("piece", "row"), F.col("row")], "rank", max(1, total // shards // WINDOW_ROWS))
    target, queue = F.col("shard"), [[s, -n] for s, n in over.items() if n < 0]
    for s in range(shards):
        left, at = max(0, over[s]), 0
        while left:
            to, need = queue[0]
            n = min(left, need)
            target = F.when((F.col("shard") == s) & F.col("rank").between(at, at + n - 1), F.lit(to)).otherwise(target)
            left, at, queue[0][1] = left - n, at + n, need - n
            if not queue[0][1]:
                queue.pop(0)
    return ranked.select("row", "piece", target.cast("int").alias("shard"))
