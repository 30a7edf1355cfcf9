"""Benchmark decontamination by a prefix-filtered set join, with DataFrame functions only.

An item's windows are `size` consecutive words, or the whole item where it has fewer. A window's shingles are its pairs
of neighbouring words (its word, if it has one). Containment is total, so a prefix of one shingle is enough: the rarest
one over all documents. Documents post their places of shingles, with their words; places of prefix shingles join the
windows, the window then has one place in the document, which must lie inside it (positional and length bounds), and its
words are compared.

A side is broadcast only while its counted rows are under a bound; beyond it the same joins shuffle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarry.llm.common import written

#: Rows of benchmark shingles or windows that may be broadcast (about 100 bytes each).
BROADCAST_ROWS = 200_000
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_GAPS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def words(text: Column) -> Column:
    """Words of a text after A-Z is lowered: runs of 0-9, a-z and everything beyond ASCII. Null has none."""
    ascii_only = F.octet_length(text) == F.char_length(text)
    lowered = F.when(ascii_only, F.lower(text)).otherwise(F.translate(text, UPPER, LOWER))
    return F.filter(F.split(F.coalesce(lowered, F.lit("")), _GAPS), lambda w: w != "")


def pairs(ws: Column) -> Column:
    """The two words at each place but the last, joined by a blank, which is in no word."""
    n = F.size(ws)
    return F.zip_with(F.slice(ws, 1, F.greatest(n - 1, F.lit(0))), F.slice(ws, 2, F.greatest(n - 1, F.lit(0))), lambda a, b: F.concat(a, F.lit(" "), b))


def bounded(df: DataFrame, most: int = BROADCAST_ROWS) -> DataFrame:
    """`df`, marked for broadcast if its rows are counted to be few."""
    return F.broadcast(df) if df.count() <= most else df


def windows(items: DataFrame, size: int) -> DataFrame:
    """win, item_id, w, len: the windows of every item; win stands for the words."""
    own = items.select("item_id", words(F.col("text")).alias("w")).where(F.size("w") > 0)
    starts = F.sequence(F.lit(1), F.greatest(F.size("w") - (size - 1), F.lit(1)))
    each = own.select("item_id", F.explode(F.transform(starts, lambda i: F.slice("w", i, size))).alias("w"))
    return each.select(F.sha2(F.array_join("w", " ").cast("binary"), 256).alias("win"), "item_id", "w", F.size("w").alias("len"))


def places_of(docs: DataFrame, wanted: DataFrame, single: bool) -> DataFrame:
    """row, doc_id, n (words), at, token of each place of a wanted token (one column), and one place -1 a row, whose
    token is empty. One pass splits every text once; `single` adds the words by themselves."""
    split = docs.select("doc_id", F.monotonically_increasing_id().alias("row"), words(F.col("text")).alias("w"))
    tokens = F.concat(F.array(F.lit("")), pairs(F.col("w")), *([F.col("w")] if single else []))
    each = split.select("row", "doc_id", F.size("w").alias("n"), F.posexplode(tokens).alias("at", "token"))
    ends = F.greatest("n", F.lit(1))  # where pairs end and single words begin
    return each.join(bounded(wanted), "token", "left_semi").withColumn("at", F.when(F.col("at") < ends, F.col("at") - 1).otherwise(F.col("at") - ends))


def contaminated(docs: DataFrame, items: DataFrame, size: int = 13, percent: int = 5) -> DataFrame:
    """doc_id, n_words, n_hit, item_ids (sorted as strings), contaminated for docs (doc_id, text), items (item_id, text).

    A document word inside any place of an item's window is hit; contaminated means at least one hit word and
    100 * n_hit >= percent * n_words. A null, empty or wordless text has no words and is clean; such an item has no
    window. Every row is judged by itself, whether its doc_id is null, repeated or neither. Items that repeat an
    item_id count once. Other columns are ignored; without items everything is clean.
    """
    table = written(windows(items.select("item_id", "text"), size), "dc-windows")
    distinct = table.groupBy("win").agg(F.first("w").alias("w"), F.first("len").alias("len"))
    tokens = F.when(F.size("w") > 1, pairs(F.col("w"))).otherwise(F.col("w"))
    grams = written(distinct.select("win", "len", F.posexplode(tokens).alias("at", "token")), "dc-grams")
    wanted = grams.select("token").union(docs.sparkSession.range(1).select(F.lit("").alias("token"))).distinct()
    found = written(places_of(docs.select("doc_id", "text"), wanted, not table.where("len = 1").isEmpty()), "dc-places")
    places = found.where("at >= 0").select("row", "at", "token")
    often = places.groupBy("token").agg(F.count("*").alias("often"))
    rarest = grams.join(often, "token").groupBy("win", "len").agg(F.count("*").alias("met"), F.min(F.struct("often", "at", "token")).alias("p"))
    complete = rarest.where("met = greatest(len - 1, 1)")  # a window with a shingle that occurs nowhere cannot occur
    prefix = written(complete.select("win", "len", F.col("p.at").alias("shift"), F.col("p.token").alias("token")), "dc-prefix")
    started = places.join(bounded(prefix), "token").withColumn("start", F.col("at") - F.col("shift")).where("start >= 0")
    candidates = started.select("row", "win", "len", "start").distinct()
    expected = candidates.join(bounded(grams.drop("len")), "win").select("row", "win", "len", "start", (F.col("start") + F.col("at")).alias("at"), "token")
    whole = expected.join(places, ["row", "at", "token"]).groupBy("row", "win", "len", "start").agg(F.count("*").alias("met")).where("met = greatest(len - 1, 1)")
    occurs = written(whole.select("row", "win", "len", "start"), "dc-occurs")
    spans = occurs.select("row", F.explode(F.sequence("start", F.col("start") + F.col("len") - 1)).alias("at")).distinct()
    hit = spans.groupBy("row").agg(F.count("*").alias("n_hit"))
    named = occurs.select("row", "win").distinct().join(bounded(table.select("win", "item_id").distinct()), "win").select("row", F.col("item_id").cast("string").alias("item")).distinct()
    listed = named.groupBy("row").agg(F.array_sort(F.collect_list("item")).alias("item_ids"))
    out = found.where("at < 0").join(hit.join(listed, "row", "left"), "row", "left").select(
        "doc_id", F.col("n").cast("long").alias("n_words"), F.coalesce("n_hit", F.lit(0)).cast("long").alias("n_hit"), F.coalesce("item_ids", F.array().cast("array<string>")).alias("item_ids")
    )
    return out.withColumn("contaminated", (F.col("n_hit") > 0) & (100 * F.col("n_hit") >= percent * F.col("n_words")))
