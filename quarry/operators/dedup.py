"""De-duplication and merging by key. Every "first" or "newest" has a total order."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window


def newest_first(df: DataFrame, key: str, order: list[Column], good_key: Column | None = None) -> DataFrame:
    """One row of each key: the first in `order`. Rows whose key is NULL, empty or fails `good_key` go."""
    usable = F.col(key).isNotNull() & (F.col(key).cast("string") != "")
    if good_key is not None:
        usable = usable & F.coalesce(good_key, F.lit(False))
    rank = F.row_number().over(Window.partitionBy(key).orderBy(*order))
    return df.where(usable).withColumn("_rank", rank).where("_rank = 1").drop("_rank")


def dedup_reasons(df: DataFrame, key: str, order: list[Column], chars: int = 40) -> DataFrame:
    """Every row with a reason: new, dup, no_key or bad_key (not hex of `chars` characters)."""
    empty = F.col(key).isNull() | (F.col(key) == "")
    bad = ~F.col(key).rlike(f"^[0-9A-Fa-f]{{{chars}}}$")
    told = df.withColumn("reason", F.when(empty, "no_key").when(bad, "bad_key"))
    # only good keys are ranked: the others may be many, and no window has to hold them
    rank = F.row_number().over(Window.partitionBy(key).orderBy(*order))
    ranked = told.where("reason IS NULL").withColumn("reason", F.when(rank == 1, "new").otherwise("dup"))
    return told.where("reason IS NOT NULL").unionByName(ranked)


def without_history(df: DataFrame, history: DataFrame, key: str) -> DataFrame:
    """Rows whose key is not in the history, of which only the key column is read."""
    return df.join(history.select(key).where(F.col(key).isNotNull()).distinct(), key, "left_anti")


def insert_ignore(base: DataFrame, loads: DataFrame, key: str, order: list[Column]) -> DataFrame:
    """The first write of a key stays: all of `base`, plus of `loads` the first row, in `order`, of each key that base
    lacks. Loading twice is loading once."""
    new = newest_first(without_history(loads, base, key), key, order)
    return base.unionByName(new.select(*base.columns))


def last_write_wins(df: DataFrame, key: str, value: str, ordinal: Column) -> DataFrame:
    """The value of each key's last row; a map-side combine keeps one row per key and task."""
    return df.groupBy(key).agg(F.max_by(value, ordinal).alias(value))


def upsert_latest(base: DataFrame, feed: DataFrame, key: str, order: list[Column]) -> DataFrame:
    """Newest row of each key over base and feed; `order` must put newer rows first."""
    return newest_first(base.unionByName(feed), key, order)


def update_existing(base: DataFrame, feed: DataFrame, key: str, order: list[Column]) -> DataFrame:
    """Refresh keys that base has; the feed never inserts."""
    return upsert_latest(base, feed.join(base.select(key).distinct(), key, "left_semi"), key, order)


def first_seen(stream: DataFrame, key: str, time: str, delay: str) -> DataFrame:
    """First-seen de-duplication within a watermark, for streams; unlike `newest_first` it keeps the first to arrive."""
    return stream.withWatermark(time, delay).dropDuplicatesWithinWatermark([key])
