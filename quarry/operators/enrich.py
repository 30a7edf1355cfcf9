"""Enrichment by key lookup."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarry.functions import scalars
from quarry.operators.dedup import last_write_wins, newest_first

#: Rows of a lookup table that may be broadcast; beyond, the join shuffles on its key.
BROADCAST_ROWS = 2_000_000


def small(df: DataFrame, most: int = BROADCAST_ROWS) -> DataFrame:
    """`df` marked for broadcast if counting at most `most` + 1 of its rows shows that it is small."""
    return F.broadcast(df) if df.limit(most + 1).count() <= most else df


def usable(lookup: DataFrame, key: str) -> DataFrame:
    """Lookup rows with a key: NULL and empty keys never match."""
    return lookup.where(F.col(key).isNotNull() & (F.col(key).cast("string") != ""))


def left_enrich(df: DataFrame, lookup: DataFrame, key: str, value: str, ordinal: Column | None = None) -> DataFrame:
    """`df` with column `value` set from the lookup, NULL where nothing matches, over any earlier value. One row out for
    each row in: the lookup is made unique first."""
    right = usable(lookup, key)
    right = last_write_wins(right, key, value, ordinal) if ordinal is not None else right.groupBy(key).agg(F.max(value).alias(value))
    return df.drop(value).join(right, key, "left")


def requested_keys(df: DataFrame, key: str) -> DataFrame:
    """Distinct non-empty keys, to be looked up."""
    return usable(df.select(key), key).distinct()


def fill_rate(df: DataFrame, value: str) -> DataFrame:
    """rows, filled, percent (0 where there are no rows)."""
    return df.agg(F.count("*").alias("rows"), F.count(value).alias("filled")).withColumn("percent", F.coalesce(F.try_divide(100.0 * F.col("filled"), F.col("rows")), F.lit(0.0)))


def keep_rate(df: DataFrame, keep: Column) -> DataFrame:
    """total, kept, percent (0 where there are no rows)."""
    out = df.agg(F.count("*").alias("total"), F.count_if(F.coalesce(keep, F.lit(False))).alias("kept"))
    return out.withColumn("percent", F.coalesce(F.try_divide(100.0 * F.col("kept"), F.col("total")), F.lit(0.0)))


def resolve(df: DataFrame, lookup: DataFrame, key: str, own: str, looked_up: str, ordinal: Column | None = None) -> DataFrame:
    """Rows with a resolved class and its origin: own or lookup. Others go. The lookup is made unique first: the last
    row of a key in `ordinal` counts, or its greatest class where there is no order."""
    right = usable(lookup, key)
    right = last_write_wins(right, key, looked_up, ordinal) if ordinal is not None else right.groupBy(key).agg(F.max(looked_up).alias(looked_up))
    right = right.select(key, F.col(looked_up).alias("_found"))
    joined = df.join(right, key, "left")
    mine = scalars.normalized(F.col(own))
    out = joined.withColumn("classification", scalars.resolved_class(F.col(own), F.col("_found")))
    origin = F.when(F.col("classification") == mine, F.lit("own")).otherwise(F.lit("lookup"))
    return out.where("classification IS NOT NULL").withColumn("origin", origin).drop("_found")


def combine_sources(reports: DataFrame, verdicts: DataFrame, key: str, scored: str, valid: Column) -> DataFrame:
    """Report with its verdict's class if there is a valid one, else with its own score's class."""
    right = usable(verdicts, key).where(valid).groupBy(key).agg(F.max("classification").alias("_verdict"))
    joined = reports.join(right, key, "left")
    return joined.withColumn("classification", F.coalesce("_verdict", scored)).withColumn("origin", F.when(F.col("_verdict").isNotNull(), "verdict").otherwise("score")).drop("_verdict")


def batch_lookup(requests: DataFrame, table: DataFrame, key: str, code: str = "response_code", order: list[Column] | None = None) -> DataFrame:
    """One row for each requested key; an absent key has code 0. Of the rows that the table has for a key the first in
    `order` counts, or the first by their values where there is no order."""
    wanted = requested_keys(requests, key)
    one = newest_first(table, key, order or [F.to_json(F.struct(*[F.col(f"`{c}`") for c in table.columns]))])
    return wanted.join(one, key, "left").withColumn(code, F.coalesce(code, F.lit(0)))


def eligible(files: DataFrame, done: DataFrame, upstream: DataFrame | None, name: str = "name") -> DataFrame:
    """Files not done yet and, unless `upstream` is None or empty, done upstream."""
    todo = files.join(done.select(name).distinct(), name, "left_anti")
    if upstream is None:
        return todo
    flag = upstream.agg((F.count("*") == 0).alias("_all"))
    named = upstream.select(name).distinct().withColumn("_up", F.lit(True))
    out = todo.join(named, name, "left").crossJoin(F.broadcast(flag))  # one row
    return out.where("_all OR _up").drop("_all", "_up")
