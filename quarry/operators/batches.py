"""Numbering of chunks, calendars and the next partition to process."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window


#: Ranges of a numbering, at most, and how many of them are told apart first.
MOST_RANGES, COARSE = 10_000, 100


def chunk_numbers(df: DataFrame, order: str, rows: int = 150_000, window_rows: int = 50_000) -> DataFrame:
    """Adds `chunk`: contiguous runs of `rows` rows in the order of a unique number column; nulls come first. Ranges of
    about equally many rows, cut at quantiles of the column, are ranked apart and meet their predecessors' counts, so no
    window holds the table, however the column clusters."""
    n = df.count()
    ranges = min(MOST_RANGES, max(1, n // window_rows))
    cuts = df.agg(F.percentile_approx(order, [i / ranges for i in range(1, ranges)], 10 * ranges).alias("q")).first()["q"] if ranges > 1 else []
    cuts = sorted(set(cuts or []))
    below = lambda values, c: F.size(F.filter(values, lambda x: x < c))
    some = F.array(*[F.lit(x) for x in cuts[COARSE - 1 :: COARSE]]) if len(cuts) >= COARSE else None
    first = below(some, F.col(order)) if some is not None else F.lit(0)
    place = (first * COARSE + below(F.slice(F.array(*[F.lit(x) for x in cuts]), first * COARSE + 1, COARSE), F.col(order))) if cuts else F.lit(0)
    cut = df.withColumn("_b", F.when(F.col(order).isNull(), F.lit(-1)).otherwise(place))
    sizes = cut.groupBy("_b").agg(F.count("*").alias("_n"))
    before = sizes.select("_b", F.coalesce(F.sum("_n").over(Window.orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_before"))
    rank = F.row_number().over(Window.partitionBy("_b").orderBy(order))
    return cut.withColumn("_r", rank).join(before, "_b").withColumn("chunk", F.floor((F.col("_r") + F.col("_before") - 1) / rows).cast("long")).drop("_b", "_r", "_before")


def days(spark: SparkSession, first: str, last: str) -> DataFrame:
    """day (YYYYMMDD), inclusive; callers that need newest first order it so."""
    span = F.sequence(F.lit(first).cast("date"), F.lit(last).cast("date"))
    return spark.range(1).select(F.explode(span).alias("d")).select(F.date_format("d", "yyyyMMdd").alias("day"))


def minute_paths(day_rows: DataFrame) -> DataFrame:
    """day, path: the 1440 archive names of each day."""
    minutes = F.sequence(F.lit(0), F.lit(1439))
    each = day_rows.select("day", F.explode(minutes).alias("m"))
    return each.select("day", F.format_string("%s/%sT%02d%02d", "day", "day", F.floor(F.col("m") / 60).cast("int"), (F.col("m") % 60).cast("int")).alias("path"))


def next_unprocessed(available: DataFrame, done: DataFrame, start: str, look: int = 31) -> DataFrame:
    """next_date: from `start` on, within `look` days, the first date that is available and not done, unless a date
    missing from the source comes before it; NULL if there is none."""
    spark = available.sparkSession
    span = spark.range(look).select(F.date_add(F.lit(start).cast("date"), F.col("id").cast("int")).alias("date"))
    there = available.select(F.col("date")).distinct().withColumn("_a", F.lit(True))
    past = done.select(F.col("date")).distinct().withColumn("_d", F.lit(True))
    marked = span.join(there, "date", "left").join(past, "date", "left")
    edge = marked.agg(F.min(F.when(F.col("_a").isNull(), F.col("date"))).alias("gap"), F.min(F.when(F.col("_a") & F.col("_d").isNull(), F.col("date"))).alias("first"))
    return edge.select(F.when(F.col("gap").isNull() | (F.col("first") < F.col("gap")), F.col("first")).alias("next_date"))


def default_date(today: Column | None = None, settle_days: int = 2) -> Column:
    """The newest day old enough to be settled."""
    return F.date_sub(F.current_date() if today is None else today, settle_days)
