"""Funnel counters, each one aggregation."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def counted(df: DataFrame, by: tuple[str, ...] = (), **conditions: Column) -> DataFrame:
    """One count of each condition (NULL counts as false), for all rows or by group."""
    counts = [F.count_if(F.coalesce(c, F.lit(False))).alias(name) for name, c in conditions.items()]
    return df.groupBy(*by).agg(F.count("*").alias("rows"), *counts)


def export_funnel(archives: DataFrame, records: DataFrame) -> DataFrame:
    """One row: archives ok, missed and failed and their bytes; records detected, new and dropped by reason."""
    files = archives.agg(F.count_if(F.col("status") == "ok").alias("dl_ok"), F.count_if(F.col("status") == "miss").alias("dl_miss"), F.count_if(F.col("status") == "error").alias("dl_err"), F.coalesce(F.sum("bytes"), F.lit(0)).alias("bytes"))
    seen = records.agg(F.count("*").alias("rec_detected"), *[F.count_if(F.col("reason") == r).alias(f"rec_{r}") for r in ("new", "dup", "no_key", "bad_key")])
    return files.crossJoin(F.broadcast(seen))  # one row each


def dump_counters(rows: DataFrame) -> DataFrame:
    """path, documents, corrupt_runs, corrupt_bytes of a scan of BSON dumps: what decoded, how often reading had to find
    its place again, and what it stepped over."""
    bad = F.col("doc").isNull()
    return rows.groupBy("path").agg(F.count_if(~bad).alias("documents"), F.count_if(bad).alias("corrupt_runs"), F.coalesce(F.sum("corrupt"), F.lit(0)).alias("corrupt_bytes"))


def by_reason(df: DataFrame, reason: str = "reason") -> DataFrame:
    return df.groupBy(reason).agg(F.count("*").alias("n"))


def convert_counters(lines: DataFrame) -> DataFrame:
    """lines, skipped, valid, enriched of rows with `parsed`, `classification` and `origin`."""
    valid = F.col("parsed") & F.col("classification").isNotNull()
    return counted(lines, valid=valid, skipped=~F.coalesce(valid, F.lit(False)), enriched=valid & (F.col("origin") == "lookup")).withColumnRenamed("rows", "lines")


def observed(df: DataFrame, name: str, **conditions: Column) -> DataFrame:
    """The same counts in flight, for a plan that is to run once."""
    return df.observe(name, F.count(F.lit(1)).alias("rows"), *[F.count_if(F.coalesce(c, F.lit(False))).alias(k) for k, c in conditions.items()])
