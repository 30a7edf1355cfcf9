"""Parquet tables: whole or by column, with an opt-in for unreadable files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def scan(spark: SparkSession, path: str, pattern: str = "*.parquet", skip_corrupt: bool = False, schema: str | None = None) -> DataFrame:
    """Files of a folder in one plan; with `skip_corrupt` an unreadable file is passed over and never deleted."""
    reader = spark.read.option("pathGlobFilter", pattern).option("ignoreCorruptFiles", str(skip_corrupt).lower())
    return (reader.schema(schema) if schema else reader).parquet(path)


def keys(table: DataFrame, key: str = "sha1") -> DataFrame:
    """Distinct non-empty keys; only that column is read."""
    return table.select(key).where(F.col(key).isNotNull() & (F.col(key) != "")).distinct()


def files(table: DataFrame) -> DataFrame:
    """name, rows of the files behind a table, in name order."""
    return table.select(F.col("_metadata.file_name").alias("name")).groupBy("name").agg(F.count("*").alias("rows")).orderBy("name")


def listing(spark: SparkSession, root: str, pattern: str = "*") -> DataFrame:
    """path, length, modified of the files under a folder, whose contents are not read."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", pattern).load(root)
    return files.select("path", "length", F.col("modificationTime").alias("modified"))


def merged_unique(parts: list[DataFrame], key: str) -> DataFrame:
    """The distinct non-empty keys of several tables, in order."""
    out = keys(parts[0], key)
    for part in parts[1:]:
        out = out.union(keys(part, key))
    return out.distinct().orderBy(key)


def sharded(spark: SparkSession, root: str, names: tuple[str, ...]) -> DataFrame:
    """UNION ALL of shard folders with a `shard` column, as one scan."""
    paths = [f"{root.rstrip('/')}/{n}" for n in names]
    return spark.read.parquet(*paths).withColumn("shard", F.element_at(F.split("_metadata.file_path", "/"), -2))
