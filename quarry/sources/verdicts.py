"""Verdict lists: CSV files and flat JSON objects by key."""

from __future__ import annotations

import json
import time
from collections.abc import Iterator
from concurrent.futures import ThreadPoolExecutor

import pyarrow as pa
from pyarrow import fs as stores
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.functions import rules, scalars
from quarry.operators.dedup import last_write_wins


def csv(spark: SparkSession, path: str, column: str = "classification") -> DataFrame:
    """`column` of the files holds the class. Result: sha1, classification: trimmed, lower case; rows with an empty key or a class to skip are not loaded; of the rows
    of a key the last in file order wins."""
    raw = spark.read.option("header", "true").schema(f"sha1 string, {column} string").csv(path)
    placed = raw.select("sha1", F.col(column).alias("classification"), F.struct(F.col("_metadata.file_path").alias("f"), F.col("_metadata.file_block_start").alias("s"), F.monotonically_increasing_id().alias("i")).alias("place"))
    return loaded(placed)


def loaded(rows: DataFrame) -> DataFrame:
    """sha1, classification of (sha1, classification, place), by the rules of the CSV."""
    key, value = scalars.normalized(F.col("sha1")), scalars.normalized(F.col("classification"))
    own = rows.select(key.alias("sha1"), value.alias("classification"), "place")
    good = own.where(F.col("sha1").isNotNull() & F.col("classification").isNotNull() & ~F.col("classification").isin(*rules.CONVERT_SKIP))
    return last_write_wins(good, "sha1", "classification", F.col("place"))


def looked_up(keys: DataFrame, root: str, suffix: str = ".json", attempts: int = 4, pause: float = 0.5, at_once: int = 64) -> DataFrame:
    """sha1, classification, status of the requested `keys` (column sha1) only: each task opens the objects of its keys
    under `root`, many at once, and tries a read that fails again. missing: no such object, or one without a class;
    failed: unreadable after `attempts`, or no JSON object, so that a later run can ask again (`to_retry`)."""
    wanted = keys.select(scalars.normalized(F.col("sha1")).alias("sha1")).where("sha1 IS NOT NULL").distinct()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files, base = stores.FileSystem.from_uri(root) if "://" in root or root.startswith("file:/") else (stores.LocalFileSystem(), root)

        def one(key: str) -> tuple[str | None, str]:
            for attempt in range(attempts):
                try:
                    with files.open_input_file(f"{base.rstrip('/')}/{key}{suffix}") as f:
                        found = json.loads(f.readall())
                    value = found.get("classification") if isinstance(found, dict) else None
                    return (str(value), "found") if value else (None, "missing" if isinstance(found, dict) else "failed")
                except FileNotFoundError:
                    return None, "missing"
                except ValueError:
                    return None, "failed"
                except OSError:
                    time.sleep(pause * 2**attempt)
            return None, "failed"

        with ThreadPoolExecutor(at_once) as pool:
            for batch in batches:
                found = list(pool.map(one, batch.column("sha1").to_pylist()))
                yield pa.RecordBatch.from_arrays([batch.column("sha1"), pa.array([v for v, _ in found], pa.string()), pa.array([s for _, s in found], pa.string())], names=["sha1", "classification", "status"])

    return wanted.mapInArrow(run, "sha1 string, classification string, status string")


def to_retry(outcome: DataFrame) -> DataFrame:
    """The keys of an earlier lookup that failed."""
    return outcome.where("status = 'failed'").select("sha1")


def store(files: DataFrame) -> DataFrame:
    """sha1, classification, status (found, missing, failed) of verdict objects (path, value): the key is the file name;
    an object without a class is missing, one that is no JSON object failed."""
    name = scalars.basename(F.col("path"))
    ok = F.json_object_keys("value").isNotNull()
    value = F.nullif(F.get_json_object("value", "$.classification"), F.lit(""))
    return files.select(F.lower(F.regexp_replace(name, r"\.json$", "")).alias("sha1"), F.when(ok, value).alias("classification"), F.when(~ok, "failed").when(value.isNull(), "missing").otherwise("found").alias("status"))
