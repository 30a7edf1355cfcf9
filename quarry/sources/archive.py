"""Minute archives: bz2-compressed tars with one NDJSON member."""

from __future__ import annotations

import bz2
import io
import tarfile
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

RECORD = (
    "sha256 string, sha1 string, md5 string, positives double, total double, scan_date string, "
    "scans map<string, struct<detected: string, result: string>>"
)


def payload(raw: bytes) -> bytes:
    """Content of the first regular member of a bz2-compressed tar; empty if there is none."""
    with tarfile.open(fileobj=io.BytesIO(bz2.decompress(raw))) as tar:
        for member in tar:
            if member.isreg():
                return tar.extractfile(member).read()
    return b""


#: Bytes of lines in one row.
ROW_BYTES = 1 << 20


def pieces(data: bytes, most: int = ROW_BYTES) -> Iterator[tuple[int, list[str]]]:
    """Number of the first line, and lines, of runs of whole lines of about `most` bytes; one run at least."""
    at = line = 0
    while True:
        end = data.find(b"\n", at + most)
        part = data[at : len(data) if end < 0 else end].decode("utf-8", "replace").split("\n")
        yield line, part
        if end < 0:
            return
        line, at = line + len(part), end + 1


def opened(files: DataFrame) -> DataFrame:
    """path, status (ok, error), bytes, first (line), lines of archives (path, content): rows of bounded size, the first
    one of an archive having first = 0. A broken archive is an error without lines, not a failure."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for path, raw in zip(batch["path"], batch["content"], strict=True):
                try:
                    data = payload(raw)
                except (OSError, EOFError, ValueError, tarfile.TarError):
                    yield pd.DataFrame({"path": [path], "status": ["error"], "bytes": [len(raw)], "first": [0], "lines": [[]]})
                    continue
                for first, lines in pieces(data):
                    yield pd.DataFrame({"path": [path], "status": ["ok"], "bytes": [len(raw)], "first": [first], "lines": [lines]})

    return files.select("path", "content").mapInPandas(run, "path string, status string, bytes long, first long, lines array<string>")


def scan(spark: SparkSession, root: str) -> DataFrame:
    """All archives under `root` (day folders of minute objects)."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(root)
    return opened(files)


def statuses(archives: DataFrame, expected: DataFrame | None = None) -> DataFrame:
    """day, minute, status, bytes; names in `expected` (path as day/name) without an archive count as miss."""
    name = F.regexp_extract("path", r"(\d{8}/\d{8}T\d{4})[^/]*$", 1)
    have = archives.where("first = 0").select(name.alias("name"), "status", "bytes")
    if expected is not None:
        have = expected.select(F.col("path").alias("name")).join(have, "name", "left")
    return have.select(F.substring("name", 1, 8).alias("day"), F.substring("name", 19, 4).alias("minute"), F.coalesce("status", F.lit("miss")).alias("status"), F.coalesce("bytes", F.lit(0)).alias("bytes"))


def records(archives: DataFrame) -> DataFrame:
    """Parsed records with day, minute and line. A blank line, bad JSON or one that is no object is skipped alone; of
    counts, an absent total is told from a null one."""
    lines = archives.where("status = 'ok'").select("path", "first", F.posexplode("lines").alias("nth", "json")).where(F.trim("json") != "").withColumn("line", F.col("first") + F.col("nth"))
    day, minute = F.regexp_extract("path", r"(\d{8})T\d{4}[^/]*$", 1), F.regexp_extract("path", r"\d{8}T(\d{4})[^/]*$", 1)
    keys = F.json_object_keys("json")
    parsed = lines.select(day.alias("day"), minute.alias("minute"), "line", F.from_json("json", RECORD).alias("r"), keys.alias("k")).where("k IS NOT NULL")
    return parsed.select("day", "minute", "line", "r.*", F.array_contains("k", "total").alias("has_total"))
