"""Sinks: Parquet, NDJSON, TSV, versioned rewrites and the manifest of finished work."""

from __future__ import annotations

import tempfile
import time
from collections.abc import Callable, Iterator
from itertools import islice
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.functions import rules, scalars

ROWS_PER_FILE = 2_000_000
#: Bytes of a Parquet row group.
ROW_GROUP_BYTES = 128 << 20


def parquet(df: DataFrame, path: str, mode: str = "append", rows: int = ROWS_PER_FILE) -> None:
    """zstd Parquet, rolled at so many rows a file."""
    df.write.mode(mode).option("compression", "zstd").option("maxRecordsPerFile", rows).option("parquet.block.size", ROW_GROUP_BYTES).parquet(path)


def ndjson_line(df: DataFrame) -> DataFrame:
    """value: the row as compact JSON, NULL fields kept."""
    return df.select(F.to_json(F.struct(*[F.col(f"`{c}`") for c in df.columns]), {"ignoreNullFields": "false"}).alias("value"))


def ndjson(df: DataFrame, path: str, mode: str = "append") -> None:
    ndjson_line(df).write.mode(mode).option("compression", "gzip").text(path)


#: Target columns in load order; names bind, so class and source cannot swap.
TARGET = ("sha256", "sha1", "md5", "classification", "source", "detection_names", "scan_date", "positives", "total")


def target_rows(df: DataFrame) -> DataFrame:
    """Curated rows as the target table holds them."""
    return df.select(
        *[F.unhex(c).alias(c) for c in ("sha256", "sha1", "md5")],
        scalars.target_class(F.col("classification")).alias("classification"),
        F.lit(rules.SOURCE).alias("source"),
        "detection_names",
        scalars.to_date(F.col("scan_date")).alias("scan_date"),
        scalars.clamped(F.col("positives")).alias("positives"),
        scalars.clamped(F.col("total")).alias("total"),
    )


def tsv_rows(df: DataFrame) -> DataFrame:
    """The target's columns as text for a bulk load: hex keys, text without tabs or line ends."""
    return df.select(
        "sha256", "sha1", "md5", scalars.target_class(F.col("classification")).alias("classification"), F.lit(rules.SOURCE).alias("source"),
        scalars.tsv_text(F.col("detection_names")).alias("detection_names"), scalars.to_date(F.col("scan_date")).cast("string").alias("scan_date"),
        scalars.clamped(F.col("positives")).alias("positives"), scalars.clamped(F.col("total")).alias("total"),
    )


def tsv(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """Tab-separated, no header, no quotes, NULL as \\N."""
    tsv_rows(df).write.mode(mode).options(sep="\t", quote="", escape="", nullValue="\\N", emptyValue="").csv(path)


def _fs(spark: SparkSession, path: str):  # noqa: ANN202
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()), p


def _folders(spark: SparkSession, root: str, prefix: str) -> list[str]:
    """Folders under `root` whose names start with `prefix`, in name order."""
    fs, p = _fs(spark, root)
    return sorted(s.getPath().toString() for s in fs.listStatus(p) if s.isDirectory() and s.getPath().getName().startswith(prefix)) if fs.exists(p) else []


def _exists(spark: SparkSession, path: str) -> bool:
    fs, p = _fs(spark, path)
    return fs.exists(p)


def _delete(spark: SparkSession, path: str) -> None:
    fs, p = _fs(spark, path)
    fs.delete(p, True)


def versions(spark: SparkSession, root: str) -> list[str]:
    """Committed version folders of a table, oldest first; what a crashed write left behind is none."""
    return [v for v in _folders(spark, root, "v=") if _exists(spark, f"{v}/_SUCCESS")]


def current(spark: SparkSession, root: str) -> DataFrame:
    """The newest committed version."""
    committed = versions(spark, root)
    if not committed:
        raise FileNotFoundError(f"{root} has no committed version")
    return spark.read.parquet(committed[-1])


def _version_path(root: str) -> str:
    return f"{root.rstrip('/')}/v={time.time_ns():020d}"


def publish(df: DataFrame, root: str, keep: int | None = None) -> str:
    """Write a new version beside those being read; it counts once its success marker is there. With `keep`, only so
    many of the newest committed versions stay."""
    path = _version_path(root)
    parquet(df, path, "errorifexists")
    if keep:
        done = versions(df.sparkSession, root)
        for old in [v for v in _folders(df.sparkSession, root, "v=") if v < done[-keep:][0]]:
            _delete(df.sparkSession, old)
    return path


class Buckets:
    """A table by key in `buckets` parts, of which a merge rewrites only those that its rows touch. A version holds the
    parts it rewrote; the newest committed version of each part counts, and older ones go after `keep` versions."""

    def __init__(self, spark: SparkSession, root: str, key: str, buckets: int = 256, keep: int = 2) -> None:
        self.spark, self.root, self.key, self.buckets, self.keep = spark, root, key, buckets, keep

    def _newest(self) -> dict[int, list[str]]:
        """Folders of each part in committed versions, newest first."""
        found: dict[int, list[str]] = {}
        for version in reversed(versions(self.spark, self.root)):
            for folder in _folders(self.spark, version, "_part="):
                found.setdefault(int(folder.rsplit("=", 1)[1]), []).append(folder)
        return found

    def _numbered(self, df: DataFrame) -> DataFrame:
        return df.withColumn("_part", F.pmod(F.xxhash64(self.key), F.lit(self.buckets)).cast("int"))

    def read(self, parts: set[int] | None = None) -> DataFrame | None:
        """The table, or some of its parts; None where nothing is committed."""
        paths = [p[0] for i, p in self._newest().items() if parts is None or i in parts]
        return self.spark.read.parquet(*paths) if paths else None

    def merge(self, rows: DataFrame, combine: Callable[[DataFrame, DataFrame], DataFrame]) -> int:
        """Replace each part that `rows` touch by combine(part, its rows), in one version; returns how many parts."""
        own = self._numbered(rows)
        touched = {r["_part"] for r in own.select("_part").distinct().collect()}  # at most `buckets`
        if not touched:
            return 0
        base = self.read(touched)
        merged = combine(rows.limit(0) if base is None else base, rows)
        spread = self._numbered(merged).repartition("_part")
        spread.write.partitionBy("_part").option("compression", "zstd").option("maxRecordsPerFile", ROWS_PER_FILE).parquet(_version_path(self.root))
        for folders in self._newest().values():
            for old in folders[self.keep :]:
                _delete(self.spark, old)
        return len(touched)


def single(df: DataFrame, path: str, compression: str = "snappy") -> None:
    """All rows as one Parquet file at `path`, on request only: one task writes them."""
    spark, folder = df.sparkSession, f"{path}.parts-{time.time_ns()}"
    df.coalesce(1).write.option("compression", compression).parquet(folder)
    fs, p = _fs(spark, folder)
    part = next(s.getPath() for s in fs.listStatus(p) if s.getPath().getName().startswith("part-"))
    _delete(spark, path)
    if not fs.rename(part, _fs(spark, path)[1]):
        raise OSError(f"could not name {path}")
    _delete(spark, folder)


def bulk_load(df: DataFrame, connect: Callable[[], Any], statement: str, chunk: int = 150_000, attempts: int = 3, pause: float = 5.0) -> None:
    """Load rows over a DB-API connection made in each task, in chunks that are committed one by one and tried again
    after a failure. `statement` has a mark for each column and ignores keys that are there already, so loading twice is
    loading once."""

    def load(rows: Iterator[Any]) -> None:
        while part := [tuple(r) for r in islice(rows, chunk)]:
            for attempt in range(1, attempts + 1):
                db = None
                try:
                    db = connect()
                    db.cursor().executemany(statement, part)
                    db.commit()
                    break
                except Exception:
                    if attempt == attempts:
                        raise
                    time.sleep(pause * attempt)
                finally:
                    if db is not None:
                        db.close()

    df.foreachPartition(load)


def shared_dir(spark: SparkSession) -> str:
    """The folder that the session names as shared by the driver and all executors; a local session may do without."""
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if named:
        return named.rstrip("/")
    if not spark.sparkContext.master.startswith("local") or spark.sparkContext.master.startswith("local-cluster"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    return "file://" + tempfile.mkdtemp(prefix="quarry-")


class Manifest:
    """Finished work: name, length, version of what was done, by stage. Appended after the commit of the work itself."""

    SCHEMA = "stage string, name string, length long, version string"

    def __init__(self, spark: SparkSession, path: str) -> None:
        self.spark, self.path = spark, path

    def done(self, stage: str) -> DataFrame:
        fs, p = _fs(self.spark, self.path)
        if not fs.exists(p):
            return self.spark.createDataFrame([], self.SCHEMA)
        return self.spark.read.schema(self.SCHEMA).parquet(self.path).where(F.col("stage") == stage)

    def todo(self, stage: str, work: DataFrame) -> DataFrame:
        """Rows of work (name, length, version) not done in the same length and version: a changed input is work again."""
        past = self.done(stage).select(F.col("name").alias("_n"), F.col("length").alias("_l"), F.col("version").alias("_v")).distinct()
        same = F.col("name").eqNullSafe(F.col("_n")) & F.col("length").eqNullSafe(F.col("_l")) & F.col("version").eqNullSafe(F.col("_v"))
        return work.join(past, same, "left_anti")

    def mark(self, stage: str, work: DataFrame) -> None:
        work.select(F.lit(stage).alias("stage"), "name", F.col("length").cast("long"), "version").write.mode("append").parquet(self.path)
