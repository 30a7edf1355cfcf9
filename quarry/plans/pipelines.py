"""End-to-end plans: feed, file dump, domain dump and batch lookup. Each is one lazy plan up to its sink."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry import sinks
from quarry.functions import rules, scalars
from quarry.operators import batches, classify, dedup, enrich, filters
from quarry.sources import archive, bson, ndjson

#: Newest day first, then the later minute, then the later line.
NEWEST = ("day", "minute", "line")


def _newest() -> list:
    return [F.desc(c) for c in NEWEST]


def feed_reports(spark: SparkSession, root: str, history: DataFrame | None = None) -> DataFrame:
    """Curated rows of the feed, newest first by sha1, without keys that history has."""
    rows = filters.feed_reports(archive.records(archive.scan(spark, root)))
    fresh = dedup.newest_first(rows, "sha1", _newest(), F.col("sha1").rlike("^[0-9a-f]{40}$"))
    fresh = fresh if history is None else dedup.without_history(fresh, history, "sha1")
    return fresh.select("sha256", "sha1", "md5", "positives", "total", "scan_date", "detection_names", F.lit(None).cast("string").alias("classification"), F.col("day").alias("date"))


def feed_to_curated(spark: SparkSession, root: str, store: DataFrame, history: DataFrame | None = None) -> DataFrame:
    """Feed rows with their verdicts, restricted to the keep-set."""
    rows = enrich.left_enrich(feed_reports(spark, root, history), store.where("status = 'found'"), "sha1", "classification")
    return filters.keep_set(rows, "classification")


def dump_to_curated(spark: SparkSession, path: str, lookup: DataFrame, split_bytes: int = 64 << 20) -> DataFrame:
    """File dump to curated rows through the conversion rules."""
    spark.dataSource.register(bson.BsonSource)
    docs = bson.file_docs(spark.read.format("bson_dump").option("splitBytes", split_bytes).load(path))
    return converted(filters.file_dump(docs).withColumn("detections", F.lit(None).cast("string")), lookup)


def ndjson_to_curated(spark: SparkSession, path: str, lookup: DataFrame, verdict: str = "own_classification") -> DataFrame:
    """NDJSON records to curated rows; `verdict` is the field that holds a record's own class."""
    return converted(ndjson.scan(spark, path, verdict).where("parsed"), lookup)


def converted(rows: DataFrame, lookup: DataFrame) -> DataFrame:
    """Gate, class resolution and curated projection of dump records; duplicates stay."""
    gated = filters.convert_gate(rows).withColumn("sha1", scalars.normalized(F.col("sha1")))
    resolved = enrich.resolve(gated, lookup, "sha1", "own_classification", "classification")
    return resolved.select(
        "sha256", "sha1", scalars.normalized(F.col("md5")).alias("md5"),
        scalars.clamped_or_zero(scalars.truncated(F.col("positives"))).alias("positives"), scalars.clamped_or_zero(scalars.truncated(F.col("total"))).alias("total"),
        "scan_date", scalars.prefer_verbatim(F.col("detections"), scalars.detection_string(F.col("scans"))).alias("detection_names"),
        "classification", scalars.partition_date(F.col("scan_date")).alias("date"), "origin",
    )


def domains_to_curated(spark: SparkSession, path: str, split_bytes: int = 64 << 20, default: str = rules.DOMAIN_DEFAULT) -> DataFrame:
    """Domain dump to curated rows; narrow, no shuffle."""
    spark.dataSource.register(bson.BsonSource)
    return filters.domain_dump(bson.domain_docs(spark.read.format("bson_dump").option("splitBytes", split_bytes).load(path)), default)


def shards(spark: SparkSession, root: str, names: tuple[str, ...], read) -> DataFrame:  # noqa: ANN001
    """UNION ALL of shard folders with a `shard` column."""
    parts = [read(spark, f"{root.rstrip('/')}/{n}").withColumn("shard", F.lit(n)) for n in names]
    return union(parts)


def union(parts: list[DataFrame]) -> DataFrame:
    """UNION ALL by column name."""
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def lookup(requests: DataFrame, reports: DataFrame, store: DataFrame, as_of_ms: int, key: str = "sha1") -> DataFrame:
    """One row per requested key: its unexpired report (code 0 where there is none) with the verdict, or else its own
    class, and a new expiration."""
    live = reports.where(~classify.expired(F.col("expiration"), F.lit(as_of_ms)))
    rows = enrich.batch_lookup(requests, live.drop("expiration"), key)
    both = enrich.combine_sources(rows, store, key, "own_class", F.lit(True))
    named = both.withColumn("classification", F.coalesce("classification", F.lit("unknown")))
    return named.withColumn("expiration", classify.expiry(F.lit(as_of_ms), F.col("classification")))


def daily(spark: SparkSession, root: str, target: str, manifest: sinks.Manifest, store: DataFrame, start: str, today: str) -> str | None:
    """Process the next day that is in the source, settled and not done: curate it, add it to the target (the first
    write of a sha256 stays), then mark it. Returns the day, or None if there is none. Run again it does nothing twice:
    a day that was published but not marked adds no row."""
    listed = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(root).select("path")
    day = F.regexp_extract("path", r"(\d{8})T\d{4}[^/]*$", 1)
    settled = batches.default_date(F.lit(today).cast("date"))
    available = listed.select(F.to_date(F.nullif(day, F.lit("")), "yyyyMMdd").alias("date")).where(F.col("date") <= settled)
    done = manifest.done("daily").select(F.to_date("name", "yyyyMMdd").alias("date"))
    chosen = batches.next_unprocessed(available, done, start).first()["next_date"]
    if chosen is None:
        return None
    name = chosen.strftime("%Y%m%d")
    rows = feed_to_curated(spark, f"{root.rstrip('/')}/{name}", store)
    sinks.Buckets(spark, target, "sha256").merge(rows, lambda base, new: dedup.insert_ignore(base, new, "sha256", [F.asc("sha1")]))
    manifest.mark("daily", spark.createDataFrame([(name, 0, None)], "name string, length long, version string"))
    return name


def late_verdicts(table: sinks.Buckets, verdicts: DataFrame) -> int:
    """Classes that arrived after their rows had been published with a fallback: rows of `table` whose key has a verdict
    (key column and classification, one row a key) take its class, and nothing is inserted. Returns how many parts of
    the table were written anew."""
    if table.read() is None:
        return 0

    def combine(base: DataFrame, new: DataFrame) -> DataFrame:
        late = new.select(table.key, F.col("classification").alias("_late"))
        return base.join(late, table.key, "left").withColumn("classification", F.coalesce("_late", "classification")).select(*base.columns)

    return table.merge(verdicts, combine)


def dry_run(rows: DataFrame, keep) -> DataFrame:  # noqa: ANN001
    """What a run would keep, counted and not written."""
    return enrich.keep_rate(rows, keep)
