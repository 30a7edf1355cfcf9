"""The feed as a stream: files arrive, each micro-batch is curated and merged, nothing is loaded twice."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry import sinks
from quarry.operators import dedup


def settled(stream: DataFrame, time: str, delay: str = "2 days") -> DataFrame:
    """With the watermark that waits for late objects. Parquet timestamps without zone become instants first."""
    return stream.withColumn(time, F.col(time).cast("timestamp")).withWatermark(time, delay)


def merge_batches(stream: DataFrame, root: str, checkpoint: str, key: str, order: Callable[[], list[Column]], transform: Callable[[DataFrame], DataFrame] | None = None, every: str | None = None, buckets: int = 256):  # noqa: ANN201
    """Run the stream through newest-first merging into the table `root` (sinks.Buckets by `key`): everything available,
    and stop, or with `every` (as "60 seconds") a pull at that interval. A micro-batch rewrites only the parts its keys
    are in, and one that is retried merges into the same state, so each row counts once."""

    def merge(batch: DataFrame, batch_id: int) -> None:
        rows = batch if transform is None else transform(batch)
        sinks.Buckets(batch.sparkSession, root, key, buckets).merge(rows, lambda base, new: dedup.upsert_latest(base, new, key, order()))

    return stream.writeStream.foreachBatch(merge).option("checkpointLocation", checkpoint).trigger(**pulled(every)).start()


def pulled(every: str | None) -> dict:
    """The trigger: what is available once, or again and again."""
    return {"processingTime": every} if every else {"availableNow": True}


def insert_batches(stream: DataFrame, root: str, checkpoint: str, every: str | None = None):  # noqa: ANN201
    """Append each micro-batch under its batch id; a retry overwrites its own folder, so output is exactly once."""

    def insert(batch: DataFrame, batch_id: int) -> None:
        sinks.parquet(batch, f"{root.rstrip('/')}/batch={batch_id:012d}", "overwrite")

    return stream.writeStream.foreachBatch(insert).option("checkpointLocation", checkpoint).trigger(**pulled(every)).start()


def running_ratio(stream: DataFrame, by: str, hit: Column, time: str | None = None, window: str | None = None) -> DataFrame:
    """by, total, hits: counters kept per key (and event-time window), for update or append output."""
    keys = [F.col(by)] + ([F.window(time, window)] if time and window else [])
    return stream.groupBy(*keys).agg(F.count("*").alias("total"), F.count_if(F.coalesce(hit, F.lit(False))).alias("hits"))


def hourly(events: DataFrame, time: str = "ts") -> DataFrame:
    """hour, n: the same plan for batch and stream."""
    return events.groupBy(F.window(time, "1 hour").alias("w")).agg(F.count("*").alias("n")).select(F.col("w.start").alias("hour"), "n")


def collect_stream(stream: DataFrame, name: str, checkpoint: str, mode: str = "append") -> DataFrame:
    """Everything available, through an in-memory sink; for tests and small results."""
    stream.writeStream.format("memory").queryName(name).outputMode(mode).option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()
    return stream.sparkSession.table(name)


def events_stream(spark: SparkSession, path: str, schema: str, files_per_trigger: int = 1000) -> DataFrame:
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_trigger).parquet(path)
