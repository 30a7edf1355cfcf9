"""Programs: `spark-submit quarry/cli.py NAME ...` or `python -m quarry.cli NAME ...`.

export    minute archives to curated Parquet; --dry-run counts the funnel and writes nothing
backfill  classes of a curated table, looked up by key, into a new version; --dry-run tells the fill rate
filter    the rows of a table whose class is in the keep-set
dump      file-reputation BSON dumps to curated Parquet; with --resume, files done earlier are passed over
domains   domain BSON dumps to curated Parquet
convert   NDJSON records and a verdict list to curated Parquet
tsv       a curated table as text for a bulk load
"""

from __future__ import annotations

import argparse
import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry import sinks
from quarry.functions import rules
from quarry.operators import dedup, enrich, filters, funnel
from quarry.plans import pipelines
from quarry.sources import archive, bson, tables, verdicts


def told(rows: DataFrame) -> list[dict]:
    """Counters, printed one line each."""
    found = [r.asDict() for r in rows.collect()]
    for row in found:
        print(json.dumps(row, default=str))
    return found


def _newest_days(archives: DataFrame, most: int | None) -> DataFrame:
    day = F.regexp_extract("path", r"(\d{8})T\d{4}[^/]*$", 1)
    if most is None:
        return archives
    kept = filters.newest_dates(archives.select(day.alias("day")), "day", most)
    return archives.join(kept, day == kept["day"], "left_semi")


def export(spark: SparkSession, a: argparse.Namespace) -> list[dict]:
    opened = _newest_days(archive.scan(spark, a.input), a.max_days)
    rows = filters.feed_reports(archive.records(opened))
    newest = [F.desc(c) for c in pipelines.NEWEST]
    if a.dry_run:
        return told(funnel.export_funnel(archive.statuses(opened), dedup.dedup_reasons(rows, "sha1", newest)))
    fresh = dedup.newest_first(rows, "sha1", newest, F.col("sha1").rlike("^[0-9a-f]{40}$"))
    sinks.parquet(fresh, a.output, "errorifexists")
    return []


def backfill(spark: SparkSession, a: argparse.Namespace) -> list[dict]:
    table = sinks.current(spark, a.table) if sinks.versions(spark, a.table) else tables.scan(spark, a.table)
    outcome = verdicts.looked_up(enrich.requested_keys(table, "sha1"), a.verdicts)
    rows = enrich.left_enrich(table, outcome.where("status = 'found'"), "sha1", "classification")
    if a.dry_run:
        return told(enrich.fill_rate(rows, "classification"))
    sinks.publish(rows, a.output)
    return []


def keep(spark: SparkSession, a: argparse.Namespace) -> list[dict]:
    sinks.parquet(filters.keep_set(tables.scan(spark, a.input), "classification"), a.output, "errorifexists")
    return []


def dump(spark: SparkSession, a: argparse.Namespace) -> list[dict]:
    lookup = verdicts.csv(spark, a.verdicts, a.column)
    spark.dataSource.register(bson.BsonSource)
    manifest = sinks.Manifest(spark, f"{a.output.rstrip('/')}.done")
    files = tables.listing(spark, a.input, "*.bson").select(F.col("path").alias("name"), "length", F.col("modified").cast("string").alias("version"))
    counted = []
    for work in (manifest.todo("dump", files) if a.resume else files).orderBy("name").collect():  # a row for each dump file
        rows = spark.read.format("bson_dump").load(work["name"])
        if a.dry_run:
            counted += told(funnel.dump_counters(rows))
            continue
        part = f"{a.output.rstrip('/')}/file={work['name'].rsplit('/', 1)[1]}"
        sinks.parquet(pipelines.dump_to_curated(spark, work["name"], lookup), part, "overwrite")
        manifest.mark("dump", spark.createDataFrame([work], files.schema))
    return counted


def domains(spark: SparkSession, a: argparse.Namespace) -> list[dict]:
    spark.dataSource.register(bson.BsonSource)
    docs = bson.domain_docs(spark.read.format("bson_dump").load(a.input))
    if a.dry_run:
        return told(funnel.by_reason(filters.domain_reasons(docs, a.default)))
    sinks.parquet(filters.domain_dump(docs, a.default), a.output, "errorifexists")
    return []


def convert(spark: SparkSession, a: argparse.Namespace) -> list[dict]:
    sinks.parquet(pipelines.ndjson_to_curated(spark, a.input, verdicts.csv(spark, a.verdicts, a.column), a.field), a.output, "errorifexists")
    return []


def tsv(spark: SparkSession, a: argparse.Namespace) -> list[dict]:
    sinks.tsv(tables.scan(spark, a.input), a.output, "errorifexists")
    return []


def parser() -> argparse.ArgumentParser:
    top = argparse.ArgumentParser(prog="quarry", description=__doc__, formatter_class=argparse.RawDescriptionHelpFormatter)
    names = top.add_subparsers(required=True)

    def add(name: str, run, *required: str, dry: bool = False) -> argparse.ArgumentParser:  # noqa: ANN001
        own = names.add_parser(name)
        for option in required:
            own.add_argument(f"--{option}", required=True)
        own.set_defaults(run=run)
        if dry:
            own.add_argument("--dry-run", action="store_true")
        return own

    add("export", export, "input", "output", dry=True).add_argument("--max-days", type=int)
    add("backfill", backfill, "table", "verdicts", "output", dry=True)
    add("filter", keep, "input", "output")
    own = add("dump", dump, "input", "output", "verdicts", dry=True)
    own.add_argument("--column", default="classification")
    own.add_argument("--resume", action="store_true")
    add("domains", domains, "input", "output", dry=True).add_argument("--default", default=rules.DOMAIN_DEFAULT)
    own = add("convert", convert, "input", "output", "verdicts")
    own.add_argument("--column", default="classification")
    own.add_argument("--field", default="own_classification")
    add("tsv", tsv, "input", "output")
    return top


def main(args: list[str] | None = None) -> list[dict]:
    chosen = parser().parse_args(args)
    return chosen.run(SparkSession.builder.appName("quarry").getOrCreate(), chosen)


if __name__ == "__main__":
    main()
