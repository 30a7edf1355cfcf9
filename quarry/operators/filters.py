"""Row filters and projections of the two dump formats, the feed and the files."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarry.functions import rules, scalars


def detected(positives: Column) -> Column:
    """More than zero after truncation; missing counts as zero."""
    return F.coalesce(scalars.truncated(positives), F.lit(0)) > 0


def keep_set(df: DataFrame, column: str, values: tuple[str, ...] = rules.KEEP_SET) -> DataFrame:
    """Rows whose value is in the set, case included; NULL goes."""
    return df.where(F.col(column).isin(*values))


def feed_reports(parsed: DataFrame) -> DataFrame:
    """The curated projection of parsed feed records (doubles for counts, a map for scans, all else strings): detected
    files with a digest of the right length."""
    good = parsed.where(detected(F.col("positives")) & scalars.is_digest(F.col("sha256")))
    extra = [c for c in ("day", "minute", "line") if c in parsed.columns]
    total = F.when(F.col("has_total"), scalars.truncated(F.col("total"))).otherwise(F.lit(0)) if "has_total" in parsed.columns else scalars.truncated(F.col("total"))
    return good.select(
        F.lower("sha256").alias("sha256"),
        scalars.lower_or_null(F.col("sha1")).alias("sha1"),
        scalars.lower_or_null(F.col("md5")).alias("md5"),
        scalars.truncated(F.col("positives")).alias("positives"),
        total.alias("total"),
        "scan_date",
        scalars.detection_string(F.col("scans")).alias("detection_names"),
        *extra,
    )


def file_dump(docs: DataFrame) -> DataFrame:
    """File-reputation dump records worth keeping, flattened: the value's fields, the verdict in its own case where
    there is one, sha1 from the id where the value has none and the id has 40 characters."""
    own = F.nullif(F.col("verdict.classification"), F.lit(""))
    excluded = F.coalesce(F.lower(own).isin(*rules.DUMP_EXCLUDE), F.lit(False))
    keep = F.col("value").isNotNull() & (F.col("value.response_code") == 1) & ~excluded & (own.isNotNull() | detected(F.col("value.positives")))
    fallback = F.when(F.length("_id") == 40, F.col("_id"))
    return docs.where(F.coalesce(keep, F.lit(False))).select(
        F.col("value.sha256").alias("sha256"),
        F.coalesce(F.nullif(F.col("value.sha1"), F.lit("")), fallback).alias("sha1"),
        F.col("value.md5").alias("md5"),
        scalars.truncated(F.col("value.positives")).alias("positives"),
        scalars.truncated(F.col("value.total")).alias("total"),
        F.col("value.scan_date").alias("scan_date"),
        F.col("value.scans").alias("scans"),
        own.alias("own_classification"),
    )


def most(values: Column) -> Column:
    """The largest element of an array; NULL for an empty one."""
    return F.array_max(values)


def any_above(values: Column, bound: float) -> Column:
    """Whether an element of an array is above the bound; false for an empty one."""
    return F.coalesce(most(values) > bound, F.lit(False))


def _url_positives() -> Column:
    urls = F.coalesce(F.col("urls"), F.array().cast("array<struct<positives:int>>"))
    return F.filter(F.transform(urls, lambda u: u["positives"]), lambda p: p.isNotNull())


def domain_reasons(docs: DataFrame, default: str = rules.DOMAIN_DEFAULT) -> DataFrame:
    """Domain dump rows (_id, response, urls: array of struct(positives)) with the normalized columns and a reason:
    valid, no_classification, unknown, indifferent or bad_domain."""
    raw = scalars.value_of(F.col("response"))
    best = most(_url_positives())
    any_positive = any_above(_url_positives(), 0)
    raw = F.nullif(raw, F.lit(""))
    effective = F.when((raw == "indifferent") & any_positive, F.lit("av_detected")).otherwise(raw)
    domain = scalars.domain_name(F.col("_id"))
    reason = F.when(raw.isNull(), "no_classification").when(raw == "unknown", "unknown").when((raw == "indifferent") & ~any_positive, "indifferent").when(domain.isNull(), "bad_domain").otherwise("valid")
    return docs.select("*", domain.alias("domain"), scalars.domain_class(effective, default).alias("classification"), F.lit(rules.SOURCE).alias("source"), F.when(any_positive, best).alias("max_positives"), reason.alias("reason"))


def domain_dump(docs: DataFrame, default: str = rules.DOMAIN_DEFAULT) -> DataFrame:
    return domain_reasons(docs, default).where("reason = 'valid'").select("domain", "classification", "source", "max_positives")


def convert_gate(rows: DataFrame) -> DataFrame:
    """Rows whose trimmed, lower-cased sha256 has the right length."""
    return rows.withColumn("sha256", scalars.normalized(F.col("sha256"))).where(scalars.is_digest(F.col("sha256")))


def newest_dates(df: DataFrame, date: str, most: int | None = None) -> DataFrame:
    """Distinct dates, newest first, at most so many."""
    out = df.select(date).distinct().orderBy(F.desc(date))
    return out if most is None else out.limit(most)
