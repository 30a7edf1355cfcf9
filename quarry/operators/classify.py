"""Documented classification rules. What the documents leave open is a parameter."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarry.functions import rules, scalars
from quarry.operators.enrich import small

#: Result patterns that a classifier may have.
MOST_PATTERNS = 10_000


def priority_table(spark, order: tuple[str, ...] = rules.PRIORITY) -> DataFrame:  # noqa: ANN001
    return spark.createDataFrame([(t, i) for i, t in enumerate(order)], "type string, rank int")


def weighted_scores(detections: DataFrame, factors: DataFrame, qualities: DataFrame, by: str) -> DataFrame:
    """by, type, score: sum over detecting engines of factor(type) * quality(engine). Both tables hold a row per type
    or engine, and are broadcast if they prove small."""
    joined = detections.join(small(factors), "type").join(small(qualities), "engine")
    return joined.groupBy(by, "type").agg(F.sum(F.col("factor") * F.col("quality")).alias("score"))


def best_type(scores: DataFrame, ranks: DataFrame, by: str) -> DataFrame:
    """The type of the highest score; on a tie the one of higher priority (lower rank)."""
    ranked = scores.join(small(ranks), "type", "left").withColumn("_r", F.coalesce("rank", F.lit(1 << 30)))
    best = F.max(F.struct("score", (-F.col("_r")).alias("r"), "type"))
    return ranked.groupBy(by).agg(best.alias("b")).select(by, F.col("b.type").alias("type"), F.col("b.score").alias("score"))


def subtype_sets(df: DataFrame, by: list[str], subtypes: str) -> DataFrame:
    """Sorted union of the subtype arrays of each group."""
    return df.select(*by, F.explode(subtypes).alias("_s")).distinct().groupBy(*by).agg(F.array_sort(F.collect_list("_s")).alias(subtypes))


def multi_engine(scans: DataFrame, patterns: DataFrame, factors: DataFrame, qualities: DataFrame, ranks: DataFrame, by: str = "sha1", threshold: float = 0.0) -> DataFrame:
    """by, type, score, subtypes of (by, engine, result): results become types by the first pattern (in order) they
    match, scores add up, and the best type wins if its score is above the threshold."""
    listed = patterns.select(F.struct("ordinal", "pattern", "type", "subtype").alias("p"))
    if listed.limit(MOST_PATTERNS + 1).count() > MOST_PATTERNS:
        raise ValueError(f"more than {MOST_PATTERNS} patterns")
    texts = scans.select("result").distinct()  # each distinct result meets the patterns once
    matched = texts.join(F.broadcast(listed), F.rlike("result", F.col("p.pattern"))).groupBy("result").agg(F.min("p").alias("p"))
    first = scans.select(by, "engine", "result").distinct().join(matched, "result")
    typed = first.select(by, "engine", F.col("p.type").alias("type"), F.array("p.subtype").alias("subtypes"))
    best = best_type(weighted_scores(typed, factors, qualities, by), ranks, by).where(F.col("score") > threshold)
    named = subtype_sets(typed.where(F.get("subtypes", F.lit(0)).isNotNull()), [by, "type"], "subtypes")
    return best.join(named, [by, "type"], "left").select(by, "type", "score", F.coalesce("subtypes", F.array().cast("array<string>")).alias("subtypes"))


def domain_report(code: Column, resolutions: Column, whois: Column, subdomains: Column, siblings: Column, categories: Column) -> Column:
    """unknown unless the code is 1; indifferent with any of the five fields; else unresolved."""
    some = lambda a: F.coalesce(F.size(a) > 0, F.lit(False))
    known = some(resolutions) | F.coalesce(whois != "", F.lit(False)) | some(subdomains) | some(siblings) | some(categories)
    return F.when(F.coalesce(code != 1, F.lit(True)), "unknown").when(known, "indifferent").otherwise("unresolved")


def dns_verdicts(dns: DataFrame, sinkholes: DataFrame) -> DataFrame:
    """dns rows (ip, sld) with classification, subtype and the sinkhole's entity; sinkholes: (identifier, entity)."""
    unique = sinkholes.groupBy("identifier").agg(F.min("entity").alias("entity"))
    joined = dns.join(unique, F.col("ip") == F.col("identifier"), "left")
    no_ip = F.col("ip").isNull() | (F.col("ip") == "")
    kind = F.when(no_ip, "unresolved").when(F.col("identifier").isNotNull(), "sinkholed").otherwise("indifferent")
    subtype = F.when(no_ip & F.col("sld").isNotNull() & (F.col("sld") != ""), "sldresolved")
    return joined.withColumn("classification", kind).withColumn("subtype", subtype).drop("identifier")


def confirmed_unresolved(dns_class: Column, domain_class: Column, local_ok: Column, strict: bool = False) -> Column:
    """DNS unresolved, report unknown (or unresolved, unless strict), and the local checks passed."""
    report = (domain_class == "unknown") if strict else domain_class.isin("unknown", "unresolved")
    return F.coalesce((dns_class == "unresolved") & report & local_ok, F.lit(False))


def ratio_alert(events: DataFrame, by: str, hit: Column, threshold: float, least: int = 1) -> DataFrame:
    """by, total, hits, ratio, alert (ratio above the threshold over at least so many events)."""
    out = events.groupBy(by).agg(F.count("*").alias("total"), F.count_if(F.coalesce(hit, F.lit(False))).alias("hits"))
    return out.withColumn("ratio", F.col("hits") / F.col("total")).withColumn("alert", (F.col("ratio") > threshold) & (F.col("total") >= least))


def double_extension(files: DataFrame, name: str, dimension: DataFrame) -> DataFrame:
    """Files with an alert: the last extension is executable and the one before it a document; dimension: (extension,
    type) with types SYSTEM_* and DOCUMENT_*."""
    types = dimension.groupBy("extension").agg(F.min("type").alias("type"))
    own = files.withColumn("_x", scalars.extensions(F.col(name)))
    last, second = types.toDF("_l", "_lt"), types.toDF("_s", "_st")
    out = own.join(last, F.col("_x.last") == F.col("_l"), "left").join(second, F.col("_x.second") == F.col("_s"), "left")
    alert = F.coalesce(F.col("_lt").startswith("SYSTEM_") & F.col("_st").startswith("DOCUMENT_"), F.lit(False))
    return out.withColumn("alert", alert).drop("_x", "_l", "_lt", "_s", "_st")


def priority_merge(verdicts: DataFrame, priorities: DataFrame, by: str, lower_wins: bool = True) -> DataFrame:
    """The verdict (by, source, type) of the best priority; sources without one come last, in the order of `fallback`."""
    joined = verdicts.join(small(priorities), ["source", "type"], "left")
    sign = F.col("priority") if lower_wins else -F.col("priority")
    order = F.struct(sign.isNull().cast("int").alias("a"), sign.alias("b"), F.col("fallback").alias("c"), F.col("type").alias("d"), F.col("source").alias("e"))
    return joined.groupBy(by).agg(F.min(order).alias("o")).select(by, F.col("o.d").alias("type"), F.col("o.e").alias("source"))


def customer_override(verdicts: DataFrame, customer: DataFrame, key: str, override: bool = True) -> DataFrame:
    """verdicts (key, classification) with the customer's entry (key, entry), which wins or only fills in."""
    unique = customer.groupBy(key).agg(F.max("entry").alias("_entry"))
    both = ("_entry", "classification") if override else ("classification", "_entry")
    return verdicts.join(unique, key, "left").withColumn("classification", F.coalesce(*both)).withColumn("from_customer", F.coalesce(F.col("classification") == F.col("_entry"), F.lit(False))).drop("_entry")


def expiry(now_ms: Column, classification: Column, ttl_ms: Column | None = None) -> Column:
    """Expiration in epoch milliseconds: the given lifetime, at most the longest; unknown has its own; else the default."""
    given = F.when(ttl_ms.isNotNull(), F.least(ttl_ms, F.lit(rules.TTL_MOST))) if ttl_ms is not None else F.lit(None).cast("long")
    return now_ms + F.coalesce(given, F.when(classification == "unknown", F.lit(rules.TTL_UNKNOWN)), F.lit(rules.TTL_DEFAULT))


def expired(expiration_ms: Column, as_of_ms: Column) -> Column:
    return F.coalesce(expiration_ms < as_of_ms, F.lit(True))


def products(files: DataFrame, name: str, dimension: DataFrame) -> DataFrame:
    """Files with the product of their name, from a dimension (file_name, product)."""
    unique = dimension.groupBy(F.lower("file_name").alias("_n")).agg(F.min("product").alias("product"))
    return files.join(unique, F.lower(scalars.basename(F.col(name))) == F.col("_n"), "left").drop("_n")
