"""Registered queries and the SQL each is held against. The driver's tables stand in for reputation tables of the same
shape; every column is named alike on both sides."""

from __future__ import annotations

import bz2
import io
import struct
import tarfile
import uuid
from collections.abc import Callable

import pyarrow as pa
from pyarrow import fs as stores
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry import sinks
from quarry.functions import scalars
from quarry.operators import batches, classify, dedup, enrich, filters, funnel
from quarry.plans import pipelines
from quarry.sources import archive, bson
from quarry.streaming import feed

_FOUND: dict[str, tuple[Callable[[SparkSession, str], DataFrame], str | None]] = {}


def query(sql: str | None) -> Callable:
    def add(f: Callable) -> Callable:
        _FOUND[f.__name__] = (f, sql)
        return f

    return add


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Newest event of each user, of the kinds in a keep-set."""
    return filters.keep_set(dedup_newest_first(spark, sf_dir), "event_type", ("click", "error"))


@query("SELECT user_id, event_id, ts, event_type FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) r FROM events) WHERE r = 1 AND user_id IS NOT NULL")
def dedup_newest_first(spark, sf_dir):
    events = table(spark, sf_dir, "events").select("user_id", "event_id", "ts", "event_type")
    return dedup.newest_first(events, "user_id", [F.desc("ts"), F.desc("event_id")])


@query("SELECT k, event_id FROM (SELECT nullif(user_id % 10, 0) k, event_id, row_number() OVER (PARTITION BY user_id % 10 ORDER BY ts DESC, event_id DESC) r FROM events) WHERE r = 1 AND k IS NOT NULL")
def dedup_drop_null_key(spark, sf_dir):
    events = table(spark, sf_dir, "events").select(F.nullif(F.col("user_id") % 10, F.lit(0)).alias("k"), "event_id", "ts")
    return dedup.newest_first(events, "k", [F.desc("ts"), F.desc("event_id")]).select("k", "event_id")


@query("SELECT CASE WHEN k IS NULL OR k = '' THEN 'no_key' WHEN NOT regexp_matches(k, '^[0-9A-Fa-f]{2}$') THEN 'bad_key' WHEN r = 1 THEN 'new' ELSE 'dup' END AS reason, count(*) AS n FROM (SELECT k, row_number() OVER (PARTITION BY k ORDER BY event_id DESC) r FROM (SELECT event_id, CASE user_id % 4 WHEN 0 THEN NULL WHEN 1 THEN '' WHEN 2 THEN 'z' || user_id ELSE lpad(CAST(user_id % 90 AS VARCHAR), 2, '0') END k FROM events)) GROUP BY 1")
def dedup_reasons(spark, sf_dir):
    kind, text = F.col("user_id") % 4, (F.col("user_id") % 90).cast("string")
    key = F.when(kind == 1, "").when(kind == 2, F.concat(F.lit("z"), "user_id")).when(kind == 3, F.lpad(text, 2, "0"))
    events = table(spark, sf_dir, "events").select(key.alias("k"), "event_id")
    return funnel.by_reason(dedup.dedup_reasons(events, "k", [F.desc("event_id")], 2))


@query("SELECT text, min(doc_id) AS doc_id FROM documents WHERE text <> '' GROUP BY text")
def dedup_text(spark, sf_dir):
    return dedup.newest_first(table(spark, sf_dir, "documents").select("text", "doc_id"), "text", [F.asc("doc_id")])


@query("SELECT o_orderkey, o_custkey FROM orders o WHERE NOT EXISTS (SELECT 1 FROM orders h WHERE h.o_orderkey % 2 = 0 AND h.o_custkey = o.o_custkey)")
def history_anti(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    return dedup.without_history(orders, orders.where("o_orderkey % 2 = 0"), "o_custkey")


@query("SELECT event_id, CAST(trunc(value) AS INT) AS positives FROM events WHERE trunc(coalesce(value, 0)) > 0")
def threshold_trunc(spark, sf_dir):
    events = table(spark, sf_dir, "events")
    return events.where(filters.detected(F.col("value"))).select("event_id", scalars.truncated(F.col("value")).alias("positives"))


@query("SELECT l_orderkey, l_linenumber, CAST(least(greatest(coalesce(CAST(trunc(l_extendedprice / 100 - 100) AS INT), 0), 0), 255) AS INT) AS positives FROM lineitem")
def clamp_null_zero(spark, sf_dir):
    n = scalars.truncated(F.col("l_extendedprice") / 100 - 100)
    return table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", scalars.clamped_or_zero(n).alias("positives"))


@query("SELECT c_custkey, CASE WHEN c_custkey % 7 = 0 THEN NULL ELSE least(greatest(CAST(trunc(c_acctbal / 10) AS INT), 0), 255) END AS positives FROM customer")
def clamp_null_null(spark, sf_dir):
    n = F.when(F.col("c_custkey") % 7 != 0, scalars.truncated(F.col("c_acctbal") / 10))
    return table(spark, sf_dir, "customer").select("c_custkey", scalars.clamped(n).alias("positives"))


@query("SELECT event_id, event_type FROM events WHERE event_type IN ('click', 'purchase')")
def keep_set(spark, sf_dir):
    return filters.keep_set(table(spark, sf_dir, "events").select("event_id", "event_type"), "event_type", ("click", "purchase"))


@query("SELECT event_id, t FROM (SELECT event_id, CASE event_id % 3 WHEN 0 THEN 'Malware' WHEN 1 THEN 'malware' END t FROM events) WHERE t IN ('malware', 'ransomware', 'unwanted', 'hacktool')")
def keep_set_case(spark, sf_dir):
    k = F.col("event_id") % 3
    return filters.keep_set(table(spark, sf_dir, "events").select("event_id", F.when(k == 0, "Malware").when(k == 1, "malware").alias("t")), "t")


_WORDS_SQL = "CASE event_id % 7 WHEN 0 THEN 'pua' WHEN 1 THEN 'Unwanted' WHEN 2 THEN 'malware' WHEN 3 THEN '' WHEN 4 THEN 'whitelist' WHEN 5 THEN 'Sinkholed' END"


def _words(key: str = "event_id"):
    k = F.col(key) % 7
    return F.when(k == 0, "pua").when(k == 1, "Unwanted").when(k == 2, "malware").when(k == 3, "").when(k == 4, "whitelist").when(k == 5, "Sinkholed")


@query(f"SELECT event_id, CASE WHEN upper(c) IN ('PUA', 'UNWANTED') THEN 'UNWANTED' WHEN upper(c) IN ('MALWARE') THEN upper(c) ELSE 'UNKNOWN' END AS target, CASE WHEN upper(c) IN ('UNWANTED', 'MALWARE', 'WHITELIST', 'SINKHOLED') THEN upper(c) ELSE 'MALWARE' END AS domain FROM (SELECT event_id, {_WORDS_SQL} c FROM events)")
def enum_map_default(spark, sf_dir):
    events = table(spark, sf_dir, "events").withColumn("c", _words())
    return events.select("event_id", scalars.target_class(F.col("c")).alias("target"), scalars.domain_class(F.col("c")).alias("domain"))


@query("SELECT p_partkey, nullif(lower(trim(CASE WHEN p_partkey % 5 = 0 THEN '   ' ELSE '  ' || p_brand || ' ' END)), '') AS brand FROM part")
def normalize_empty(spark, sf_dir):
    padded = F.when(F.col("p_partkey") % 5 == 0, F.lit("   ")).otherwise(F.concat(F.lit(" \t"), "p_brand", F.lit("\n")))
    return table(spark, sf_dir, "part").select("p_partkey", scalars.normalized(padded).alias("brand"))


@query("SELECT event_id, lower(event_type) AS class FROM events WHERE event_id % 3 <> 0 UNION ALL SELECT event_id, NULL FROM events WHERE event_id % 3 = 0")
def kv_parse(spark, sf_dir):
    text = F.when(F.col("event_id") % 3 != 0, F.concat(F.lit("a=1;maliciousClassification= "), F.upper("event_type"), F.lit(" ;b=2"))).otherwise("a=1;b=2")
    return table(spark, sf_dir, "events").select("event_id", scalars.value_of(text).alias("class"))


@query("SELECT event_id, CAST(json_extract_string(props, '$.k') AS VARCHAR) AS k, 'none' AS absent FROM events")
def json_field_default(spark, sf_dir):
    return table(spark, sf_dir, "events").select("event_id", scalars.text_value("k", F.col("props"), "none").alias("k"), scalars.text_value("missing", F.col("props"), "none").alias("absent"))


@query("SELECT l_orderkey, string_agg(CASE WHEN l_returnflag <> 'N' THEN l_linenumber || ':' || l_linestatus END, ';' ORDER BY l_linenumber, l_linestatus) AS names FROM lineitem GROUP BY l_orderkey")
def detection_string(spark, sf_dir):
    scan = F.struct(F.col("l_linenumber").alias("key"), F.struct(F.when(F.col("l_returnflag") != "N", "true").otherwise("false").alias("detected"), F.col("l_linestatus").alias("result")).alias("value"))
    grouped = table(spark, sf_dir, "lineitem").groupBy("l_orderkey").agg(F.sort_array(F.collect_list(scan)).alias("s"))
    entries = F.transform("s", lambda e: F.struct(e["key"].cast("string").alias("key"), e["value"].alias("value")))
    return grouped.select("l_orderkey", scalars.detections_of(entries).alias("names"))


@query("SELECT l_orderkey, bool_or(l_quantity > 45) AS any_large, max(l_quantity) AS most FROM lineitem GROUP BY l_orderkey")
def array_any_max(spark, sf_dir):
    grouped = table(spark, sf_dir, "lineitem").groupBy("l_orderkey").agg(F.collect_list("l_quantity").alias("q"))
    return grouped.select("l_orderkey", filters.any_above(F.col("q"), 45).alias("any_large"), filters.most(F.col("q")).alias("most"))


@query("SELECT d.doc_id, d.lang, l.quality FROM documents d LEFT JOIN (SELECT doc_id, max(quality) quality FROM labels GROUP BY doc_id) l ON d.doc_id = l.doc_id")
def enrich_left(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "lang")
    return enrich.left_enrich(docs, enrich.small(table(spark, sf_dir, "labels").select("doc_id", "quality")), "doc_id", "quality")


@query("SELECT count(*) AS rows, count(l.quality) AS filled, 100.0 * count(l.quality) / count(*) AS percent FROM documents d LEFT JOIN (SELECT doc_id, max(quality) quality FROM labels GROUP BY doc_id) l ON d.doc_id = l.doc_id")
def enrich_fill_rate(spark, sf_dir):
    return enrich.fill_rate(enrich_left(spark, sf_dir), "quality")


@query(
    "SELECT k, classification, CASE WHEN classification = own THEN 'own' ELSE 'lookup' END AS origin FROM (SELECT k, own, CASE WHEN own IN ('indifferent', 'unknown', 'whitelist') THEN NULL WHEN own IN ('malware', 'hacktool') THEN own WHEN found IN ('malware', 'suspicious') THEN found END AS classification "
    "FROM (SELECT event_id AS k, CASE event_id % 5 WHEN 0 THEN 'whitelist' WHEN 1 THEN 'malware' WHEN 2 THEN 'pua' WHEN 3 THEN '' ELSE 'hacktool' END own, CASE event_id % 3 WHEN 0 THEN 'suspicious' WHEN 1 THEN 'malware' ELSE 'sinkholed' END found FROM events)) WHERE classification IS NOT NULL"
)
def resolve_precedence(spark, sf_dir):
    i = F.col("event_id")
    events = table(spark, sf_dir, "events")
    own = F.when(i % 5 == 0, " Whitelist").when(i % 5 == 1, "Malware ").when(i % 5 == 2, "pua").when(i % 5 == 3, "").otherwise("hacktool")
    found = F.when(i % 3 == 0, "suspicious").when(i % 3 == 1, "malware").otherwise("sinkholed")
    rows, lookup = events.select(i.cast("string").alias("k"), own.alias("own")), events.select(i.cast("string").alias("k"), found.alias("found"))
    return enrich.resolve(rows, lookup, "k", "own", "found").select(F.col("k").cast("long").alias("k"), "classification", "origin")


@query("SELECT c_custkey AS name FROM customer c WHERE NOT EXISTS (SELECT 1 FROM orders o WHERE o.o_custkey = c.c_custkey AND o.o_orderstatus = 'F') AND EXISTS (SELECT 1 FROM orders o WHERE o.o_custkey = c.c_custkey AND o.o_orderstatus = 'O')")
def file_eligibility(spark, sf_dir):
    orders = table(spark, sf_dir, "orders")
    named = lambda s: orders.where(F.col("o_orderstatus") == s).select(F.col("o_custkey").alias("name"))
    return enrich.eligible(table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("name")), named("F"), named("O"))


@query("SELECT k, v FROM (SELECT o_custkey k, o_orderkey v, row_number() OVER (PARTITION BY o_custkey ORDER BY CASE WHEN o_orderkey % 2 = 0 THEN 0 ELSE 1 END, o_orderkey) r FROM orders WHERE o_orderkey % 4 <> 0 OR o_orderkey % 2 <> 0) WHERE r = 1")
def insert_ignore(spark, sf_dir):
    rows = table(spark, sf_dir, "orders").where("o_orderkey % 4 <> 0").select(F.col("o_custkey").alias("k"), F.col("o_orderkey").alias("v"))
    empty = rows.limit(0)
    once = dedup.insert_ignore(empty, rows.where("v % 2 = 0"), "k", [F.asc("v")])
    return dedup.insert_ignore(once, rows.where("v % 2 <> 0"), "k", [F.asc("v")])


@query("SELECT user_id, arg_max(event_type, event_id) AS event_type FROM events GROUP BY user_id")
def last_write_wins(spark, sf_dir):
    return dedup.last_write_wins(table(spark, sf_dir, "events"), "user_id", "event_type", F.col("event_id"))


_UPSERT = "SELECT k, v, t FROM (SELECT *, row_number() OVER (PARTITION BY k ORDER BY t DESC, v DESC) r FROM ({})) WHERE r = 1"
_BASE_SQL, _FEED_SQL = "SELECT o_custkey k, o_orderkey v, o_orderdate t FROM orders WHERE o_custkey % 3 = 0", "SELECT o_custkey k, -o_orderkey v, o_orderdate t FROM orders WHERE o_orderkey % 2 = 0"


def _base_feed(spark, sf_dir):
    o = table(spark, sf_dir, "orders").select(F.col("o_custkey").alias("k"), F.col("o_orderkey").alias("v"), F.col("o_orderdate").alias("t"))
    return o.where("k % 3 = 0"), o.where("v % 2 = 0").withColumn("v", -F.col("v"))


@query(_UPSERT.format(f"{_BASE_SQL} UNION ALL {_FEED_SQL}"))
def upsert_latest(spark, sf_dir):
    return dedup.upsert_latest(*_base_feed(spark, sf_dir), "k", [F.desc("t"), F.desc("v")])


@query(_UPSERT.format(f"{_BASE_SQL} UNION ALL {_FEED_SQL} AND o_custkey % 3 = 0"))
def update_existing_only(spark, sf_dir):
    return dedup.update_existing(*_base_feed(spark, sf_dir), "k", [F.desc("t"), F.desc("v")])


@query("SELECT o_orderkey, CASE WHEN o_orderkey % 4 = 0 THEN NULL ELSE strftime(o_orderdate, '%Y%m%d') END AS part, CASE WHEN o_orderkey % 4 = 0 THEN NULL ELSE CAST(o_orderdate AS DATE) END AS day FROM orders")
def partition_date(spark, sf_dir):
    text = F.when(F.col("o_orderkey") % 4 == 0, F.date_format("o_orderdate", "dd/MM/yyyy")).otherwise(F.date_format("o_orderdate", "yyyy-MM-dd HH:mm:ss"))
    return table(spark, sf_dir, "orders").select("o_orderkey", scalars.partition_date(text).alias("part"), scalars.to_date(text).alias("day"))


@query("SELECT strftime(d, '%Y%m%d') AS day FROM generate_series(TIMESTAMP '2024-02-27', TIMESTAMP '2024-03-02', INTERVAL 1 DAY) t(d)")
def date_spine(spark, sf_dir):
    return batches.days(spark, "2024-02-27", "2024-03-02")


@query("SELECT strftime(t, '%Y%m%d') AS day, strftime(t, '%Y%m%d/%Y%m%dT%H%M') AS path FROM generate_series(TIMESTAMP '2024-02-29 00:00', TIMESTAMP '2024-03-01 23:59', INTERVAL 1 MINUTE) s(t)")
def minute_paths(spark, sf_dir):
    return batches.minute_paths(batches.days(spark, "2024-02-29", "2024-03-01"))


@query("SELECT min(d) AS next_date FROM (SELECT DISTINCT CAST(ts AS DATE) d FROM events) WHERE d NOT IN (SELECT DISTINCT CAST(ts AS DATE) FROM events WHERE ts < (SELECT min(ts) + INTERVAL 3 DAY FROM events)) AND d < (SELECT min(s) FROM (SELECT CAST(g AS DATE) s FROM generate_series(TIMESTAMP '2024-01-01', TIMESTAMP '2024-01-31', INTERVAL 1 DAY) t(g)) WHERE s NOT IN (SELECT DISTINCT CAST(ts AS DATE) FROM events)) OR d IS NULL")
def next_unprocessed_date(spark, sf_dir):
    events = table(spark, sf_dir, "events").select("ts", F.col("ts").cast("date").alias("date"))
    edge = events.agg((F.min("ts") + F.expr("INTERVAL 3 DAY")).alias("e"))
    done = events.join(F.broadcast(edge), F.col("ts") < F.col("e"), "left_semi")  # one row
    return batches.next_unprocessed(events, done, "2024-01-01")


@query("SELECT o_orderkey, CAST((row_number() OVER (ORDER BY o_orderkey) - 1) // 700 AS BIGINT) AS chunk FROM orders")
def chunk_number(spark, sf_dir):
    return batches.chunk_numbers(table(spark, sf_dir, "orders").select("o_orderkey"), "o_orderkey", 700, 3000)


@query("SELECT o_orderkey, 'r0' || (o_orderkey % 6 + 1) AS shard FROM orders")
def union_shards(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").select("o_orderkey")
    return pipelines.union([orders.where(F.col("o_orderkey") % 6 == i).withColumn("shard", F.lit(f"r0{i + 1}")) for i in range(6)])


@query("SELECT o_orderkey % 6 AS shard, count(*) AS rows, count(*) FILTER (o_orderstatus = 'F') AS valid, count(*) FILTER (o_orderstatus <> 'F') AS invalid FROM orders GROUP BY 1")
def shard_counts(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").withColumn("shard", F.col("o_orderkey") % 6)
    return funnel.counted(orders, ("shard",), valid=F.col("o_orderstatus") == "F", invalid=F.col("o_orderstatus") != "F")


@query("SELECT count(*) FILTER (event_type = 'click') AS dl_ok, count(*) FILTER (event_type = 'view') AS dl_miss, count(*) FILTER (event_type = 'error') AS dl_err, CAST(sum(length(props)) AS BIGINT) AS bytes, count(*) AS rec_detected, (SELECT count(DISTINCT user_id) FROM events) AS rec_new, count(*) - (SELECT count(DISTINCT user_id) FROM events) AS rec_dup, CAST(0 AS BIGINT) AS rec_no_key, CAST(0 AS BIGINT) AS rec_bad_key FROM events")
def export_funnel(spark, sf_dir):
    events = table(spark, sf_dir, "events")
    kind = F.col("event_type")
    archives = events.select(F.when(kind == "click", "ok").when(kind == "view", "miss").when(kind == "error", "error").alias("status"), F.length("props").cast("long").alias("bytes"))
    keyed = events.select(F.lpad(F.hex("user_id"), 8, "0").alias("k"), "event_id")
    return funnel.export_funnel(archives, dedup.dedup_reasons(keyed, "k", [F.desc("event_id")], 8))


@query("SELECT CASE WHEN event_id % 5 = 0 THEN 'no_classification' WHEN event_id % 5 = 1 THEN 'unknown' WHEN event_id % 5 = 2 AND trunc(value) <= 0 THEN 'indifferent' ELSE 'valid' END AS reason, count(*) AS n FROM events GROUP BY 1")
def drop_reasons(spark, sf_dir):
    i = F.col("event_id") % 5
    word = F.when(i == 0, "").when(i == 1, "unknown").when(i == 2, "Indifferent").otherwise("malware")
    docs = table(spark, sf_dir, "events").select(
        F.concat(F.lit("u"), "user_id", F.lit(".example.com")).alias("_id"), F.concat(F.lit("x=1;maliciousClassification="), word).alias("response"), F.array(F.struct(scalars.truncated(F.col("value")).alias("positives"))).alias("urls")
    )
    return funnel.by_reason(filters.domain_reasons(docs))


@query("SELECT 'u' || user_id || '.example.com' AS domain, CASE WHEN event_id % 2 = 0 THEN 'AV_DETECTED' ELSE 'SINKHOLED' END AS classification, 'VIRUS_TOTAL' AS source, CASE WHEN trunc(value) > 0 THEN CAST(trunc(value) AS INT) END AS max_positives FROM events WHERE event_id % 2 = 1 OR trunc(value) > 0")
def domain_filter(spark, sf_dir):
    word = F.when(F.col("event_id") % 2 == 0, "indifferent").otherwise(" Sinkholed ")
    urls = F.array(F.struct(F.lit(0).alias("positives")), F.struct(scalars.truncated(F.col("value")).alias("positives")))
    docs = table(spark, sf_dir, "events").select(F.concat(F.lit(" U"), "user_id", F.lit(".Example.com ")).alias("_id"), F.concat(F.lit("maliciousClassification="), word, F.lit(";y")).alias("response"), urls.alias("urls"))
    return filters.domain_dump(docs)


@query("SELECT count(*) AS total, count(*) FILTER (event_type = 'error') AS kept, 100.0 * count(*) FILTER (event_type = 'error') / count(*) AS percent FROM events")
def keep_rate(spark, sf_dir):
    return enrich.keep_rate(table(spark, sf_dir, "events"), F.col("event_type") == "error")


@query("SELECT doc_id, nullif(replace(replace(replace(replace(text, '\\', '\\\\'), chr(9), ' '), chr(10), ' '), chr(13), ' '), '') AS line FROM documents")
def sanitize_tsv(spark, sf_dir):
    return table(spark, sf_dir, "documents").select("doc_id", scalars.tsv_text(F.col("text")).alias("line"))


@query("SELECT page_id, lower(regexp_extract(url, '^[a-z]+://([^/?#]+)', 1)) AS domain FROM pages")
def domain_normalize(spark, sf_dir):
    host = F.regexp_extract("url", "^[a-z]+://([^/?#]+)", 1)
    return table(spark, sf_dir, "pages").select("page_id", scalars.domain_name(F.concat(F.lit(" \t"), F.upper(host), F.lit(" "))).alias("domain"))


@query("SELECT c_custkey, coalesce(nullif(CASE WHEN c_custkey % 3 = 0 THEN c_name ELSE '' END, ''), nullif(CASE WHEN c_custkey % 3 = 1 THEN c_mktsegment END, ''), CAST(c_custkey AS VARCHAR)) AS k FROM customer")
def hash_key_choice(spark, sf_dir):
    k = F.col("c_custkey") % 3
    return table(spark, sf_dir, "customer").select("c_custkey", scalars.hash_key(F.when(k == 0, F.col("c_name")).otherwise(""), F.when(k == 1, F.col("c_mktsegment")), F.col("c_custkey").cast("string")).alias("k"))


@query("SELECT p_partkey, md5(p_name) AS digest, CAST(16 AS INT) AS key_size FROM part")
def hex_roundtrip(spark, sf_dir):
    key = scalars.key_bytes(F.md5(F.col("p_name").cast("binary")), 32)
    return table(spark, sf_dir, "part").select("p_partkey", F.lower(F.hex(key)).alias("digest"), F.octet_length(key).alias("key_size"))


_SCORES_SQL = "SELECT l_orderkey AS k, l_returnflag AS type, sum((CASE l_returnflag WHEN 'R' THEN 4 WHEN 'A' THEN 2 ELSE 1 END) * (l_suppkey % 4)) AS score FROM lineitem GROUP BY 1, 2"


def _scores(spark, sf_dir):
    lines = table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("k"), F.col("l_returnflag").alias("type"), F.col("l_suppkey").alias("engine"))
    factors = spark.createDataFrame([("R", 4), ("A", 2), ("N", 1)], "type string, factor int")
    qualities = table(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("engine"), (F.col("s_suppkey") % 4).alias("quality"))
    return classify.weighted_scores(lines, factors, qualities, "k")


@query(f"SELECT k, type, CAST(score AS BIGINT) AS score FROM ({_SCORES_SQL})")
def weighted_score(spark, sf_dir):
    return _scores(spark, sf_dir)


@query(f"SELECT k, type, CAST(score AS BIGINT) AS score FROM (SELECT *, row_number() OVER (PARTITION BY k ORDER BY score DESC, CASE type WHEN 'N' THEN 0 WHEN 'R' THEN 1 ELSE 2 END) r FROM ({_SCORES_SQL})) WHERE r = 1")
def argmax_type(spark, sf_dir):
    ranks = spark.createDataFrame([("N", 0), ("R", 1), ("A", 2)], "type string, rank int")
    return classify.best_type(_scores(spark, sf_dir), ranks, "k")


@query("SELECT l_orderkey AS k, string_agg(DISTINCT l_returnflag || l_linestatus, ',' ORDER BY l_returnflag || l_linestatus) AS subtypes FROM lineitem GROUP BY 1")
def subtype_set(spark, sf_dir):
    lines = table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("k"), F.array(F.concat("l_returnflag", "l_linestatus")).alias("subtypes"))
    return classify.subtype_sets(lines, ["k"], "subtypes").select("k", F.array_join("subtypes", ",").alias("subtypes"))


@query(
    "SELECT k, type, CAST(score AS BIGINT) AS score, subtypes FROM (SELECT *, row_number() OVER (PARTITION BY k ORDER BY score DESC, CASE type WHEN 'ransomware' THEN 0 ELSE 1 END) r FROM "
    "(SELECT user_id AS k, CASE WHEN event_type = 'error' THEN 'ransomware' ELSE 'malware' END AS type, sum(CASE WHEN event_type = 'error' THEN 3 ELSE 1 END * (event_id % 3 + 1)) AS score, string_agg(DISTINCT CASE WHEN event_type = 'error' THEN 'ransom' WHEN event_type = 'click' THEN 'trojan' ELSE 'worm' END, ',' ORDER BY CASE WHEN event_type = 'error' THEN 'ransom' WHEN event_type = 'click' THEN 'trojan' ELSE 'worm' END) AS subtypes "
    "FROM (SELECT DISTINCT user_id, event_type, event_id % 3 AS event_id FROM events) GROUP BY 1, 2)) WHERE r = 1"
)
def multi_engine(spark, sf_dir):
    scans = table(spark, sf_dir, "events").select(F.col("user_id").alias("k"), F.concat(F.lit("e"), F.col("event_id") % 3).alias("engine"), F.col("event_type").alias("result")).distinct()
    patterns = spark.createDataFrame([(0, "^error$", "ransomware", "ransom"), (1, "^cl", "malware", "trojan"), (2, ".", "malware", "worm")], "ordinal int, pattern string, type string, subtype string")
    factors = spark.createDataFrame([("ransomware", 3), ("malware", 1)], "type string, factor int")
    qualities = spark.createDataFrame([("e0", 1), ("e1", 2), ("e2", 3)], "engine string, quality int")
    best = classify.multi_engine(scans, patterns, factors, qualities, classify.priority_table(spark), "k")
    return best.select("k", "type", F.col("score").cast("long").alias("score"), F.array_join("subtypes", ",").alias("subtypes"))


@query("SELECT user_id, count(*) AS total, count(*) FILTER (event_type = 'error') AS hits, count(*) FILTER (event_type = 'error') / count(*) AS ratio, count(*) FILTER (event_type = 'error') / count(*) > 0.2 AND count(*) >= 3 AS alert FROM events GROUP BY user_id")
def nx_ratio(spark, sf_dir):
    return classify.ratio_alert(table(spark, sf_dir, "events"), "user_id", F.col("event_type") == "error", 0.2, 3)


@query("SELECT count(*) AS total, count(*) FILTER (event_type = 'error' AND value < 10) AS kept, 100.0 * count(*) FILTER (event_type = 'error' AND value < 10) / count(*) AS percent FROM events")
def confirmed_ratio(spark, sf_dir):
    dns = F.when(F.col("event_type") == "error", "unresolved").otherwise("indifferent")
    report = F.when(F.col("value") < 10, F.when(F.col("event_id") % 2 == 0, "unknown").otherwise("unresolved")).otherwise("indifferent")
    return enrich.keep_rate(table(spark, sf_dir, "events"), classify.confirmed_unresolved(dns, report, F.lit(True)))


@query("SELECT user_id, type, source FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY p NULLS LAST, f, type, source) r FROM (SELECT user_id, event_type AS type, 's' || (event_id % 3) AS source, event_id % 3 AS f, CASE WHEN event_type = 'error' AND event_id % 3 = 2 THEN 0 WHEN event_type = 'click' AND event_id % 3 = 1 THEN 1 END AS p FROM events)) WHERE r = 1")
def priority_merge(spark, sf_dir):
    i = F.col("event_id") % 3
    verdicts = table(spark, sf_dir, "events").select("user_id", F.col("event_type").alias("type"), F.concat(F.lit("s"), i).alias("source"), i.alias("fallback"))
    priorities = spark.createDataFrame([("s2", "error", 0), ("s1", "click", 1)], "source string, type string, priority int")
    return classify.priority_merge(verdicts, priorities, "user_id")


@query("SELECT o_orderkey, coalesce(c.entry, o.o_orderstatus) AS classification, coalesce(c.entry IS NOT NULL, false) AS from_customer FROM orders o LEFT JOIN (SELECT c_custkey, 'blocked' AS entry FROM customer WHERE c_custkey % 5 = 0) c ON o.o_custkey = c.c_custkey")
def customer_override(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").select("o_orderkey", F.col("o_custkey").alias("key"), F.col("o_orderstatus").alias("classification"))
    entries = table(spark, sf_dir, "customer").where("c_custkey % 5 = 0").select(F.col("c_custkey").alias("key"), F.lit("blocked").alias("entry"))
    return classify.customer_override(orders, entries, "key").drop("key")


@query("SELECT s_suppkey, CASE WHEN s_suppkey % 4 = 0 THEN 'unresolved' WHEN n.n_nationkey IS NOT NULL THEN 'sinkholed' ELSE 'indifferent' END AS classification, CASE WHEN s_suppkey % 8 = 0 THEN 'sldresolved' END AS subtype, CASE WHEN s_suppkey % 4 <> 0 THEN n.n_name END AS entity FROM supplier s LEFT JOIN nation n ON s.s_nationkey = n.n_nationkey AND n.n_regionkey = 1")
def sinkhole_match(spark, sf_dir):
    dns = table(spark, sf_dir, "supplier").select("s_suppkey", F.when(F.col("s_suppkey") % 4 != 0, F.col("s_nationkey").cast("string")).alias("ip"), F.when(F.col("s_suppkey") % 8 == 0, "example.com").alias("sld"))
    holes = table(spark, sf_dir, "nation").where("n_regionkey = 1").select(F.col("n_nationkey").cast("string").alias("identifier"), F.col("n_name").alias("entity"))
    return classify.dns_verdicts(dns, holes).select("s_suppkey", "classification", "subtype", "entity")


@query("SELECT p_partkey, p_partkey % 3 = 0 AS alert FROM part")
def double_extension(spark, sf_dir):
    i = F.col("p_partkey") % 3
    names = table(spark, sf_dir, "part").select("p_partkey", F.concat(F.replace("p_name", F.lit("."), F.lit("")), F.when(i == 0, ".PDF.exe").when(i == 1, ".2024.exe").otherwise(".exe.pdf")).alias("name"))
    dimension = spark.createDataFrame([("exe", "SYSTEM_EXECUTABLE"), ("pdf", "DOCUMENT_PDF"), ("2024", "DOCUMENT_X")], "extension string, type string")
    return classify.double_extension(names, "name", dimension).select("p_partkey", "alert")


@query("SELECT event_id, event_type AS type, 'virus,trojan' AS subtypes, CAST(event_id AS DOUBLE) AS score1, CAST(14.35 AS DOUBLE) AS score2, 'NONE' AS product_type, 'null' AS product FROM events")
def summary_grammar(spark, sf_dir):
    text = F.concat("event_type", F.lit(".virus.trojan("), F.col("event_id").cast("string"), F.lit(",14.35);NONE.null"))
    s = table(spark, sf_dir, "events").select("event_id", scalars.summary_parts(text).alias("s"))
    return s.select("event_id", "s.type", F.array_join("s.subtypes", ",").alias("subtypes"), "s.score1", "s.score2", "s.product_type", "s.product")


@query("SELECT event_id, epoch_us(ts) // 1000 + CASE WHEN event_type = 'error' THEN 86400000 ELSE 2592000000 END AS expiration, epoch_us(ts) // 1000 + CASE WHEN event_type = 'error' THEN 86400000 ELSE 2592000000 END < epoch_ms(TIMESTAMP '2024-02-05') AS expired FROM events")
def ttl_expired(spark, sf_dir):
    ms = F.unix_millis(F.col("ts").cast("timestamp"))
    until = classify.expiry(ms, F.when(F.col("event_type") == "error", "unknown").otherwise("malware"))
    return table(spark, sf_dir, "events").select("event_id", until.alias("expiration"), classify.expired(until, F.lit(1707091200000)).alias("expired"))


@query("SELECT date_trunc('hour', ts) AS hour, count(*) AS n FROM events GROUP BY 1")
def hourly_counts(spark, sf_dir):
    return feed.hourly(table(spark, sf_dir, "events")).withColumn("hour", F.col("hour").cast("timestamp_ntz"))


@query("SELECT DISTINCT CAST(o_orderdate AS DATE) AS day FROM orders ORDER BY day DESC LIMIT 5")
def newest_dates_limit(spark, sf_dir):
    return filters.newest_dates(table(spark, sf_dir, "orders").select(F.col("o_orderdate").cast("date").alias("day")), "day", 5)


@query("SELECT k AS sha1, coalesce(r.n, 0) AS response_code FROM (SELECT DISTINCT CAST(o_custkey AS VARCHAR) k FROM orders) q LEFT JOIN (SELECT CAST(c_custkey AS VARCHAR) c, 1 AS n FROM customer WHERE c_custkey % 2 = 0) r ON q.k = r.c")
def batch_lookup(spark, sf_dir):
    wanted = table(spark, sf_dir, "orders").select(F.col("o_custkey").cast("string").alias("sha1"))
    known = table(spark, sf_dir, "customer").where("c_custkey % 2 = 0").select(F.col("c_custkey").cast("string").alias("sha1"), F.lit(1).alias("response_code"))
    return enrich.batch_lookup(wanted, known, "sha1")


@query("SELECT o_orderkey, coalesce(v.c, o_orderstatus) AS classification, CASE WHEN v.c IS NULL THEN 'score' ELSE 'verdict' END AS origin FROM orders LEFT JOIN (SELECT c_custkey, c_mktsegment c FROM customer WHERE c_custkey % 3 = 0) v ON o_custkey = c_custkey")
def combine_sources(spark, sf_dir):
    reports = table(spark, sf_dir, "orders").select("o_orderkey", F.col("o_custkey").alias("k"), F.col("o_orderstatus").alias("own"))
    verdicts = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("k"), F.col("c_mktsegment").alias("classification"))
    return enrich.combine_sources(reports, verdicts, "k", "own", F.col("k") % 3 == 0).select("o_orderkey", "classification", "origin")


@query("SELECT event_id, CASE WHEN event_id % 4 = 0 THEN 'unknown' WHEN event_id % 3 = 0 THEN 'indifferent' ELSE 'unresolved' END AS verdict FROM events")
def domain_report(spark, sf_dir):
    i, none = F.col("event_id"), F.array().cast("array<string>")
    some = F.when(i % 3 == 0, F.array(F.lit("a"))).otherwise(none)
    return table(spark, sf_dir, "events").select("event_id", classify.domain_report(F.when(i % 4 == 0, 0).otherwise(1), none, F.lit(""), some, F.lit(None).cast("array<string>"), none).alias("verdict"))


@query("SELECT p_partkey, CASE WHEN p_partkey % 2 = 0 THEN 'tool' END AS product FROM part")
def product_of_name(spark, sf_dir):
    names = table(spark, sf_dir, "part").select("p_partkey", F.concat(F.lit("/opt/x/"), F.when(F.col("p_partkey") % 2 == 0, "Tool.EXE").otherwise("other.exe")).alias("name"))
    return classify.products(names, "name", spark.createDataFrame([("tool.exe", "tool")], "file_name string, product string")).select("p_partkey", "product")


@query("SELECT '{\"n_nationkey\":' || n_nationkey || ',\"n_name\":' || CASE WHEN n_regionkey = 0 THEN 'null' ELSE '\"' || n_name || '\"' END || '}' AS value FROM nation")
def ndjson_lines(spark, sf_dir):
    return sinks.ndjson_line(table(spark, sf_dir, "nation").select("n_nationkey", F.when(F.col("n_regionkey") != 0, F.col("n_name")).alias("n_name")))


@query("SELECT md5(p_name) || md5(p_name) AS sha256, 'UNKNOWN' AS classification, 'VIRUS_TOTAL' AS source, least(p_size * 10, 255) AS positives, CAST(NULL AS DATE) AS scan_date FROM part")
def target_table(spark, sf_dir):
    digest = F.md5(F.col("p_name").cast("binary"))
    rows = table(spark, sf_dir, "part").select(
        F.concat(digest, digest).alias("sha256"), F.lit("").alias("sha1"), F.lit(None).cast("string").alias("md5"), F.lit("whitelist").alias("classification"), F.col("p_brand").alias("detection_names"), F.lit("x").alias("scan_date"), (F.col("p_size") * 10).alias("positives"), F.lit(70).alias("total")
    )
    return sinks.target_rows(rows).select(F.lower(F.hex("sha256")).alias("sha256"), "classification", "source", "positives", "scan_date")


@query("SELECT n_nationkey, n_name FROM nation")
def archive_roundtrip(spark, sf_dir):
    """Rows as lines of a bz2-compressed tar, opened again."""
    names = table(spark, sf_dir, "nation").select("n_nationkey", "n_name")

    def packed(raw: bytes) -> bytes:
        buffer = io.BytesIO()
        with tarfile.open(fileobj=buffer, mode="w") as tar:
            info = tarfile.TarInfo("lines.ndjson")
            info.size = len(raw)
            tar.addfile(info, io.BytesIO(raw))
        return bz2.compress(buffer.getvalue())

    def pack(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array([f"/f/20240101/20240101T{i:04}" for i in range(batch.num_rows)]), pa.array([packed(x.encode()) for x in batch.column("value").to_pylist()], pa.binary())], names=["path", "content"])

    lines = sinks.ndjson_line(names).mapInArrow(pack, "path string, content binary")
    opened = archive.opened(lines).select(F.explode("lines").alias("line"))
    return opened.select(F.from_json("line", "n_nationkey long, n_name string").alias("r")).select(F.col("r.n_nationkey").cast(names.schema["n_nationkey"].dataType).alias("n_nationkey"), "r.n_name")


@query("SELECT r_regionkey AS id, r_name AS name FROM region")
def bson_roundtrip(spark, sf_dir):
    """Rows as a BSON dump in the shared folder, read again in ranges of a few bytes."""
    rows = table(spark, sf_dir, "region").select("r_regionkey", "r_name").orderBy("r_regionkey").collect()  # five rows
    text = lambda name, value: b"\x02" + name + b"\0" + struct.pack("<i", len(value.encode()) + 1) + value.encode() + b"\0"
    bodies = [text(b"_id", str(r["r_regionkey"])) + text(b"name", r["r_name"]) for r in rows]
    path = f"{sinks.shared_dir(spark)}/region-{uuid.uuid4().hex}.bson"
    store, name = stores.FileSystem.from_uri(path)
    with store.open_output_stream(name) as f:
        f.write(b"".join(struct.pack("<i", len(b) + 5) + b + b"\0" for b in bodies))
    spark.dataSource.register(bson.BsonSource)
    docs = spark.read.format("bson_dump").option("splitBytes", 64).load(path)
    found = docs.select(F.from_json("doc", "_id string, name string").alias("d"))
    return found.select(F.col("d._id").cast(table(spark, sf_dir, "region").schema["r_regionkey"].dataType).alias("id"), "d.name")


@query("SELECT date_trunc('hour', ts) AS hour, count(*) AS n FROM events GROUP BY 1")
def stream_available_now(spark, sf_dir):
    """The hourly counts of events read as a stream, everything available at once."""
    schema = table(spark, sf_dir, "events").schema
    stream = spark.readStream.schema(schema).option("pathGlobFilter", "events.parquet").parquet(sf_dir)
    name = f"hours_{uuid.uuid4().hex}"
    counted = feed.collect_stream(feed.hourly(stream), name, f"{sinks.shared_dir(spark)}/{name}", "complete")
    return counted.withColumn("hour", F.col("hour").cast("timestamp_ntz"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {name: f for name, (f, _) in _FOUND.items()}


def oracle_sql() -> dict[str, str]:
    return {name: sql for name, (_, sql) in _FOUND.items() if sql}
