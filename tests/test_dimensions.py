"""Dimension collections into the operators that use them."""

import json

from pyspark.sql import functions as F

from quarry.functions import rules
from quarry.operators import classify, funnel
from quarry.sources import dimensions, tables


def put(tmp_path, name, rows):
    (tmp_path / f"{name}.ndjson").write_text("\n".join(map(json.dumps, rows)))
    return str(tmp_path / f"{name}.ndjson")


def test_dns_with_sinkholes(spark, tmp_path):
    rows = [{"_id": "a.example", "value": {"resolvedIpAddress": "192.0.2.1"}}, {"_id": "b.example", "value": {"resolvedSecondLevelDomain": "s"}}, {"_id": "c", "value": {"isInternalDomain": True}}]
    dns = dimensions.dns(dimensions.read(spark, "domain_dns", put(tmp_path, "dns", rows)))
    holes = dimensions.sinkholes(dimensions.read(spark, "sinkholes", put(tmp_path, "h", [{"_id": {"identifier": "192.0.2.1"}, "value": {"type": "ip", "entity": "lab"}}])))
    out = {r.domain: (r.classification, r.subtype, r.entity) for r in classify.dns_verdicts(dns, holes).collect()}
    assert out == {"a.example": ("sinkholed", None, "lab"), "b.example": ("unresolved", "sldresolved", None)}


def test_weights_and_ties(spark, tmp_path):
    doc = {"true_positive_type_factors": {"ransomware": 1.0, "malware": 1.0}, "anti_virus_engine_factors": {"E": 2.0, "F": 2.0}, "detection_score_threshold": 1.5}
    factors, qualities, threshold = dimensions.engine_weights(dimensions.read(spark, "engine_weights", put(tmp_path, "w", [doc])))
    scans = spark.createDataFrame([("k", "E", "Ransom.A"), ("k", "F", "Trojan.B"), ("n", "G", "Trojan.B")], "sha1 string, engine string, result string")
    patterns = spark.createDataFrame([(0, "(?i)ransom", "ransomware", "ransom"), (1, "(?i)trojan", "malware", "trojan")], "ordinal int, pattern string, type string, subtype string")
    out = classify.multi_engine(scans, patterns, factors, qualities, classify.priority_table(spark), threshold=threshold).collect()
    assert [tuple(r) for r in out] == [("k", "ransomware", 2.0, ["ransom"])]


def test_priorities_tokens_and_ttl(spark, tmp_path):
    pri = dimensions.decision_priority(dimensions.read(spark, "decision_priority", put(tmp_path, "p", [{"cpType": "token", "maliciousType": "Malware", "priority": 1}, {"cpType": "feed", "maliciousType": "malware", "priority": 9}])))
    tok = dimensions.read(spark, "tokens", put(tmp_path, "t", [{"_id": "k", "value": {"maliciousType": "Malware", "source": "token", "expiration": 10}}, {"_id": "old", "value": {"maliciousType": "x", "source": "token", "expiration": 1}}]))
    verdicts = dimensions.token_verdicts(tok, 5).withColumn("fallback", F.lit(0)).unionByName(spark.createDataFrame([("k", "malware", "feed", 1)], "key string, type string, source string, fallback int"))
    assert [tuple(r) for r in classify.priority_merge(verdicts, pri, "key").collect()] == [("k", "malware", "token")]
    assert [tuple(r) for r in classify.priority_merge(verdicts, pri, "key", lower_wins=False).collect()] == [("k", "malware", "feed")]
    until = classify.expiry(F.lit(100), F.col("c"), F.col("t"))
    rows = spark.createDataFrame([("unknown", None), ("malware", None), ("malware", 7), ("malware", 10**15)], "c string, t long").select((until - 100).alias("d")).collect()
    assert [r.d for r in rows] == [rules.TTL_UNKNOWN, rules.TTL_DEFAULT, 7, rules.TTL_MOST]


def test_double_extension_and_tables(spark, tmp_path):
    ext = dimensions.file_extensions(dimensions.read(spark, "file_extensions", put(tmp_path, "e", [{"_id": {"extension": "EXE"}, "value": {"type": "SYSTEM_EXECUTABLE"}}, {"_id": {"extension": "pdf"}, "value": {"type": "DOCUMENT_PDF"}}, {"_id": {"extension": "b"}, "value": {"type": "DOCUMENT_X"}}, {"_id": {"extension": "2024"}, "value": {"type": "DOCUMENT_X"}}])))
    names = ["invoice.pdf.exe", "a.b.exe", "x.2024.exe", "x.exe.pdf", "plain", None]
    out = {r.n: r.alert for r in classify.double_extension(spark.createDataFrame([(n,) for n in names], "n string"), "n", ext).collect()}
    assert out == {n: n == "invoice.pdf.exe" for n in names}
    for shard in ("r01", "r02"):
        spark.createDataFrame([("a",), ("",), (None,)], "sha1 string").coalesce(1).write.parquet(str(tmp_path / "s" / shard))
    both = tables.sharded(spark, str(tmp_path / "s"), ("r01", "r02"))
    assert both.count() == 6 and sorted({r.shard for r in both.collect()}) == ["r01", "r02"] and tables.keys(both).count() == 1
    (tmp_path / "s" / "r01" / "bad.parquet").write_bytes(b"no")
    assert tables.scan(spark, str(tmp_path / "s" / "r01"), skip_corrupt=True, schema="sha1 string").count() == 3
    lines = spark.createDataFrame([(True, "malware", "lookup"), (True, None, None), (False, None, None), (True, "x", "own")], "parsed boolean, classification string, origin string")
    assert tuple(funnel.convert_counters(lines).first()) == (4, 2, 2, 1)
