"""Sinks, manifest, streams and end-to-end merging."""

import datetime as dt
import os
import sqlite3

import pytest
from pyspark.sql import functions as F

from quarry import sinks
from quarry.operators import batches, classify, dedup, enrich, funnel
from quarry.plans import pipelines
from quarry.streaming import feed


def curated(spark):
    return spark.createDataFrame(
        [("a" * 64, "b" * 40, None, 300, -5, "2020-10-19 19:28:09", "a\\b\tc\nd", "pua"), ("c" * 64, None, None, None, 7, "x", None, None)],
        "sha256 string, sha1 string, md5 string, positives int, total int, scan_date string, detection_names string, classification string",
    )


def test_tsv_and_target(spark, tmp_path):
    sinks.tsv(curated(spark).coalesce(1), str(tmp_path / "t"))
    text = "".join(p.read_text() for p in (tmp_path / "t").glob("part-*"))
    assert text.splitlines() == ["\t".join(["a" * 64, "b" * 40, r"\N", "UNWANTED", "VIRUS_TOTAL", r"a\\b c d", "2020-10-19", "255", "0"]), "\t".join(["c" * 64, r"\N", r"\N", "UNKNOWN", "VIRUS_TOTAL", r"\N", r"\N", r"\N", "7"])]
    rows = sinks.target_rows(curated(spark)).collect()
    assert rows[0].sha256 == bytearray(b"\xaa" * 32) and rows[0].scan_date == dt.date(2020, 10, 19) and rows[1].positives is None
    assert tuple(sinks.target_rows(curated(spark)).columns) == sinks.TARGET


def test_parquet_rolls_and_versions(spark, tmp_path):
    sinks.parquet(spark.range(25).coalesce(1), str(tmp_path / "p"), rows=10)
    assert len(list((tmp_path / "p").glob("*.parquet"))) == 3
    root = str(tmp_path / "v")
    sinks.publish(spark.range(3), root)
    sinks.publish(sinks.current(spark, root).withColumn("id", F.col("id") + 1), root)
    assert sorted(r.id for r in sinks.current(spark, root).collect()) == [1, 2, 3] and len(sinks.versions(spark, root)) == 2


def test_versions_survive_crashed_writes(spark, tmp_path):
    """A folder without its success marker is no version, be it the first one or a later one; old ones go."""
    root = tmp_path / "v"
    (root / "v=00000000000000000001").mkdir(parents=True)
    assert sinks.versions(spark, str(root)) == []
    with pytest.raises(FileNotFoundError):
        sinks.current(spark, str(root))
    for n in (3, 4, 5):
        sinks.publish(spark.range(n), str(root), keep=2)
    assert sinks.current(spark, str(root)).count() == 5 and len(sinks.versions(spark, str(root))) == 2 and len(list(root.iterdir())) == 2


def test_buckets_rewrite_only_what_a_merge_touches(spark, tmp_path):
    t = sinks.Buckets(spark, str(tmp_path / "b"), "k", 8, keep=1)
    rows = lambda ks, v: spark.createDataFrame([(k, v) for k in ks], "k long, v string")
    newest = lambda base, new: dedup.newest_first(base.unionByName(new), "k", [F.desc("v")])
    assert t.read() is None and t.merge(rows([], "a"), newest) == 0
    assert t.merge(rows(range(100), "a"), newest) == 8 and t.merge(rows([5, 200], "b"), newest) <= 2
    (tmp_path / "b" / f"v={10**19}").mkdir()  # a crashed merge
    got = {r.k: r.v for r in t.read().collect()}
    assert got == {k: "b" if k in (5, 200) else "a" for k in [*range(100), 200]}
    assert sum(len(list(p.glob("_part=*"))) for p in (tmp_path / "b").iterdir()) == 8


def test_single_file_and_bulk_load(spark, tmp_path):
    sinks.single(spark.range(40).repartition(4), str(tmp_path / "one.parquet"))
    assert (tmp_path / "one.parquet").is_file() and spark.read.parquet(str(tmp_path / "one.parquet")).count() == 40
    db, failed = str(tmp_path / "t.db"), str(tmp_path / "failed")
    with sqlite3.connect(db) as c:
        c.execute("CREATE TABLE t (id INTEGER PRIMARY KEY, v TEXT)")

    def connect():
        if not os.path.exists(failed):  # the first try fails
            open(failed, "w").close()
            raise OSError("away")
        return sqlite3.connect(db, timeout=30)

    rows = spark.createDataFrame([(i, f"v{i}") for i in range(25)] + [(3, "late")], "id long, v string").coalesce(1)
    for _ in range(2):
        sinks.bulk_load(rows, connect, "INSERT OR IGNORE INTO t VALUES (?, ?)", chunk=10, pause=0.01)
    with sqlite3.connect(db) as c:
        assert c.execute("SELECT count(*), max(v) FROM t WHERE id <> 3").fetchone() == (24, "v9") and c.execute("SELECT v FROM t WHERE id = 3").fetchone() == ("v3",)


def test_manifest_redoes_changed_input(spark, tmp_path):
    m = sinks.Manifest(spark, str(tmp_path / "m"))
    work = spark.createDataFrame([("a", 1, "x"), ("b", 2, None)], "name string, length long, version string")
    assert m.todo("filter", work).count() == 2
    m.mark("filter", work)
    assert m.todo("filter", work).count() == 0 and m.todo("load", work).count() == 2
    assert [r.name for r in m.todo("filter", work.withColumn("version", F.lit("y"))).collect()] != []


def test_loading_twice_is_loading_once(spark):
    base = spark.createDataFrame([("k", 1)], "k string, v int")
    loads = spark.createDataFrame([("k", 2), ("n", 4), ("n", 3), (None, 9)], "k string, v int")
    once = dedup.insert_ignore(base, loads, "k", [F.asc("v")])
    assert sorted(map(tuple, once.collect())) == [("k", 1), ("n", 3)]
    assert sorted(map(tuple, dedup.insert_ignore(once, loads, "k", [F.asc("v")]).collect())) == [("k", 1), ("n", 3)]


def test_order_of_input_does_not_matter(spark):
    rows = [("k", i % 5, i) for i in range(40)]
    pick = lambda r: dedup.newest_first(spark.createDataFrame(r, "k string, day int, line int"), "k", [F.desc("day"), F.desc("line")]).collect()
    assert pick(rows) == pick(rows[::-1]) == pick(sorted(rows, key=lambda r: r[2] * 7 % 13))


def test_empty_rates(spark):
    none = spark.createDataFrame([], "c string")
    assert tuple(enrich.fill_rate(none, "c").first()) == (0, 0, 0.0)
    assert tuple(enrich.keep_rate(none, F.col("c") == "x").first()) == (0, 0, 0.0)
    seen = funnel.counted(none, valid=F.col("c") == "x").first()
    assert tuple(seen) == (0, 0)


def test_eligibility_without_upstream_takes_all(spark):
    files, done = spark.createDataFrame([("a",), ("b",)], "name string"), spark.createDataFrame([("a",)], "name string")
    empty = done.limit(0)
    names = lambda df: sorted(r.name for r in df.collect())
    assert names(enrich.eligible(files, done, empty)) == ["b"] and names(enrich.eligible(files, empty, done)) == ["a"] and names(enrich.eligible(files, done, None)) == ["b"]


def test_lookup_service(spark):
    reports = spark.createDataFrame([("a", 1, "suspicious", 100), ("b", 1, "malware", 10)], "sha1 string, response_code int, own_class string, expiration long")
    store = spark.createDataFrame([("a", "hacktool")], "sha1 string, classification string")
    wanted = spark.createDataFrame([("a",), ("b",), ("z",), ("a",), ("",)], "sha1 string")
    out = {r.sha1: (r.response_code, r.classification, r.origin, r.expiration) for r in pipelines.lookup(wanted, reports, store, 50).collect()}
    assert out == {"a": (1, "hacktool", "verdict", 50 + 2_592_000_000), "b": (0, "unknown", "score", 50 + 86_400_000), "z": (0, "unknown", "score", 50 + 86_400_000)}


def test_decision_tables(spark):
    dns = spark.createDataFrame([(None, None), (None, "s"), ("1", None), ("2", "s")], "ip string, sld string")
    holes = spark.createDataFrame([("1", "hole"), ("1", "hole")], "identifier string, entity string")
    assert sorted(((r.classification, r.subtype, r.entity) for r in classify.dns_verdicts(dns, holes).collect()), key=str) == [("indifferent", None, None), ("sinkholed", None, "hole"), ("unresolved", "sldresolved", None), ("unresolved", None, None)]
    scores = spark.createDataFrame([("k", "malware", 2.0), ("k", "ransomware", 2.0), ("k", "suspicious", 1.0)], "k string, type string, score double")
    assert classify.best_type(scores, classify.priority_table(spark), "k").first().type == "ransomware"


def events(spark, path, n):
    day = dt.datetime(2024, 1, 1)
    for part in range(3):
        rows = [(i, day + dt.timedelta(minutes=17 * i), i % 7, "error" if i % 3 == 0 else "ok") for i in range(part, n, 3)]
        spark.createDataFrame(rows, "event_id long, ts timestamp, user_id long, event_type string").coalesce(1).write.mode("append").parquet(path)
    return "event_id long, ts timestamp, user_id long, event_type string"


def test_stream_equals_batch_and_is_idempotent(spark, tmp_path):
    src, root, ck = str(tmp_path / "src"), str(tmp_path / "out"), str(tmp_path / "ck")
    schema = events(spark, src, 120)
    for _ in range(2):  # the second run finds nothing new
        feed.merge_batches(feed.events_stream(spark, src, schema, 1), root, ck, "user_id", lambda: [F.desc("ts"), F.desc("event_id")]).awaitTermination()
    batch = dedup.newest_first(spark.read.parquet(src), "user_id", [F.desc("ts"), F.desc("event_id")])
    assert sorted(map(tuple, sinks.Buckets(spark, root, "user_id").read().select("event_id", "ts", "user_id", "event_type").collect())) == sorted(map(tuple, batch.collect()))
    feed.insert_batches(feed.events_stream(spark, src, schema), str(tmp_path / "all"), str(tmp_path / "ck2")).awaitTermination()
    assert spark.read.parquet(str(tmp_path / "all")).count() == 120


def test_pulls_at_an_interval(spark, tmp_path):
    src, root = str(tmp_path / "src"), str(tmp_path / "out")
    schema = events(spark, src, 30)
    running = feed.merge_batches(feed.events_stream(spark, src, schema), root, str(tmp_path / "ck"), "user_id", lambda: [F.desc("ts")], every="1 second")
    try:
        running.processAllAvailable()
        assert running.isActive and sinks.Buckets(spark, root, "user_id").read().count() == 7
    finally:
        running.stop()


def test_stateful_counters_and_first_seen(spark, tmp_path):
    src = str(tmp_path / "src")
    schema = events(spark, src, 60)
    stream = feed.settled(feed.events_stream(spark, src, schema, 10), "ts")
    out = feed.collect_stream(feed.running_ratio(stream, "user_id", F.col("event_type") == "error"), "ratio", str(tmp_path / "c1"), "complete")
    want = classify.ratio_alert(spark.read.parquet(src), "user_id", F.col("event_type") == "error", 0.5)
    assert sorted(map(tuple, out.collect())) == sorted((r.user_id, r.total, r.hits) for r in want.collect())
    hours = feed.collect_stream(feed.hourly(stream), "hours", str(tmp_path / "c2"), "complete")
    assert sorted(map(tuple, hours.collect())) == sorted(map(tuple, feed.hourly(spark.read.parquet(src)).collect()))
    first = feed.collect_stream(dedup.first_seen(feed.events_stream(spark, src, schema, 10), "user_id", "ts", "2 days"), "seen", str(tmp_path / "c3"))
    assert sorted(r.user_id for r in first.collect()) == list(range(7))


def test_lookups_never_fan_out(spark):
    rows = spark.createDataFrame([("a", None), ("b", "pua")], "sha1 string, own string")
    table = spark.createDataFrame([("a", "malware", 1), ("a", "hacktool", 2), ("b", "x", 1), ("b", "x", 1), ("", "y", 1)], "sha1 string, cls string, at int")
    assert [r.sha1 for r in enrich.resolve(rows, table, "sha1", "own", "cls").collect()] == ["a"]
    assert {r.sha1: r.classification for r in enrich.resolve(rows, table, "sha1", "own", "cls", F.col("at")).collect()}["a"] == "hacktool"
    found = enrich.batch_lookup(rows.select("sha1"), table.withColumn("response_code", F.lit(1)), "sha1", order=[F.desc("at")])
    assert sorted((r.sha1, r.cls) for r in found.collect()) == [("a", "hacktool"), ("b", "x")]


def test_reasons_rank_good_keys_only(spark):
    good = "a" * 40
    rows = spark.createDataFrame([(None, 1), (None, 2), ("", 3), ("zz", 4), ("zz", 5), (good, 6), (good, 7)], "k string, t int")
    out = dedup.dedup_reasons(rows, "k", [F.desc("t")])
    assert sorted((r.t, r.reason) for r in out.collect()) == [(1, "no_key"), (2, "no_key"), (3, "no_key"), (4, "bad_key"), (5, "bad_key"), (6, "dup"), (7, "new")]


def test_chunks_of_clustered_numbers(spark):
    """Nearly all numbers lie close together: ranges are cut at quantiles, so no window holds most rows."""
    numbers = [*range(5000), *range(10**15, 10**15 + 40), -(10**12)]
    df = spark.createDataFrame([(x,) for x in numbers], "id long").repartition(3)
    out = batches.chunk_numbers(df, "id", rows=100, window_rows=20)
    assert [r.chunk for r in out.orderBy("id").collect()] == [i // 100 for i in range(len(numbers))]
    plan = batches.chunk_numbers(df, "id", rows=100, window_rows=20)
    assert plan.count() == len(numbers) and batches.chunk_numbers(df.limit(0), "id").count() == 0


def test_late_verdicts_reach_published_rows(spark, tmp_path):
    table = sinks.Buckets(spark, str(tmp_path / "t"), "sha1", 4)
    late = spark.createDataFrame([("b", "malware"), ("zz", "pua")], "sha1 string, classification string")
    assert pipelines.late_verdicts(table, late) == 0
    rows = spark.createDataFrame([(k, 1, "unknown") for k in "abc"], "sha1 string, n int, classification string")
    table.merge(rows, lambda base, new: dedup.insert_ignore(base, new, "sha1", [F.asc("n")]))
    assert 1 <= pipelines.late_verdicts(table, late) <= 2
    assert sorted((r.sha1, r.n, r.classification) for r in table.read().collect()) == [("a", 1, "unknown"), ("b", 1, "malware"), ("c", 1, "unknown")]
