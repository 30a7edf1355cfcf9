"""Archives, BSON dumps, NDJSON and verdict lists, from fixtures made here."""

import bz2
import gzip
import io
import json
import struct
import tarfile

import pytest
from pyspark.sql import functions as F

from quarry import cli, sinks
from quarry.operators import batches, dedup, filters, funnel
from quarry.plans import pipelines
from quarry.sources import archive, bson, ndjson, tables, verdicts

H = {c: c * 64 for c in "abcdef0"}


def bundle(lines, directory=False):
    raw = "\n".join(x if isinstance(x, str) else json.dumps(x) for x in lines).encode()
    out = io.BytesIO()
    with tarfile.open(fileobj=out, mode="w") as tar:
        if directory:
            d = tarfile.TarInfo("d")
            d.type = tarfile.DIRTYPE
            tar.addfile(d)
        info = tarfile.TarInfo("d/x.json")
        info.size = len(raw)
        tar.addfile(info, io.BytesIO(raw))
    return bz2.compress(out.getvalue())


def scans(**kv):
    return {k: {"detected": d, "result": r} for k, (d, r) in kv.items()}


def report(sha="a", sha1="1" * 40, **kv):
    return {"sha256": H[sha].upper(), "sha1": sha1, "md5": "", "positives": 3, "total": 70.9, "scan_date": "2020-10-19 19:28:09"} | kv


@pytest.fixture
def feed(tmp_path):
    def put(day, minute, data):
        (tmp_path / day).mkdir(exist_ok=True)
        (tmp_path / day / f"{day}T{minute}").write_bytes(data)

    first = report(scans=scans(Z=(True, "Trojan.X"), A=(False, None), M=(True, "Worm.Y")))
    put("20240101", "0000", bundle([first, report(positives=0.5), report(positives=None), "", "not json", "[1,2]", report(sha256="a" * 63), report("b", sha1=None), report("c", sha1="zz", total=None)], directory=True))
    gone = report("d", sha1="2" * 40, positives=1)
    del gone["total"]
    put("20240101", "0001", bundle([report("e", md5="5" * 32, scans=scans(Q=(True, ""))), gone]))
    put("20240102", "2359", bundle([report("f", sha1="1" * 40, positives=9)]))
    put("20240102", "0003", bundle([first])[:60])
    return str(tmp_path)


def test_feed_records_and_statuses(spark, feed):
    scanned = archive.scan(spark, feed)
    rows = filters.feed_reports(archive.records(scanned)).orderBy("day", "minute", "line").collect()
    assert [(r.sha256[0], r.positives, r.total) for r in rows] == [("a", 3, 70), ("b", 3, 70), ("c", 3, None), ("e", 3, 70), ("d", 1, 0), ("f", 9, 70)]
    assert rows[0].detection_names == "Z:Trojan.X;M:Worm.Y" and rows[0].md5 is None and rows[3].detection_names is None
    expected = batches.minute_paths(batches.days(spark, "2024-01-01", "2024-01-02"))
    n = {r.status: r.n for r in archive.statuses(scanned, expected).groupBy("status").agg(F.count("*").alias("n")).collect()}
    assert n == {"ok": 3, "error": 1, "miss": 2876}


def test_newest_first_and_its_counters(spark, feed):
    rows = filters.feed_reports(archive.records(archive.scan(spark, feed)))
    marked = dedup.dedup_reasons(rows, "sha1", [F.desc("day"), F.desc("minute"), F.desc("line")])
    counts = {r.reason: r.n for r in funnel.by_reason(marked).collect()}
    assert counts == {"new": 2, "dup": 2, "no_key": 1, "bad_key": 1}
    out = pipelines.feed_reports(spark, feed).collect()
    assert sorted((r.sha256[0], r.date) for r in out) == [("d", "20240101"), ("f", "20240102")]
    history = spark.createDataFrame([("1" * 40,), (None,)], "sha1 string")
    assert [r.sha256[0] for r in pipelines.feed_reports(spark, feed, history).collect()] == ["d"]


def test_feed_to_curated(spark, feed):
    store = spark.createDataFrame([("1" * 40, "malware", "found"), ("2" * 40, "Malware", "found"), ("", "malware", "found")], "sha1 string, classification string, status string")
    assert [(r.sha256[0], r.classification) for r in pipelines.feed_to_curated(spark, feed, store).collect()] == [("f", "malware")]


def test_daily_runs_each_settled_day_once(spark, feed, tmp_path):
    store = spark.createDataFrame([("1" * 40, "malware", "found"), ("2" * 40, "hacktool", "found")], "sha1 string, classification string, status string")
    manifest, target = sinks.Manifest(spark, str(tmp_path / "done")), str(tmp_path / "target")
    run = lambda today: pipelines.daily(spark, feed, target, manifest, store, "2024-01-01", today)
    assert [run("2024-01-03"), run("2024-01-03"), run("2024-01-04"), run("2024-01-09")] == ["20240101", None, "20240102", None]
    assert sorted((r.sha256[0], r.classification) for r in sinks.Buckets(spark, target, "sha256").read().collect()) == [("d", "hacktool"), ("e", "malware"), ("f", "malware")]
    assert pipelines.dry_run(sinks.Buckets(spark, target, "sha256").read(), F.col("classification") == "malware").first().kept == 2


def cstr(x):
    return x.encode() + b"\0"


def encode(doc):
    body = b""
    for k, v in doc.items():
        if isinstance(v, bool):
            body += b"\x08" + cstr(k) + bytes([v])
        elif isinstance(v, int):
            body += b"\x10" + cstr(k) + struct.pack("<i", v)
        elif isinstance(v, float):
            body += b"\x01" + cstr(k) + struct.pack("<d", v)
        elif isinstance(v, str):
            body += b"\x02" + cstr(k) + struct.pack("<i", len(v.encode()) + 1) + cstr(v)
        elif isinstance(v, bytes):
            body += b"\x05" + cstr(k) + struct.pack("<i", len(v)) + b"\0" + v
        elif isinstance(v, dict):
            body += b"\x03" + cstr(k) + encode(v)
        elif isinstance(v, list):
            body += b"\x04" + cstr(k) + encode({str(i): x for i, x in enumerate(v)})
        else:
            body += b"\x0a" + cstr(k)
    return struct.pack("<i", len(body) + 5) + body + b"\0"


def file_doc(i, cls=None, **value):
    base = {"response_code": 1, "sha256": f"{i:064x}", "sha1": f"{i:040x}", "positives": 2, "total": 60.0, "scan_date": "2020-10-19 19:28:09"}
    out = {"_id": f"{i:040x}", "value": base | value}
    return out | ({"vtClassifierV2Classification": {"classification": cls}} if cls is not None else {})


DOCS = [
    {"_id": "x", "value": None},
    file_doc(1, response_code=0),
    file_doc(2, "Indifferent", positives=50),
    file_doc(3, "unknown"),
    file_doc(4, "Malware", positives=None),
    file_doc(5),
    file_doc(6, positives=0.9),
    file_doc(7, "", positives=1),
    file_doc(8, "whitelist"),
    file_doc(9, "Hacktool", sha1=""),
    {"_id": "d" * 32, "value": {"response_code": 1, "sha256": "e" * 64, "positives": 3}},
    file_doc(11, positives=None),
]


@pytest.mark.parametrize("size", [37, 100, 333, 1 << 20])
def test_bson_is_read_once_whatever_the_split(spark, tmp_path, size):
    raw = b"".join(map(encode, DOCS[:6])) + b"\x07junk\xff\x00" + b"".join(map(encode, DOCS[6:])) + b"\x01\x00\x00"
    (tmp_path / "a.bson").write_bytes(raw)
    spark.dataSource.register(bson.BsonSource)
    rows = spark.read.format("bson_dump").option("splitBytes", size).load(str(tmp_path))
    found = rows.orderBy("offset").collect()
    assert [json.loads(r.doc) for r in found if r.doc] == DOCS
    assert sum(r.corrupt for r in found) == 10
    (counted,) = funnel.dump_counters(rows).collect()
    assert (counted.documents, counted.corrupt_runs, counted.corrupt_bytes) == (len(DOCS), 2, 10)


def test_bson_borders_fall_anywhere(tmp_path):
    """Every width of range gives every document and every bad byte once, wherever borders fall: in documents, in
    embedded ones, in junk, before junk and between."""
    docs = [file_doc(i, inner={"a": {"b": i}}, list=[{"c": 1}, {"d": {}}]) for i in range(9)]
    raw = b"junk" + b"".join(map(encode, docs[:3])) + b"\x09\0\0\0x" + encode(docs[3]) + b"\0" * 7 + b"".join(map(encode, docs[4:])) + b"\x05"
    (tmp_path / "a.bson").write_bytes(raw)
    for most in [*range(20, 700, 13), len(raw)]:
        reader = bson.BsonReader({"path": str(tmp_path / "a.bson"), "splitBytes": str(most)})
        rows = [r for s in reader.partitions() for r in reader.read(s)]
        assert [json.loads(r[2]) for r in sorted(rows, key=lambda r: r[1]) if r[2]] == docs, most
        assert sum(r[3] for r in rows) == 17, most


def test_bson_reads_are_tried_again(tmp_path, monkeypatch):
    (tmp_path / "a.bson").write_bytes(b"".join(map(encode, DOCS)))
    f, calls = bson.Bytes(str(tmp_path / "a.bson"), window=64, pause=0.001), []
    store = f.store

    class Flaky:
        def open_input_file(self, name):
            calls.append(name)
            if len(calls) % 3:
                raise OSError("transient")
            return store.open_input_file(name)

    f.store = Flaky()
    assert f.get(0, 4) == encode(DOCS[0])[:4] and len(calls) == 3
    f.file, f.store = None, type("Gone", (), {"open_input_file": lambda self, name: (_ for _ in ()).throw(OSError("gone"))})()
    with pytest.raises(OSError):
        f.get(300, 80)


def test_file_dump_rules(spark, tmp_path):
    (tmp_path / "a.bson").write_bytes(b"".join(map(encode, DOCS)))
    spark.dataSource.register(bson.BsonSource)
    kept = filters.file_dump(bson.file_docs(spark.read.format("bson_dump").load(str(tmp_path)))).collect()
    assert [(r.sha256[-1], r.own_classification) for r in sorted(kept, key=lambda r: r.sha256)] == [("4", "Malware"), ("5", None), ("7", None), ("8", "whitelist"), ("9", "Hacktool"), ("e", None)]
    by = {r.sha256[-1]: r for r in kept}
    assert by["9"].sha1 == f"{9:040x}" and by["e"].sha1 is None and by["5"].total == 60
    lookup = spark.createDataFrame([(f"{5:040x}", "suspicious"), (f"{7:040x}", "sinkholed"), (f"{8:040x}", "malware")], "sha1 string, classification string")
    out = pipelines.dump_to_curated(spark, str(tmp_path), lookup, 200).collect()
    assert sorted((r.sha256[-1], r.classification, r.origin, r.date) for r in out) == [("4", "malware", "own", "20201019"), ("5", "suspicious", "lookup", "20201019"), ("9", "hacktool", "own", "20201019")]


def test_domain_dump_rules(spark, tmp_path):
    def dom(i, cls, pos=None, value=True):
        doc = {"_id": i, "response": cls}
        return doc | {"value": {"detectedUrls": [{"url": "u", "positives": p} for p in pos or []]} if value else None}

    docs = [
        dom("a.example", "maliciousClassification=unknown"), dom("b.example", "maliciousClassification=indifferent"), dom("c.example", "maliciousClassification=indifferent", [0, {"$numberInt": "2"}]),
        dom("d.example", "maliciousClassification=whitelist"), dom(" EXAMPLE.Com ", "x=1;maliciousClassification= Malware ;y"), dom("f.example", "maliciousClassification=foo", [0]), dom("g.example", ""),
        dom("h" * 254, "maliciousClassification=malware"), dom("", "maliciousClassification=malware"), dom("k.example", "maliciousClassification=malware", value=False),
    ]
    (tmp_path / "r01.bson").write_bytes(b"".join(map(encode, docs)))
    out = pipelines.domains_to_curated(spark, str(tmp_path), 50).collect()
    assert sorted(map(tuple, out)) == [("c.example", "AV_DETECTED", "VIRUS_TOTAL", 2), ("d.example", "WHITELIST", "VIRUS_TOTAL", None), ("example.com", "MALWARE", "VIRUS_TOTAL", None), ("f.example", "MALWARE", "VIRUS_TOTAL", None), ("k.example", "MALWARE", "VIRUS_TOTAL", None)]
    rows = bson.domain_docs(spark.read.format("bson_dump").load(str(tmp_path)))
    assert {r.reason: r.n for r in funnel.by_reason(filters.domain_reasons(rows)).collect()} == {"valid": 5, "unknown": 1, "indifferent": 1, "no_classification": 1, "bad_domain": 2}


def test_verdict_csv_and_ndjson(spark, tmp_path):
    (tmp_path / "v.csv").write_text("sha1,classification\n AB , Malware \nCD,indifferent\nEF,pua\nEF,hacktool\n,malware\nGH,\n")
    assert sorted(map(tuple, verdicts.csv(spark, str(tmp_path / "v.csv")).collect())) == [("ab", "malware"), ("ef", "hacktool")]
    lines = [{"sha256": " " + "A" * 64, "sha1": "ab", "positives": 300, "total": -1, "scan_date": "19/10/2020", "detections": "E:x"}, {"sha256": "b" * 64, "own_classification": "whitelist", "sha1": "ab"}]
    with gzip.open(tmp_path / "x.ndjson.gz", "wt") as f:
        f.write("\n".join([json.dumps(lines[0]), "", "bad", "[1]", json.dumps(lines[1]), json.dumps(lines[0])]))
    rows = ndjson.scan(spark, str(tmp_path))
    assert rows.count() == 6 and rows.where("parsed").count() == 3
    out = pipelines.ndjson_to_curated(spark, str(tmp_path), verdicts.csv(spark, str(tmp_path / "v.csv"))).collect()
    assert [(r.sha256, r.positives, r.total, r.detection_names, r.classification, r.origin, r.date) for r in out] == [("a" * 64, 255, 0, "E:x", "malware", "lookup", None)] * 2
    for name, text in (("ab", '{"classification": "malware"}'), ("cd", "{}"), ("ef", "oops"), ("gh", "[1]")):
        (tmp_path / f"{name}.json").write_text(text)
    asked = spark.createDataFrame([("AB ",), ("ab",), ("cd",), ("ef",), ("gh",), ("zz",), (None,), ("",)], "sha1 string")
    outcome = verdicts.looked_up(asked, str(tmp_path), pause=0.01)
    assert sorted(map(tuple, outcome.collect()), key=str) == [("ab", "malware", "found"), ("cd", None, "missing"), ("ef", None, "failed"), ("gh", None, "failed"), ("zz", None, "missing")]
    assert sorted(r.sha1 for r in verdicts.to_retry(outcome).collect()) == ["ef", "gh"]
    store = spark.createDataFrame([("/s/AB.json", '{"classification": "malware"}'), ("/s/cd", "{}"), ("/s/ef", "oops")], "path string, value string")
    assert sorted(map(tuple, verdicts.store(store).collect()), key=str) == [("ab", "malware", "found"), ("cd", None, "missing"), ("ef", None, "failed")]


def test_archive_lines_come_in_bounded_rows():
    data = "\n".join(f"line {i} é" for i in range(100)).encode()
    for most in (1, 17, 400, 10**6):
        found = list(archive.pieces(data, most))
        assert [x for _, part in found for x in part] == data.decode().split("\n")
        assert [n for n, _ in found] == [sum(len(p) for _, p in found[:i]) for i in range(len(found))]
    assert list(archive.pieces(b"")) == [(0, [""])]


def test_listing_and_unique_merge(spark, tmp_path):
    (tmp_path / "d").mkdir()
    (tmp_path / "d" / "a.bin").write_bytes(b"abc")
    assert [(r.path.rsplit("/", 1)[1], r.length) for r in tables.listing(spark, str(tmp_path), "*.bin").collect()] == [("a.bin", 3)]
    one, two = (spark.createDataFrame([(k,) for k in ks], "sha1 string") for ks in (["c", "a", None, "a"], ["b", "", "c"]))
    assert [r.sha1 for r in tables.merged_unique([one, two], "sha1").collect()] == ["a", "b", "c"]


def test_programs(spark, feed, tmp_path):
    """Each program end to end; a dump is resumed, a dry run writes nothing."""
    out = lambda name: str(tmp_path / "out" / name)
    (funnel_row,) = cli.main(["export", "--input", feed, "--output", out("feed"), "--dry-run"])
    assert funnel_row["rec_new"] >= 2 and not (tmp_path / "out").exists()
    cli.main(["export", "--input", feed, "--output", out("feed")])
    exported = spark.read.parquet(out("feed"))
    assert exported.count() == funnel_row["rec_new"]
    cli.main(["export", "--input", feed, "--output", out("last"), "--max-days", "1"])
    assert {r.day for r in spark.read.parquet(out("last")).select("day").collect()} == {max(r.day for r in exported.select("day").collect())}
    (tmp_path / "v").mkdir()
    for r in exported.collect():
        (tmp_path / "v" / f"{r.sha1}.json").write_text('{"classification": "malware"}')
    assert cli.main(["backfill", "--table", out("feed"), "--verdicts", str(tmp_path / "v"), "--output", out("filled"), "--dry-run"])[0]["percent"] == 100
    cli.main(["backfill", "--table", out("feed"), "--verdicts", str(tmp_path / "v"), "--output", out("filled")])
    cli.main(["filter", "--input", str(next((tmp_path / "out" / "filled").glob("v=*"))), "--output", out("kept")])
    assert spark.read.parquet(out("kept")).count() == exported.count()
    (tmp_path / "bson").mkdir()
    (tmp_path / "bson" / "a.bson").write_bytes(b"".join(map(encode, DOCS)))
    (tmp_path / "v.csv").write_text("sha1,classification\nab,malware\n")
    args = ["dump", "--input", str(tmp_path / "bson"), "--output", out("dump"), "--verdicts", str(tmp_path / "v.csv"), "--resume"]
    assert cli.main([*args, "--dry-run"])[0]["documents"] == len(DOCS)
    cli.main(args)
    n = spark.read.parquet(out("dump")).count()
    (tmp_path / "bson" / "b.bson").write_bytes(b"".join(map(encode, DOCS)))
    cli.main(args)
    assert n and spark.read.parquet(out("dump")).count() == 2 * n
    cli.main(["tsv", "--input", out("dump"), "--output", out("tsv")])
    assert sum(len(p.read_text().splitlines()) for p in (tmp_path / "out" / "tsv").glob("part-*")) == 2 * n
