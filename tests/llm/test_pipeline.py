"""The pipeline, stage by stage against brute force, and as a whole."""

import re

import brute
import corpus_pipeline
from pyspark.sql import functions as F

from quarry.llm import common

SF = "/root/testdata/sf0.001"
PRIVATE = re.compile(r"\S+@\S+\.\w+|\b\d{1,3}(?:\.\d{1,3}){3}\b|\+1 \(\d+\) \d+-\d+|\b[0-9a-fA-F]{40}\b|\b\d{16}\b")


def test_stages_one_by_one(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    odd = spark.createDataFrame([(10_001, None, "en", None, 0), (10_002, "", None, "s", 0), (10_003, "12 34 !", "en", "s", 7), (None, "The whole of it is here and there.", "en", "s", 34)], docs.schema)
    now = docs.unionByName(odd)
    names = [n for n, _ in corpus_pipeline.STAGES]
    assert names == ["language_id", "near_dedup", "decontamination", "pii", "packing"]
    for name, stage in corpus_pipeline.STAGES:
        before = {r.doc_id: r.text for r in now.select("doc_id", "text").collect()}
        now = common.written(stage(spark, now, SF), name)
        if name == "packing":
            break
        assert now.columns == docs.columns
        after = {r.doc_id: r.text for r in now.select("doc_id", "text").collect()}
        if name == "language_id":
            assert set(before) - set(after) == {10_001, 10_002, 10_003}
        elif name == "near_dedup":
            known = [(d, t) for d, t in before.items() if d is not None]
            assert set(after) == {d for d, (_, c) in brute.near_duplicates(known, 5).items() if d == c} | {None}
        elif name == "decontamination":
            items = [(r.item_id, r.text) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
            found = {d: brute.hits(t, items) for d, t in before.items()}
            assert set(after) == {d for d, (n, hit, _) in found.items() if not (hit and 20 * hit >= n)}
        else:
            assert set(after) == set(before)
            for d, t in after.items():
                private = set(PRIVATE.findall(before[d]))
                assert not any(p in t for p in private) and (private or t == before[d] or len(t) == len(before[d]))
            assert now.where(F.col("n_chars") != F.char_length("text")).count() == 0
    pieces = now.collect()
    assert {p.doc_id for p in pieces} == set(before)
    total = sum(p.length for p in pieces)
    assert sum(2048 for s in {p.sequence_id for p in pieces}) - total < 2048
    assert sorted(p.sequence_id * 2048 + p.offset for p in pieces)[0] == 0


def test_run_is_repeatable(spark):
    a, b = (sorted(map(tuple, corpus_pipeline.run(spark, SF).collect())) for _ in range(2))
    assert a == b and len(a) > 0


def test_empty_documents(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        docs = common.written(stage(spark, docs, SF), "empty")
        assert docs.count() == 0
