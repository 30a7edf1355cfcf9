"""The corpus pipeline: language ID, near-duplicate removal, decontamination, surrogates for personal data, packing.

Each stage takes (spark, docs, sf_dir) and works on all rows its predecessor kept; all but the last return the columns
of documents. Null, empty or letterless texts go in the first stage; of rows that repeat a doc_id and its text, one stays.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.llm import common, decontam, langid, neardup, packing, pii
from quarry.llm.queries import LANGID_ROWS, PII_KEY, table, tokenizer_path

#: A text that no learned language codes in fewer bits a byte is in none of them.
MOST_BITS = 7.0
SHINGLE_WORDS, SIMILAR_PERCENT = 5, 80


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a learned language, lang being the predicted one."""
    model = langid.fit(langid.sample(docs, LANGID_ROWS))
    found = langid.predict(docs, model).where((F.col("lang_pred") != langid.UNDETERMINED) & (F.col("bits_per_byte") <= MOST_BITS))
    return found.withColumn("lang", F.col("lang_pred")).select(*docs.columns)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates: that of the smallest doc_id, and of its texts, if it has several in
    the group, that of the smallest hash. Of rows that repeat both, the smallest by their other columns stays. Rows
    without doc_id stay."""
    found = common.written(neardup.near_duplicates(docs, SHINGLE_WORDS, SIMILAR_PERCENT).where("doc_id IS NOT NULL"), "nd-found")
    gone = found.where("NOT first").select("doc_id", F.col("text_hash").alias("_th")).distinct()
    twice = found.where("first").groupBy("doc_id", F.col("text_hash").alias("_th")).agg(F.count("*").alias("n")).where("n > 1").select("doc_id", "_th")
    placed = docs.withColumn("_th", F.xxhash64(F.coalesce("text", F.lit("")))).withColumn("_key", F.when(F.col("doc_id").isNotNull(), F.xxhash64("doc_id", "_th")))
    told = common.marked(placed, "_key", gone.union(twice).select(F.xxhash64("doc_id", "_th").alias("_key")))
    sure = told.where("NOT _in").select(*docs.columns)
    rest = told.where("_in").join(gone, ["doc_id", "_th"], "left_anti").groupBy("doc_id", "_th").agg(F.min(F.struct(*docs.columns)).alias("row"))
    return sure.unionByName(rest.select("row.*"))


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no more of the benchmark than the contamination rule allows."""
    found = decontam.contaminated(docs, table(spark, sf_dir, "benchmark")).where("contaminated").select(F.col("doc_id").alias("bad")).distinct()
    return docs.join(found, docs["doc_id"].eqNullSafe(F.col("bad")), "left_anti")


def surrogates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with personal data replaced; n_chars follows the text."""
    return pii.pseudonymised(docs, PII_KEY).withColumn("n_chars", F.char_length("text").cast("long")).select(*docs.columns)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of token sequences, in the order of the curve."""
    pieces = packing.pack(docs, tokenizer_path())
    return pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")


STAGES = [("language_id", language_id), ("near_dedup", near_dedup), ("decontamination", decontamination), ("pii", surrogates), ("packing", pack)]

#: No stage but the third can be told in SQL; tests/llm holds them against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of `sf_dir`, each written to the shared folder and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = common.written(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
