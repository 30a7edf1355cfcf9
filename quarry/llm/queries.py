"""The contract queries of the training-data operators."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.llm import chat, decontam, html, langid, neardup, oracles, packing, pii, quality, sharding, substring

#: Labelled rows that the language model is fitted on, at most, for each language.
LANGID_ROWS = 400
#: Key of the surrogates; a deployment passes its own secret to the operator.
PII_KEY = "surrogates"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    held_out = F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4 == 2, F.lit(False))
    model = langid.fit(langid.sample(docs.where(~held_out), LANGID_ROWS))
    return langid.predict(docs.select("doc_id", "text"), model).select("doc_id", held_out.alias("held_out"), "lang_pred", "score")


def tokenizer_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def op2_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    extra = spark.createDataFrame(chat.injected(), rows.schema)
    return chat.digests(chat.format_conversations(rows.unionByName(extra), tokenizer_path()))


def op3_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = substring.remove_repeats(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return kept.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


def op4_pii_surrogates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.pseudonymised(table(spark, sf_dir, "documents").select("doc_id", "text"), PII_KEY)


def op5_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    pieces = packing.pack(table(spark, sf_dir, "documents").select("doc_id", "text"), tokenizer_path())
    return pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")


def op6_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.propagate(table(spark, sf_dir, "documents").select("doc_id", "text"))


def op7_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neardup.near_duplicates(table(spark, sf_dir, "documents").select("doc_id", "text"), k=4).select("doc_id", "n_shingles", "component_id", "kept")


def op8_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontam.contaminated(table(spark, sf_dir, "documents").select("doc_id", "text"), table(spark, sf_dir, "benchmark").select("item_id", "text"))
    ids = F.sha2(F.array_join("item_ids", ",").cast("binary"), 256)
    return found.select("doc_id", "n_words", "n_hit", F.size("item_ids").cast("long").alias("n_items"), ids.alias("items_sha256"), "contaminated")


def op9_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = quality.judged(table(spark, sf_dir, "documents").select("doc_id", "text", "lang"))
    return judged.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "perplexity", "base_failed", "kept")


def op10_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html.extract(table(spark, sf_dir, "pages"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    found = [op1_language_id, op2_chat_format, op3_substring_dedup, op4_pii_surrogates, op5_packing, op6_sharding, op7_near_dedup, op8_decontamination, op9_quality, op10_html_text]
    return {f.__name__: f for f in found}


def oracle_sql() -> dict[str, str]:
    """The others are no SQL: tests/llm holds them against brute force, round trips or held-out accuracy."""
    return dict(oracles.SQL)
