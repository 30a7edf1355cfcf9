"""Documented dimension collections: their schemas, and the flat tables that operators take."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

SCHEMAS = {
    "tokens": "_id string, value struct<maliciousType: string, source: string, link: string, expiration: long, type: string>",
    "domain_dns": "_id string, value struct<isInternalDomain: boolean, resolvedIpAddress: string, resolvedSecondLevelDomain: string, nameServers: array<string>, reversedDomain: string>",
    "sinkholes": "_id struct<identifier: string>, value struct<type: string, entity: string>",
    "file_extensions": "_id struct<extension: string>, value struct<sources: array<string>, description: string, type: string>",
    "engine_weights": "true_positive_type_factors map<string, double>, anti_virus_engine_factors map<string, double>, detection_score_threshold double",
    "decision_priority": "cpType string, maliciousType string, priority int",
    "ttl": "_id string, value long",
}


def read(spark: SparkSession, name: str, path: str) -> DataFrame:
    """A collection exported as NDJSON."""
    return spark.read.schema(SCHEMAS[name]).json(path)


def sinkholes(df: DataFrame) -> DataFrame:
    return df.select(F.col("_id.identifier").alias("identifier"), F.col("value.entity").alias("entity"))


def dns(df: DataFrame) -> DataFrame:
    """domain, ip, sld; internal domains have nothing to resolve and go."""
    rows = df.where(~F.coalesce(F.col("value.isInternalDomain"), F.lit(False)))
    return rows.select(F.col("_id").alias("domain"), F.col("value.resolvedIpAddress").alias("ip"), F.col("value.resolvedSecondLevelDomain").alias("sld"))


def file_extensions(df: DataFrame) -> DataFrame:
    return df.select(F.lower("_id.extension").alias("extension"), F.col("value.type").alias("type"))


def engine_weights(df: DataFrame) -> tuple[DataFrame, DataFrame, float]:
    """Factor by type, quality by engine, and the threshold, of the one weights document."""
    factors = df.select(F.explode("true_positive_type_factors").alias("type", "factor"))
    qualities = df.select(F.explode("anti_virus_engine_factors").alias("engine", "quality"))
    return factors, qualities, df.first()["detection_score_threshold"]


def decision_priority(df: DataFrame) -> DataFrame:
    return df.select(F.col("cpType").alias("source"), F.lower("maliciousType").alias("type"), "priority")


def token_verdicts(df: DataFrame, as_of_ms: int) -> DataFrame:
    """key, type, source of tokens that have not expired."""
    live = df.where(F.coalesce(F.col("value.expiration") >= as_of_ms, F.lit(False)))
    return live.select(F.col("_id").alias("key"), F.lower("value.maliciousType").alias("type"), F.col("value.source").alias("source"))
