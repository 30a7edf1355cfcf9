"""Line-delimited JSON, gzip or plain."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

FILE_RECORD = (
    "sha256 string, sha1 string, md5 string, positives double, total double, scan_date string, detections string, "
    "scans map<string, struct<detected: string, result: string>>"
)


def scan(spark: SparkSession, path: str, verdict: str = "own_classification", schema: str = FILE_RECORD, pattern: str = "*.ndjson.gz") -> DataFrame:
    """Every line with `parsed` false where it is blank, bad JSON or no object; the fields are then NULL. The field
    `verdict` of a line, its own class if it has one, comes out as own_classification."""
    lines = spark.read.option("pathGlobFilter", pattern).text(path)
    row = F.from_json("value", f"{schema}, `{verdict}` string")
    keys = F.json_object_keys("value")
    return lines.select(keys.isNotNull().alias("parsed"), row.alias("r")).select("parsed", "r.*").withColumnRenamed(verdict, "own_classification")
