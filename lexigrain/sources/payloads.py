"""One JSON object per key."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import from_code_point

_NAME = r"([0-9a-f]+(?:_[0-9a-f]+)*)\.json(?:/[^/]*)?$"


def parsed(df: DataFrame, text: str = "json") -> DataFrame:
    """Add ``v``: the text as VARIANT, NULL when it is not strict JSON."""
    return df.withColumn("v", F.try_parse_json(text)).drop(text)


def key_from_name(path) -> F.Column:
    """The key spelled by the hex code points of the name of a file, or of the folder of its parts."""
    points = F.split(F.regexp_extract(path, _NAME, 1), "_")
    return F.array_join(F.transform(points, lambda h: from_code_point(F.conv(h, 16, 10))), "")


def read_files(spark: SparkSession, path: str) -> DataFrame:
    """One file per key, named by its code points."""
    files = spark.read.option("pathGlobFilter", "*.json").text(path, wholetext=True)
    return parsed(files.select(key_from_name(F.col("_metadata.file_path")).alias("key"), F.col("value").alias("json")))


def from_files(files: DataFrame) -> DataFrame:
    """``key, v, path, byte_count, sha256`` of files read whole, such as by ``files.read_listed``; the key is in the name."""
    return parsed(files.select(
        key_from_name("path").alias("key"), F.col("content").cast("string").alias("json"), "path", "byte_count", "sha256",
    )).select("key", "v", "path", "byte_count", "sha256")


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    """One payload per line; the key is the payload's own character."""
    rows = parsed(spark.read.text(path).withColumnRenamed("value", "json"))
    return rows.select(F.try_variant_get("v", "$.character", "string").alias("key"), "v")


def rejected(payloads: DataFrame) -> DataFrame:
    """Keys whose text did not parse."""
    return payloads.where("v is null").select("key")
