"""Strict ``Word,Form,Rank`` lists."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ..operators.ranklist import require_valid, row_reasons

# Fixed value: the only accepted header.
HEADER = ["Word", "Form", "Rank"]

_SCHEMA = "Word string, Form string, Rank string, _bad string"


def scan(spark: SparkSession, path: str, multi_line: bool = True) -> DataFrame:
    """Raw text columns and ``_bad``, which holds rows of the wrong width.

    A file with line breaks inside quotes needs ``multi_line``; without it large
    files split across tasks.
    """
    found = spark.read.option("header", True).csv(path).columns
    if found != HEADER:
        raise ValueError(f"header must be {','.join(HEADER)}, found {','.join(found)}")
    return (
        spark.read.schema(_SCHEMA)
        .option("header", True)
        .option("enforceSchema", False)
        .option("mode", "PERMISSIVE")
        .option("columnNameOfCorruptRecord", "_bad")
        .option("escape", '"')
        .option("multiLine", multi_line)
        .csv(path)
    )


def checked(spark: SparkSession, path: str, multi_line: bool = True) -> DataFrame:
    """Scanned rows with the reason why a row is not acceptable."""
    return row_reasons(scan(spark, path, multi_line), "_bad")


def read(spark: SparkSession, path: str, max_rows: int | None = None, multi_line: bool = True) -> DataFrame:
    """``surface, reading, rank``; any malformed row fails the load."""
    return require_valid(checked(spark, path, multi_line), max_rows)
