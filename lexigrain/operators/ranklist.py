"""The strict ranked word list: validation, duplicates, conflicts, relevance."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import nfkc, nfkc_fold, strip
from ..session import staged
from .skew import salted_join

# The limits of the strict list, on the lengths of a surface and a reading and on the
# rank. A caller that wants them passes them; nothing is limited otherwise.
STRICT_LIMITS = {"surface": 128, "reading": 256, "rank": 10_000_000}

MALFORMED = "malformed row"


def normalized(raw: DataFrame) -> DataFrame:
    """Add ``surface`` and ``reading`` to raw rows ``Word, Form, Rank``."""
    return raw.withColumn("surface", nfkc(strip("Word"))).withColumn("reading", nfkc_fold("Form"))


def _reason(bad: Column, limits: dict[str, int]) -> Column:
    blank_word = F.coalesce(strip("Word"), F.lit("")) == ""
    blank_form = F.coalesce(strip("Form"), F.lit("")) == ""
    number = F.col("Rank").try_cast("bigint")

    def above(value: Column, name: str) -> Column:
        return value > limits[name] if name in limits else F.lit(False)

    return (
        F.when(bad, MALFORMED)
        .when(F.col("Word").isNull() | F.col("Form").isNull() | F.col("Rank").isNull(), MALFORMED)
        .when(blank_word, "empty word")
        .when(blank_form, "empty form")
        .when((F.col("surface") == "") | (F.col("reading") == ""), "empty normalized form")
        .when(above(F.length("surface"), "surface"), "word too long")
        .when(above(F.length("reading"), "reading"), "form too long")
        .when(~F.col("Rank").rlike(r"\A[1-9][0-9]*\z"), "invalid rank")
        .when(number.isNull() | above(number, "rank"), "rank out of range")
    )


def collapsed(raw: DataFrame) -> DataFrame:
    """Distinct raw rows with their number of copies, so that each is folded and checked once."""
    return raw.groupBy("Word", "Form", "Rank").agg(F.count("*").alias("copies"))


def row_reasons(raw: DataFrame, corrupt: str | None = None, limits: dict[str, int] | None = None) -> DataFrame:
    """Raw rows with normalized columns and ``reason``: NULL for a valid row.

    ``limits`` may name largest lengths of ``surface`` and ``reading`` and a largest ``rank``.
    """
    bad = F.col(corrupt).isNotNull() if corrupt else F.lit(False)
    return normalized(raw).withColumn("reason", _reason(bad, limits or {}))


def _copies(rows: DataFrame) -> list[str]:
    return [c for c in rows.columns if c == "copies"]


def valid_rows(checked: DataFrame) -> DataFrame:
    """``surface, reading, rank`` of the rows without a reason, with their ``copies`` if they were collapsed."""
    rank = F.col("Rank").try_cast("bigint").alias("rank")
    return checked.where(F.col("reason").isNull()).select("surface", "reading", rank, *_copies(checked))


def require_valid(checked: DataFrame, max_rows: int | None = None) -> DataFrame:
    """Fail on a malformed row, past the row limit or without an unambiguous row.

    Checked rows are written once; the verdict and the caller read that copy.
    """
    kept = staged(checked.select("Word", "Rank", "surface", "reading", "reason"), "checked")
    found = kept.agg(
        F.count("*").alias("rows"),
        F.min(F.when(F.col("reason").isNotNull(), F.struct("reason", "Word"))).alias("bad"),
    ).first()
    if found["bad"] is not None:
        raise ValueError(f"ranked list rejected: {found['bad']['reason']}: {found['bad']['Word']!r}")
    if max_rows is not None and found["rows"] > max_rows:
        raise ValueError("ranked list exceeds the row limit")
    rows = valid_rows(kept)
    if conflict_free(rows).isEmpty():
        raise ValueError("ranked list has no unambiguous rows")
    return rows


def distinct_rows(rows: DataFrame) -> DataFrame:
    """One row per (surface, reading, rank), with its number of copies."""
    n = F.sum("copies") if _copies(rows) else F.count("*")
    return rows.groupBy("surface", "reading", "rank").agg(n.alias("copies"))


def conflict_free(rows: DataFrame) -> DataFrame:
    """Rows of the (surface, reading) pairs that carry exactly one rank.

    Minimum and maximum decide it, so one partially aggregated shuffle removes
    duplicates and conflicts together.
    """
    return (
        rows.groupBy("surface", "reading")
        .agg(F.min("rank").alias("rank"), F.max("rank").alias("_max"))
        .where(F.col("rank") == F.col("_max"))
        .drop("_max")
    )


def conflicting_pairs(rows: DataFrame) -> DataFrame:
    """Pairs with more than one rank and how many distinct ranks they carry."""
    return (
        distinct_rows(rows)
        .groupBy("surface", "reading")
        .agg(F.count("*").alias("ranks"))
        .where(F.col("ranks") > 1)
    )


def parse_stats(rows: DataFrame) -> DataFrame:
    """Row accounting of the list, in one row."""
    pairs = (
        distinct_rows(rows)
        .groupBy("surface", "reading")
        .agg(F.count("*").alias("ranks"), F.sum("copies").alias("copies"))
    )
    conflict = F.col("ranks") > 1
    zero = F.lit(0).cast("bigint")
    return pairs.agg(
        F.coalesce(F.sum("copies"), zero).alias("source_rows"),
        F.coalesce(F.sum(F.col("copies") - F.col("ranks")), zero).alias("exact_duplicate_rows"),
        F.count_if(conflict).alias("conflicting_pairs"),
        F.coalesce(F.sum(F.when(conflict, F.col("ranks"))), zero).alias("excluded_conflicting_rows"),
        F.count_if(~conflict).alias("rows"),
    )


def relevant(rows: DataFrame, keys: DataFrame, key: str = "key") -> DataFrame:
    """Rows whose surface holds at least one known key.

    The distinct (character, surface) pairs meet the keys in a semi join; the
    planner broadcasts the keys only when their size allows it.
    """
    chars = rows.select("surface", "reading", "rank", F.explode(F.array_distinct(F.split("surface", ""))).alias(key))
    return salted_join(chars, keys.select(key).distinct(), [key], "left_semi").drop(key).distinct()
