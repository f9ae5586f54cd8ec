"""Inventories of sources: digests, locks, verification, work-lists, quarantine."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.variants import elements, int_field, string_field
from .gates import canonical_path


def inventory(df: DataFrame, path: str = "path", content: str = "content") -> DataFrame:
    """``path, byte_count, sha256`` of every row's content."""
    return df.select(
        F.col(path).alias("path"),
        F.octet_length(content).cast("bigint").alias("byte_count"),
        F.sha2(F.col(content).cast("binary"), 256).alias("sha256"),
    )


def checksum_line() -> Column:
    """An inventory row as ``sha256  path``."""
    return F.concat(F.col("sha256"), F.lit("  "), F.col("path"))


def summary(files: DataFrame) -> DataFrame:
    """File count, total and largest size, in one row."""
    return files.agg(
        F.count("*").alias("file_count"),
        F.coalesce(F.sum("byte_count"), F.lit(0)).alias("byte_count"),
        F.coalesce(F.max("byte_count"), F.lit(0)).alias("largest"),
    )


def over_budget(files: DataFrame, max_members: int, max_total: int, max_member: int) -> DataFrame:
    """Budgets the inventory exceeds, as rows ``budget, found, allowed``."""
    s = summary(files)
    budgets = [("members", "file_count", max_members), ("total bytes", "byte_count", max_total),
               ("member bytes", "largest", max_member)]
    rows = F.array(*[
        F.struct(F.lit(n).alias("budget"), F.col(c).alias("found"), F.lit(m).cast("bigint").alias("allowed"))
        for n, c, m in budgets
    ])
    return s.select(F.explode(rows).alias("r")).select("r.*").where("found > allowed")


def lock_table(locks: DataFrame, lock: str = "lock") -> DataFrame:
    """Files declared by lock documents (VARIANT). A document that did not parse has no files."""
    files = locks.select(F.explode(elements(lock, "$.files")).alias("f"))
    return files.select(
        string_field("f", "$.path").alias("path"),
        int_field("f", "$.byteCount").alias("byte_count"),
        string_field("f", "$.sha256").alias("sha256"),
    )


def _per_path(files: DataFrame, prefix: str) -> DataFrame:
    return files.groupBy("path").agg(
        F.count("*").alias(f"{prefix}_n"),
        F.min("byte_count").alias(f"{prefix}_bytes"),
        F.min("sha256").alias(f"{prefix}_sha256"),
    )


def verify(lock: DataFrame, actual: DataFrame) -> DataFrame:
    """Status of every declared or found path.

    Copies of a path are counted before the full outer join, so it meets one row
    per path on each side.
    """
    both = _per_path(lock, "lock").join(_per_path(actual, "file"), "path", "full_outer")
    status = (
        F.when(~canonical_path("path"), "canonical")
        .when((F.col("lock_n") > 1) | (F.col("file_n") > 1), "duplicate")
        .when(F.col("file_n").isNull(), "missing")
        .when(F.col("lock_n").isNull(), "undeclared")
        .when(~F.col("lock_bytes").eqNullSafe(F.col("file_bytes")), "size")
        .when(~F.col("lock_sha256").eqNullSafe(F.col("file_sha256")), "digest")
        .otherwise("ok")
    )
    return both.select("path", status.alias("status"))


def mutated(consumed: DataFrame) -> DataFrame:
    """Paths registered with more than one digest."""
    return (
        consumed.groupBy("path")
        .agg(F.min("sha256").alias("first"), F.max("sha256").alias("last"), F.count("*").alias("registrations"))
        .where(F.col("first") != F.col("last"))
    )


def changed_since(consumed: DataFrame, current: DataFrame) -> DataFrame:
    """Consumed paths whose current content differs or is gone."""
    now = current.select("path", F.col("sha256").alias("current"))
    return consumed.select("path", "sha256").distinct().join(now, "path", "left").where(
        ~F.col("sha256").eqNullSafe(F.col("current"))
    )


def not_quarantined(files: DataFrame, quarantine: DataFrame) -> DataFrame:
    """Files that are not quarantined with the very digest they have now."""
    return files.join(quarantine.select("path", "sha256"), ["path", "sha256"], "left_anti")


def worklist(requested: DataFrame, landed: DataFrame, negative: DataFrame) -> DataFrame:
    """What to do for each requested key: ``use``, ``refetch``, ``skip`` or ``fetch``.

    ``landed`` holds ``key, valid``; ``negative`` the keys marked absent that day.
    ``void_marker`` tells when a marker is overruled by a landed row.
    """
    found = landed.groupBy("key").agg(F.max("valid").alias("valid"))
    marks = negative.select("key").distinct().withColumn("marked", F.lit(True))
    both = requested.join(found, "key", "left").join(marks, "key", "left")
    marked = F.coalesce("marked", F.lit(False))
    action = (
        F.when(F.col("valid"), "use")
        .when(~F.col("valid"), "refetch")
        .when(marked, "skip")
        .otherwise("fetch")
    )
    return both.select("key", action.alias("action"), (marked & F.col("valid").isNotNull()).alias("void_marker"))
