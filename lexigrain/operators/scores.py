"""Rank-weighted reading scores and their statistics."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.weights import WEIGHT_TYPE
from .alignment import assignments


def _exact(c):
    return F.sum(F.col(c).cast(WEIGHT_TYPE))


def reading_scores(aligned: DataFrame, groups: DataFrame) -> DataFrame:
    """Score of each (key, reading) that words were attributed to.

    ``groups`` holds ``key, reading, ord, reading_class``: the readings of a key in
    their own order. A word counts once per distinct (key, reading).
    """
    sums = assignments(aligned).groupBy("key", "reading").agg(_exact("weight").alias("_sum"))
    scored = groups.join(sums, ["key", "reading"])
    return scored.select(
        "key", "ord", "reading", "reading_class", F.round(F.col("_sum").cast("double"), 9).alias("score")
    ).where(F.col("score") > 0)


def alignment_stats(aligned: DataFrame, scores: DataFrame) -> DataFrame:
    """Coverage of the alignment, in one row; weightless rows count as relevant only."""
    weighted = F.col("relevant") & (F.col("weight") > 0)
    hit = weighted & F.col("alignment").isNotNull()
    distinct = F.size(F.array_distinct(F.transform("alignment", lambda a: F.struct(a["key"], a["reading"]))))
    zero = F.lit(0)

    def weight(condition):
        return F.coalesce(F.sum(F.when(condition, F.col("weight").cast(WEIGHT_TYPE))).cast("double"), F.lit(0.0))

    rows = aligned.agg(
        F.count("*").alias("rows"),
        F.count_if("relevant").alias("relevant_rows"),
        F.count_if(hit).alias("aligned_rows"),
        F.count_if(weighted & F.col("alignment").isNull()).alias("ambiguous_rows"),
        F.coalesce(F.sum(F.when(hit, distinct).cast("bigint")), zero).alias("reading_assignments"),
        weight(weighted).alias("relevant_weight"),
        weight(hit).alias("aligned_weight"),
    )
    keys = scores.groupBy("key").agg(F.count("*").alias("n")).agg(
        F.struct(F.count("*").alias("keys"), F.coalesce(F.sum("n"), zero).alias("groups"))
    )
    coverage = F.when(F.col("relevant_weight") > 0, F.col("aligned_weight") / F.col("relevant_weight")).otherwise(0.0)
    return (
        rows.withColumn("_k", keys.scalar())
        .withColumn("keys_with_scores", F.col("_k.keys"))
        .withColumn("groups_with_scores", F.col("_k.groups"))
        .withColumn("weight_coverage", coverage)
        .drop("_k")
    )
