"""Top-k plus "Other" with whole percentages that add up to 100."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import staged
from .ranking import top_n

# Most segments of a distribution, and their colours in order.
MAX_SEGMENTS = 5
PALETTE = ("#0072b2", "#d55e00", "#009e73", "#cc79a7", "#e69f00", "#767676")
OTHER_COLOR = "#767676"

SUM_TYPE = "decimal(38,12)"


def _share(value: Column, total: Column) -> Column:
    return value.cast("double") * 100.0 / total.cast("double")


def largest_remainder(df: DataFrame, key: list[str], idx: str, value: str, name: str = "percent") -> DataFrame:
    """Whole percentages of ``value`` within ``key`` that add up to 100.

    Shares are floored; what is missing goes to the largest remainders, ties to the
    lower ``idx``. At most 100 rows of a key can gain, so only the best 100 per key
    are ranked and groups may be of any size. Keys without a positive total vanish.
    """
    totals = df.groupBy(*key).agg(F.sum(value).alias("_total")).where(F.col("_total") > 0)
    exact = df.join(totals, key).withColumn("_exact", _share(F.col(value), F.col("_total")))
    floored = (
        exact.withColumn("_floor", F.floor("_exact").cast("bigint"))
        .withColumn("_rest", F.col("_exact") - F.col("_floor"))
        .drop("_exact", "_total")
    )
    missing = floored.groupBy(*key).agg((F.lit(100) - F.sum("_floor")).alias("_missing"))
    best = top_n(floored.select(*key, idx, "_rest"), key, [F.desc("_rest"), F.asc(idx)], 100, "_place")
    gains = best.join(missing, key).where(F.col("_place") <= F.col("_missing")).select(*key, idx, F.lit(1).alias("_gain"))
    return (
        floored.join(gains, [*key, idx], "left")
        .withColumn(name, F.col("_floor") + F.coalesce("_gain", F.lit(0)))
        .drop("_floor", "_rest", "_gain")
    )


def distribution(scores: DataFrame, key: list[str], max_segments: int = MAX_SEGMENTS) -> DataFrame:
    """Segments of each key: ``ord, reading, reading_class, percent, color, collapsed, total``.

    ``scores`` holds the key, ``pos``, ``reading``, ``reading_class`` and ``score``.
    Scores that are not finite and positive are ignored; equal readings add up and
    keep the class seen first. From ``max_segments`` readings on, the tail becomes
    one segment with an empty reading.
    """
    score = F.col("score")
    usable = scores.where(
        (F.coalesce("reading", F.lit("")) != "") & ~F.isnan(score) & (score > 0) & (score < float("inf"))
    )
    summed = usable.groupBy(*key, "reading").agg(
        F.sum(score.cast(SUM_TYPE)).alias("value"),
        F.min_by(F.coalesce("reading_class", F.lit("Other")), "pos").alias("reading_class"),
    )
    # One row per key and reading, read by three branches; what it took to get there runs once.
    summed = staged(summed, "summed")
    totals = summed.groupBy(*key).agg(F.sum("value").alias("total"), F.count("*").alias("n"))
    named = top_n(summed, key, [F.desc("value"), F.asc("reading")], max_segments - 1)
    segments = named.join(totals, key)

    # The tail is what the named segments leave of the total.
    tail = (
        segments.where(F.col("n") >= max_segments)
        .groupBy(*key, "total", "n")
        .agg(F.sum("value").alias("_named"))
        .select(
            *key, "total", "n",
            (F.col("total") - F.col("_named")).alias("value"),
            F.lit("").alias("reading"), F.lit("Other").alias("reading_class"),
            F.lit(max_segments).alias("ord"),
        )
    )
    # At most max_segments rows per key from here on.
    rows = segments.unionByName(tail)
    per_key = Window.partitionBy(*key)
    shares = rows.withColumn("_exact", _share(F.col("value"), F.col("total"))).withColumn("_floor", F.floor("_exact"))
    by_rest = per_key.orderBy(F.desc(F.col("_exact") - F.col("_floor")), F.asc("ord"))
    shares = shares.withColumn("_missing", 100 - F.sum("_floor").over(per_key)).withColumn(
        "_place", F.row_number().over(by_rest)
    )
    percent = F.col("_floor") + F.when(F.col("_place") <= F.col("_missing"), 1).otherwise(0)
    color = F.get(F.array(*map(F.lit, PALETTE)), F.col("ord") - 1)
    return shares.select(
        *key,
        F.col("ord").cast("bigint").alias("ord"), "reading", "reading_class",
        percent.cast("bigint").alias("percent"),
        F.when(F.col("reading") == "", OTHER_COLOR).otherwise(color).alias("color"),
        (F.col("n") >= max_segments).alias("collapsed"),
        F.col("total").cast("double").alias("total"),
    )


def labels(segments: DataFrame, key: list[str]) -> DataFrame:
    """Alternative text and legend of each key's distribution."""
    name = F.when(F.col("reading") == "", "Other").otherwise(F.col("reading"))
    percent = F.col("percent").cast("string")
    lines = segments.withColumn("_alt", F.concat(name, F.lit(" "), percent, F.lit(" percent"))).withColumn(
        "_line", F.concat(name, F.lit(": "), percent, F.lit("%"))
    )
    ordered = lines.groupBy(*key).agg(F.sort_array(F.collect_list(F.struct("ord", "_alt", "_line"))).alias("s"))
    return ordered.select(
        *key,
        F.array_join(F.transform("s", lambda x: x["_alt"]), ", ").alias("alt_text"),
        F.array_join(F.transform("s", lambda x: x["_line"]), "\n").alias("legend"),
    )
