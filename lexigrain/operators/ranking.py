"""Ranking that holds when one group has a large share of all rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import staged
from .skew import salted_join


def top_n(df: DataFrame, group: list[str], order: list, n: int, name: str = "ord") -> DataFrame:
    """The first ``n`` rows of each group, numbered from 1 in ``name``.

    Spark keeps ``n`` rows per group in every input partition before the shuffle
    (WindowGroupLimit), so a hot group never lands whole in one task.
    """
    w = Window.partitionBy(*group).orderBy(*order)
    return df.withColumn(name, F.row_number().over(w)).where(F.col(name) <= n)


def competition_rank(df: DataFrame, group: list[str], value: str, name: str = "rank") -> DataFrame:
    """1 + number of rows of the group with a larger ``value``; equal values share a rank.

    Works on a histogram of the values, which partial aggregation builds, and joins
    the ranks back, the commonest value in several parts. For values with few distinct
    levels, such as counts or lengths.
    """
    histogram = df.groupBy(*group, value).agg(F.count("*").alias("_n"))
    above = Window.partitionBy(*group).orderBy(F.desc(value)).rowsBetween(Window.unboundedPreceding, -1)
    ranks = histogram.select(
        *group, value, (F.coalesce(F.sum("_n").over(above), F.lit(0)) + 1).cast("bigint").alias(name)
    )
    return salted_join(df, ranks, [*group, value])


def full_rank(df: DataFrame, group: list[str], order: list[Column], name: str = "ord") -> DataFrame:
    """Row number of every row in its group, for groups of any size.

    Rows are range partitioned by (group, order) and sorted there once, so a hot group
    spreads over many partitions; they are numbered as they are written. A row's place is
    its number less its group's first one in the range, plus the sizes of the ranges
    before: two figures per group and range. ``order`` must be unique within a group.
    """
    sorted_ = df.repartitionByRange(*group, *order).sortWithinPartitions(*group, *order)
    ranged = staged(
        sorted_.withColumn("_range", F.spark_partition_id()).withColumn("_at", F.monotonically_increasing_id()), "ranges"
    )
    before = Window.partitionBy(*group).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    shifts = (
        ranged.groupBy("_range", *group)
        .agg(F.count("*").alias("_n"), F.min("_at").alias("_first"))
        .select("_range", *group, (F.coalesce(F.sum("_n").over(before), F.lit(0)) + 1 - F.col("_first")).alias("_shift"))
    )
    return (
        ranged.join(shifts, ["_range", *group])
        .withColumn(name, (F.col("_at") + F.col("_shift")).cast("bigint"))
        .drop("_range", "_at", "_shift")
    )
