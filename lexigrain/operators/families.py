"""Families of keys that share a component, and enrichment of records."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .ranking import full_rank


def family_members(pairs: DataFrame, ranks: DataFrame | None = None) -> DataFrame:
    """Members of each family of two or more: ``component, ord, member, rank, size``.

    ``pairs`` holds ``key, component``; a key is never its own component. Ranked
    members come first by rank, the others by code point. One row per member, so a
    component shared by very many keys stays spread over the cluster.
    """
    distinct = pairs.where(
        (F.coalesce("component", F.lit("")) != "") & (F.col("component") != F.col("key"))
    ).select("component", "key").distinct()
    sizes = distinct.groupBy("component").agg(F.count("*").alias("size")).where("size >= 2")
    members = distinct.join(sizes, "component")
    if ranks is not None:
        members = members.join(ranks.select("key", "rank"), "key", "left")
    else:
        members = members.withColumn("rank", F.lit(None).cast("bigint"))
    ranked = full_rank(members, ["component"], [F.asc_nulls_last("rank"), F.asc("key")])
    return ranked.select("component", "ord", F.col("key").alias("member"), "rank", "size")


def siblings(members: DataFrame) -> DataFrame:
    """For every member its family, place, number of siblings and the members before and after it.

    One form for every size: the places are shifted and met by equality, so the result
    is as long as the member table. ``siblings_of`` names all siblings of some members.
    """
    near = members.select("component", "ord", "member")
    before = near.select("component", (F.col("ord") + 1).alias("ord"), F.col("member").alias("previous"))
    after = near.select("component", (F.col("ord") - 1).alias("ord"), F.col("member").alias("next"))
    joined = members.join(before, ["component", "ord"], "left").join(after, ["component", "ord"], "left")
    return joined.select("member", "component", "ord", "size", (F.col("size") - 1).alias("siblings"), "previous", "next")


def siblings_of(members: DataFrame, keys: DataFrame) -> DataFrame:
    """``key, component, ord, sibling`` for the requested keys, a row for each sibling."""
    asked = members.join(keys.select(F.col("key").alias("member")).distinct(), "member", "left_semi")
    asked = asked.select("component", F.col("member").alias("key"))
    return members.select("component", "ord", F.col("member").alias("sibling")).join(asked, "component").where(
        "sibling <> key"
    ).select("key", "component", "ord", "sibling")


def enrich(records: DataFrame, strokes: DataFrame, members: DataFrame) -> DataFrame:
    """Records with stroke facts and family of their key, where there are any."""
    family = members.select(
        F.col("member").alias("key"), "component", F.col("size").alias("family_size"), F.col("ord").alias("family_ord")
    )
    return records.join(strokes, "key", "left").join(family, "key", "left")
