"""Reading groups of a key: order, entry counts, classes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import variants as V
from ..functions.text import reading_stem
from .ranking import full_rank, top_n

# Fixed value: readings shown on a card.
MAX_SHOWN = 3


def reading_list(v="v") -> Column:
    """The reading groups of a payload as an array of (stem, total), typed."""
    return F.transform(
        V.elements(v, "$.wordsByReading"),
        lambda g: F.struct(
            reading_stem(V.string_field(g, "$.reading")).alias("stem"), V.int_field(g, "$.totalWords").alias("total")
        ),
    )


def exploded_readings(lists: DataFrame, key: str = "key", readings: str = "readings") -> DataFrame:
    """Rows key, ``pos, stem, total`` of a table with reading lists."""
    return lists.select(key, F.posexplode(readings).alias("pos", "g")).select(key, "pos", "g.*")


def payload_readings(payloads: DataFrame, key: str = "key") -> DataFrame:
    """Reading groups of payload rows: key, ``pos``, ``stem`` and the typed total."""
    return exploded_readings(payloads.select(key, reading_list().alias("readings")), key)


def entry_counts(groups: DataFrame, key: list[str], stem: str = "stem", total: str = "total") -> DataFrame:
    """Sum of the positive totals per stem; blank stems drop out."""
    valid = groups.where((F.col(stem) != "") & (F.col(total) > 0))
    return valid.groupBy(*key, stem).agg(F.sum(total).alias("entries"))


def ordered_counts(counts: DataFrame, key: list[str], stem: str = "stem") -> DataFrame:
    """Number all readings of each key by descending count, then reading."""
    return full_rank(counts, key, [F.desc("entries"), F.asc(stem)])


def top_readings(counts: DataFrame, key: list[str], stem: str = "stem", n: int = MAX_SHOWN) -> DataFrame:
    return top_n(counts, key, [F.desc("entries"), F.asc(stem)], n)


def first_appearance(groups: DataFrame, key: list[str], stem: str = "stem", pos: str = "pos") -> DataFrame:
    """Distinct stems of each key with the position where they first appear."""
    return groups.where(F.col(stem) != "").groupBy(*key, stem).agg(F.min(pos).alias("first_pos"))


def group_order(groups: DataFrame, key: list[str], stem: str = "stem", pos: str = "pos") -> DataFrame:
    """Number the distinct stems of each key by first appearance."""
    return full_rank(first_appearance(groups, key, stem, pos), key, [F.asc("first_pos"), F.asc(stem)])


def payload_group_order(lists: DataFrame, key: str = "key") -> DataFrame:
    """As ``group_order``, for a table with reading lists: a key's groups are one row's worth."""
    first = first_appearance(exploded_readings(lists, key), [key])
    w = Window.partitionBy(key).orderBy("first_pos")
    return first.select(key, "stem", F.row_number().over(w).cast("bigint").alias("ord"))
