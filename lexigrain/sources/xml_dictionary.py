"""The XML dictionary that fills gaps of the primary source."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import strip

# The entry tag and its layout.
ROW_TAG = "character"
SCHEMA = """
    literal string,
    misc struct<grade:string, stroke_count:string, freq:string, jlpt:string>,
    reading_meaning struct<
        rmgroup: array<struct<
            reading: array<struct<_VALUE:string, _r_type:string>>,
            meaning: array<struct<_VALUE:string, _m_lang:string>>>>,
        nanori: array<string>>
"""


def _texts(xs: Column) -> Column:
    """Stripped texts that are not blank."""
    texts = F.transform(F.coalesce(xs, F.expr("cast(array() as array<string>)")), strip)
    return F.filter(texts, lambda t: F.coalesce(t, F.lit("")) != "")


def _of_type(readings: Column, kind: str) -> Column:
    return F.transform(F.filter(readings, lambda r: r["_r_type"] == kind), lambda r: r["_VALUE"])


def _whole(c: str) -> Column:
    return F.col(c).try_cast("bigint")


def fields(rows: DataFrame, *keep: str) -> DataFrame:
    """Typed columns of raw entries: ``key, meanings, on, kun, nanori`` and numbers.

    ``rows`` has the file path and block start of each entry in ``_file`` and ``_block``.
    Keys are unique within the values of the columns to ``keep``.

    Entries need a key of one character and a meaning or a reading. Of equal keys
    the last entry wins, by the path of its file and its place there.
    """
    groups = F.col("reading_meaning.rmgroup")
    readings = F.flatten(F.transform(groups, lambda g: F.coalesce(g["reading"], F.expr("array()"))))
    meanings = F.flatten(F.transform(groups, lambda g: F.coalesce(g["meaning"], F.expr("array()"))))
    english = F.transform(F.filter(meanings, lambda m: m["_m_lang"].isNull()), lambda m: m["_VALUE"])
    typed = rows.select(
        *keep, strip("literal").alias("key"),
        _texts(english).alias("meanings"),
        _texts(_of_type(readings, "ja_on")).alias("on"),
        _texts(_of_type(readings, "ja_kun")).alias("kun"),
        _texts(F.col("reading_meaning.nanori")).alias("nanori"),
        _whole("misc.stroke_count").alias("stroke_count"),
        _whole("misc.grade").alias("grade"),
        _whole("misc.jlpt").alias("jlpt"),
        F.struct("_file", "_block", F.monotonically_increasing_id().alias("_row")).alias("_at"),
    )
    useful = typed.where(
        (F.length("key") == 1) & ((F.size("meanings") > 0) | (F.size("on") > 0) | (F.size("kun") > 0))
    )
    names = [c for c in typed.columns if c not in (*keep, "key", "_at")]
    last = useful.groupBy(*keep, "key").agg(F.max_by(F.struct(*names), "_at").alias("f"))
    return last.select(*keep, "key", "f.*")


def read(spark: SparkSession, path: str, *keep: str) -> DataFrame:
    """The dictionary at ``path``; ``keep`` names partition columns that tell several dictionaries apart."""
    rows = spark.read.format("xml").option("rowTag", ROW_TAG).schema(SCHEMA).load(path)
    source = [F.col("_metadata.file_path").alias("_file"), F.col("_metadata.file_block_start").alias("_block")]
    return fields(rows.select("*", *source), *keep)
