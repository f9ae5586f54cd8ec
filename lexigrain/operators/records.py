"""Normalized records: from payloads, from the fallback source, merged."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import variants as V
from ..functions.text import clean_array, reading_class
from ..session import staged
from .examples import examples_in_row, payload_words
from .readings import payload_group_order, reading_list

NUMBERS = ("frequencyRank", "strokeCount", "grade", "jlptLevel")
WORD = (
    "struct<surface:string,gloss:string,rank:bigint,ruby:array<struct<base:string,reading:string>>,"
    "word_id:bigint,reading_index:bigint>"
)
COUNTS = "array<struct<reading:string,count:bigint,reading_class:string>>"
SCORES = "array<struct<reading:string,score:double,reading_class:string>>"
EXAMPLES = f"array<struct<reading:string,reading_class:string,label:string,words:array<{WORD}>>>"


def _empty(kind: str) -> Column:
    return F.expr(f"cast(array() as {kind})")


def admissible(v) -> Column:
    """A payload is usable when it is an object whose character is one code point."""
    return F.coalesce(F.length(V.string_field(v, "$.character")) == 1, F.lit(False))


def plain_fields(payloads: DataFrame) -> DataFrame:
    """Typed fields of admissible payload rows ``(key, v)``; no shuffle.

    The row is built once and generated when its character is usable; a filter on
    ``v`` would be pushed down and parse the payload a second time.
    """
    read = payloads.select("key", "v", V.members("v", *NUMBERS, "character").alias("m"))
    rank = V.only_int("m.frequencyRank")
    typed = F.struct(
        V.only_string("m.character").alias("character"),
        clean_array(V.string_elements("v", "$.meanings")).alias("senses"),
        clean_array(V.string_elements("v", "$.onReadings")).alias("on"),
        clean_array(V.string_elements("v", "$.kunReadings")).alias("kun"),
        F.when(rank > 0, rank).alias("frequency_rank"),
        V.only_int("m.strokeCount").alias("stroke_count"),
        V.only_int("m.grade").alias("grade"),
        V.only_int("m.jlptLevel").alias("jlpt"),
        reading_list().alias("readings"),
    )
    usable = F.filter(F.array(typed), lambda r: F.length(r["character"]) == 1)
    return read.select("key", F.inline(usable)).withColumn("keyword", F.get("senses", 0))


def normalized(payloads: DataFrame, rank_cutoff: int | None = None) -> DataFrame:
    """The full record of every admissible payload. Keys must be unique.

    ``rank_cutoff``  the largest rank an example word may have, if there is one
    """
    # Payload text is parsed for two typed tables, which all branches then read.
    plain = staged(plain_fields(payloads), "fields")
    words = staged(payload_words(payloads, usable=admissible("v"), rank_cutoff=rank_cutoff), "words")
    counts = F.expr("""
        sort_array(transform(
          array_distinct(transform(filter(readings, r -> r.stem <> '' and r.total > 0), r -> r.stem)),
          s -> named_struct('neg', -aggregate(filter(readings, r -> r.stem = s and r.total > 0), 0L, (n, r) -> n + r.total), 'reading', s)))
    """)
    joined = plain.withColumn("counts", counts).join(examples_in_row(words), "key", "left")

    def kind(reading):
        return reading_class(reading, F.col("on"), F.col("kun"))

    def group(g):
        cls = F.when(g["label"] == "", "Other").otherwise(kind(g["label"]))
        return F.struct(
            g["label"].alias("reading"), cls.alias("reading_class"), cls.alias("label"), g["words"].alias("words")
        )

    def count(c):
        return F.struct(
            c["reading"].alias("reading"), (-c["neg"]).alias("count"), kind(c["reading"]).alias("reading_class")
        )

    return joined.select(
        "key", "character", "keyword", "senses", "on", "kun", "frequency_rank", "stroke_count", "grade", "jlpt",
        F.coalesce(F.transform("picked", group), _empty(EXAMPLES)).alias("examples"),
        F.coalesce("global_words", _empty(f"array<{WORD}>")).alias("global_words"),
        F.coalesce(F.transform("counts", count), _empty(COUNTS)).alias("reading_entry_counts"),
        _empty(SCORES).alias("reading_frequency_scores"),
    )


def reading_inventory(payloads: DataFrame) -> DataFrame:
    """Reading groups per key in their own order, with class: input of the scores."""
    plain = staged(plain_fields(payloads).select("key", "on", "kun", "readings"), "fields")
    order = payload_group_order(plain)
    return order.join(plain, "key").select(
        "key", F.col("stem").alias("reading"), "ord", reading_class("stem", "on", "kun").alias("reading_class")
    )


def with_scores(records: DataFrame, scores: DataFrame) -> DataFrame:
    """Attach each key's scores in group order."""
    arrays = (
        scores.groupBy("key")
        .agg(F.sort_array(F.collect_list(F.struct("ord", "reading", "score", "reading_class"))).alias("s"))
        .select("key", F.expr("transform(s, x -> named_struct('reading', x.reading, 'score', x.score, 'reading_class', x.reading_class))").alias("s"))
    )
    joined = records.drop("reading_frequency_scores").join(arrays, "key", "left")
    return joined.withColumn("reading_frequency_scores", F.coalesce("s", _empty(SCORES))).drop("s")


def fallback_records(index: DataFrame, *keep: str) -> DataFrame:
    """Fallback rows in the record shape, next to the columns to keep; what that source lacks stays empty."""
    senses = clean_array("meanings")
    return index.select(
        "key", F.col("key").alias("character"), F.get(senses, 0).alias("keyword"), senses.alias("senses"),
        clean_array("on").alias("on"), clean_array("kun").alias("kun"),
        F.lit(None).cast("bigint").alias("frequency_rank"), "stroke_count", "grade", "jlpt",
        _empty(EXAMPLES).alias("examples"), _empty(f"array<{WORD}>").alias("global_words"),
        _empty(COUNTS).alias("reading_entry_counts"), _empty(SCORES).alias("reading_frequency_scores"), *keep,
    )


def merge_priority(primary: DataFrame, fallback: DataFrame, key: str = "key") -> DataFrame:
    """All primary rows, and the fallback rows whose key is absent; ``origin`` says which.

    Whole rows win, not single fields.
    """
    gaps = fallback.join(primary.select(key), key, "left_anti").withColumn("origin", F.lit("fallback"))
    return primary.withColumn("origin", F.lit("primary")).unionByName(gaps, allowMissingColumns=True)


def source_counts(merged: DataFrame) -> DataFrame:
    """Records in total and by origin, in one row."""
    return merged.agg(
        F.count("*").alias("total"),
        F.count_if(F.col("origin") == "primary").alias("primary"),
        F.count_if(F.col("origin") == "fallback").alias("fallback"),
    )
