"""Output tables built from records: terms, keys, frequency meta, aliases, cards."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import level_label

# What a card shows at most, and its texts.
SHOWN_READINGS = 3
SENSE_SEPARATOR = "; "


def _or_null(xs: Column) -> Column:
    return F.when(F.size(xs) > 0, xs)


def term_rows(records: DataFrame, glossary: Column) -> DataFrame:
    """Eight term columns; the sequence is the key's code point."""
    blank = F.lit("")
    return records.select(
        F.col("key").alias("expression"), blank.alias("reading"), blank.alias("definition_tags"),
        blank.alias("rules"), F.lit(0).cast("bigint").alias("score"), glossary.alias("glossary"),
        F.ascii("key").cast("bigint").alias("sequence"), blank.alias("term_tags"),
    )


def alias_rows(aliases: DataFrame) -> DataFrame:
    """Term rows that point an alias to its canonical key; nothing but term rows."""
    text = F.concat(F.lit("variant of "), F.col("canonical"))
    return term_rows(aliases.select(F.col("alias").alias("key"), "canonical"), text)


def key_rows(records: DataFrame) -> DataFrame:
    """Six key columns; the statistics map holds only what is known."""
    stats = F.array(
        F.struct(F.lit("Frequency rank").alias("k"), F.col("frequency_rank").cast("string").alias("v")),
        F.struct(F.lit("Grade").alias("k"), F.col("grade").cast("string").alias("v")),
        F.struct(F.lit("JLPT").alias("k"), level_label("jlpt").alias("v")),
        F.struct(F.lit("Strokes").alias("k"), F.col("stroke_count").cast("string").alias("v")),
    )
    return records.select(
        F.col("key").alias("character"), F.array_join("on", " ").alias("on"), F.array_join("kun", " ").alias("kun"),
        F.lit("").alias("tags"), F.col("senses").alias("meanings"),
        F.map_from_entries(F.filter(stats, lambda s: s["v"].isNotNull())).alias("stats"),
    )


def meta_rows(records: DataFrame) -> DataFrame:
    """Frequency rows of the ranked keys."""
    return records.where(F.col("frequency_rank").isNotNull()).select(
        F.col("key").alias("term"), F.lit("freq").alias("type"), F.col("frequency_rank").alias("value")
    )


def badges() -> Column:
    """Known facts of a record as short texts."""
    return F.filter(
        F.array(
            F.concat(F.lit("Rank "), F.col("frequency_rank").cast("string")),
            F.concat(F.lit("Grade "), F.col("grade").cast("string")),
            F.concat(F.lit("JLPT "), level_label("jlpt")),
            F.concat(F.col("stroke_count").cast("string"), F.lit(" strokes")),
        ),
        lambda b: b.isNotNull(),
    )


def _more_words() -> Column:
    """Example words of each group that are not among the best overall."""
    return F.expr("""
        filter(
          transform(examples, g -> named_struct('label', g.label, 'words', filter(g.words, w -> not exists(
            global_words, s -> s.word_id = w.word_id and s.reading_index = w.reading_index)))),
          g -> size(g.words) > 0)
    """)


def cards(
    records: DataFrame,
    distribution: DataFrame | None = None,
    family: DataFrame | None = None,
    strokes: DataFrame | None = None,
) -> DataFrame:
    """One wide row per record; absent sections are NULL.

    ``distribution``: ``key, alt_text, legend``; ``family``: ``key, component, ord,
    size``, the key's place in a family whose members are a bank of their own;
    ``strokes``: ``key, stroke_paths, components, asset``.
    """
    rows = records
    parts = {
        "distribution": (distribution, ("alt_text", "legend")),
        "family": (family, ("component", "ord", "size")),
        "strokes": (strokes, ("stroke_paths", "components", "asset")),
    }
    for name, (side, columns) in parts.items():
        if side is None:
            rows = rows.withColumn(name, F.lit(None).cast("string"))
        else:
            rows = rows.join(side.select("key", F.struct(*columns).alias(name)), "key", "left")
    readings = F.transform(F.slice("reading_entry_counts", 1, SHOWN_READINGS), lambda c: c["reading"])
    full = F.struct(_or_null(F.col("on")).alias("on"), _or_null(F.col("kun")).alias("kun"))
    return rows.select(
        "key",
        F.struct(F.col("key").alias("glyph"), F.coalesce("keyword", "key").alias("keyword")).alias("hero"),
        _or_null(readings).alias("top_readings"),
        F.when(F.size("senses") > 0, F.array_join("senses", SENSE_SEPARATOR)).alias("meaning"),
        "distribution",
        _or_null(F.col("global_words")).alias("words"),
        F.when((F.size("on") > 0) | (F.size("kun") > 0), full).alias("all_readings"),
        _or_null(badges()).alias("details"),
        _or_null(_more_words()).alias("more_words"),
        "family", "strokes",
    )


def manifest(*facts: DataFrame) -> DataFrame:
    """One JSON document from one-row tables of any types, with sorted field names.

    A fact that is a struct is a nested object; a NULL fact is written out.
    """
    row = facts[0].sparkSession.range(1).drop("id")
    for i, f in enumerate(facts):
        row = row.withColumn(f"_{i}", f.select(F.struct(*f.columns)).scalar())
    owners = sorted((c, f"_{i}") for i, f in enumerate(facts) for c in f.columns)
    fields = F.struct(*[F.col(f"{o}.{c}").alias(c) for c, o in owners])
    return row.select(F.to_json(fields, {"ignoreNullFields": "false"}).alias("manifest"))
