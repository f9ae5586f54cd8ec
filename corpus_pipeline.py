"""From raw documents to packed training sequences, in five stages of the library's operators.

Each stage takes the documents that the one before it kept, as a written table, and returns
documents; the last returns the pieces of the packed sequences. Rows may repeat, any column may
be NULL and further columns pass through all stages but the last; an empty table gives an empty
result.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lexigrain.llm import language, line_dedup, mixing, near_copies, packing
from lexigrain.llm.queries import domains
from lexigrain.operators.ranking import full_rank
from lexigrain.session import staged

#: Posterior of the predicted language from which a document stays.
LEAST_SCORE = 0.5
#: Wanted expected tokens of each labelled domain, as multiples of what the documents hold.
WEIGHTS = {"high": 1.3, "low": 0.5, "toxic": 0.0}


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a language that the labelled ones teach; without any label, those with letters are not told apart and stay."""
    model = language.train(docs, public_tokenizers.path("piece_bpe_32k.model"), gloss="text", language="lang")
    if not model.languages:
        return docs.where(F.col("text").rlike(r"\p{L}"))
    # The text goes along once, beside the rest of its row.
    rest = [c for c in docs.columns if c != "text"]
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in rest]).alias("row"), "text")
    found = language.identify(rows, model, key="row", gloss="text", keep_gloss=True)
    kept = found.where((F.col("language") != language.UNDETERMINED) & (F.col("score") >= LEAST_SCORE))
    return kept.select(*[F.col("gloss").alias(c) if c == "text" else F.col(f"key.`{c}`") for c in docs.columns])


def by_row(docs: DataFrame) -> DataFrame:
    """Documents with ``__row``, a number of every row in the order of ids, those without one last.

    It is the id itself where ids are unique, as they should be; else rows are sorted and numbered, so that
    decisions on one of them meet no other.
    """
    ids = docs.groupBy("doc_id").agg(F.count("*").alias("n"))
    if ids.where("n > 1 OR doc_id IS NULL").isEmpty():
        return docs.withColumn("__row", F.col("doc_id"))
    whole = F.xxhash64(F.to_json(F.struct(*[F.col(f"`{c}`") for c in docs.columns])))
    rows = docs.withColumn("__one", F.lit(0)).withColumn("__hash", whole)
    return full_rank(rows, ["__one"], [F.asc_nulls_last("doc_id"), F.asc("__hash")], "__row").drop("__one", "__hash")


def repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the passages of earlier ones; those that have nothing else go, those without an id are left alone."""
    named = by_row(docs.withColumnRenamed("removed", "__removed")).withColumn("__id", F.expr("IF(doc_id IS NULL, NULL, __row)"))
    shorter = line_dedup.remove_repeated_lines(named, key="__id", gloss="text")
    kept = shorter.where((F.col("removed") == 0) | (F.col("text") != "")).drop("removed").withColumnRenamed("__removed", "removed")
    return kept.withColumn("n_chars", F.char_length("text").cast("bigint")).select(*docs.columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies, that of the smallest id, once; documents without an id stay."""
    rows = by_row(docs.where("doc_id IS NOT NULL"))
    found = near_copies.near_copies(rows, key="__row", gloss="text")
    first = found.where("key = component").select(F.col("key").alias("__row")).distinct()
    return rows.join(first, "__row", "left_semi").select(*docs.columns).unionByName(docs.where("doc_id IS NULL"))


def mixing_weights(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the rates fitted to the target weights say: none, once or more."""
    rows = by_row(docs)
    labels = domains(spark, sf_dir).withColumnRenamed("key", "doc_id")
    labelled = rows.select("doc_id", "__row").join(labels, "doc_id").select(F.col("__row").alias("key"), "domain")
    if labelled.where("domain IS NOT NULL").isEmpty():
        return docs
    mixed = mixing.mix(rows.select(F.col("__row").alias("key"), F.col("text").alias("gloss")), labelled, WEIGHTS, relative=True)
    joined = rows.join(mixed.select(F.col("key").alias("__row"), "copies"), "__row").where("copies > 0")
    repeated = joined.withColumn("__copy", F.explode(F.sequence(F.lit(1), F.col("copies"))))
    return repeated.select(*docs.columns)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of power-of-two length of every document, each a sequence of its own."""
    pieces = packing.pack_glosses(docs, public_tokenizers.path("word_bpe_49k.json"), end_id=2, key="doc_id", gloss="text")
    return pieces.select(
        F.col("key").alias("doc_id"), "start", "length", F.crc32("ids").alias("ids_crc32"), F.col("n_tokens").alias("doc_tokens"),
        F.col("sequence").alias("sequence_id"), "offset", "bucket",
    )


STAGES = [
    ("language_id", language_id), ("line_dedup", repeated_lines), ("near_duplicates", near_duplicates),
    ("mixing_weights", mixing_weights), ("packing", packed),
]
#: Learned and iterative stages have no SQL form; the stages are tested against brute force.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir.rstrip('/')}/documents.parquet")
    for name, stage in STAGES:
        docs = staged(stage(spark, docs, sf_dir), name)
    return docs
