"""Registry, table access and derived tables shared by the named queries."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.ranking import competition_rank
from ..session import spread, staged

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}

LETTERS = "abcdefghijklmnopqrstuvwxyz"
KATA = "アイウエオカキクケコサシスセソタチツテトナニヌネノハ"
HIRA = "あいうえおかきくけこさしすせそたちつてとなにぬねのは"
CONSONANTS = "bcdfghjklmnpqrstvwxyz"
HAN = "火水木金土日月年山川田人口車門雨花草虫貝犬"
WORD = r"\p{L}+"


def query(name: str, sql: str | None = None):
    """Register a query under ``name``, with its SQL counterpart if it has one."""

    def register(f):
        QUERIES[name] = f
        if sql is not None:
            ORACLES[name] = sql
        return f

    return register


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf.rstrip('/')}/{name}.parquet")


def kata(c) -> Column:
    """Latin letters as katakana: Japanese-like text of the tables' own words."""
    return F.translate(c, LETTERS, KATA)


def hira(c) -> Column:
    return F.translate(c, LETTERS, HIRA)


def word_list(c) -> Column:
    return F.regexp_extract_all(F.lower(c), F.lit(WORD), F.lit(0))


def document_words(spark: SparkSession, sf: str, *columns: str) -> DataFrame:
    """Every word of every document, with the wanted document columns."""
    docs = spread(table(spark, sf, "documents").select(*columns, "text"))
    return docs.select(*columns, F.explode(word_list("text")).alias("w"))


def word_ranks(spark: SparkSession, sf: str) -> DataFrame:
    """``lang, w, n, rank``: words of each language ranked by how often they occur."""
    counts = document_words(spark, sf, "lang").groupBy("lang", "w").agg(F.count("*").alias("n"))
    return competition_rank(counts, ["lang"], "n")


def source_words(spark: SparkSession, sf: str) -> DataFrame:
    """Distinct words of each (source, language) with their rank in the language.

    The text is cut into words once; the counts per language add up those per source.
    """
    used = document_words(spark, sf, "source", "lang").groupBy("source", "lang", "w").agg(F.count("*").alias("c"))
    used = staged(used, "counts")
    counts = used.groupBy("lang", "w").agg(F.sum("c").alias("n"))
    ranks = competition_rank(counts, ["lang"], "n").drop("n")
    return used.drop("c").join(ranks, ["lang", "w"])


def raw_list(spark: SparkSession, sf: str) -> DataFrame:
    """A raw ranked list: a row per source a word occurs in.

    The same word in two sources repeats its row; in two languages it mostly
    carries two ranks.
    """
    rows = source_words(spark, sf)
    return rows.select(F.col("w").alias("Word"), kata("w").alias("Form"), F.col("rank").cast("string").alias("Rank"))


# SQL of the derived tables, as common table expressions.
SQL_WORDS = rf"""
words AS (SELECT doc_id, source, lang, unnest(regexp_extract_all(lower(text), '{WORD}')) AS w FROM documents),
ranks AS (SELECT lang, w, count(*) AS n, rank() OVER (PARTITION BY lang ORDER BY count(*) DESC) AS rank
          FROM words GROUP BY lang, w)"""

SQL_RAW = f"""{SQL_WORDS},
raw AS (SELECT w, translate(w, '{LETTERS}', '{HIRA}') AS r, rank
        FROM (SELECT DISTINCT source, lang, w FROM words) JOIN ranks USING (lang, w)),
free AS (SELECT w, r, min(rank) AS rank FROM raw GROUP BY w, r HAVING min(rank) = max(rank))"""
