"""The ranked word list: scan, validation, duplicates, conflicts."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import ranklist as R
from ..operators.ranking import full_rank
from ..session import work_path
from ..sources import files, ranked_csv
from .base import SQL_RAW, WORD, document_words, query, raw_list, table, word_list


def _valid(spark, sf):
    return R.valid_rows(R.row_reasons(R.collapsed(raw_list(spark, sf))))


@query("src_rank_csv", f"WITH {SQL_RAW} SELECT w AS surface, r AS reading, rank FROM raw")
def rank_csv(spark, sf):
    path = work_path(spark, "ranks")
    raw_list(spark, sf).write.option("header", True).option("escape", '"').csv(path)
    return ranked_csv.read(spark, path, multi_line=False)


@query("rank_dedupe", f"WITH {SQL_RAW} SELECT w AS surface, r AS reading, rank, count(*) AS copies FROM raw GROUP BY ALL")
def rank_dedupe(spark, sf):
    return R.distinct_rows(_valid(spark, sf))


@query("rank_conflict_free", f"WITH {SQL_RAW} SELECT w AS surface, r AS reading, rank FROM free")
def rank_conflict_free(spark, sf):
    return R.conflict_free(_valid(spark, sf))


@query("rank_conflicts", f"""
WITH {SQL_RAW} SELECT w AS surface, r AS reading, count(DISTINCT rank) AS ranks FROM raw
GROUP BY w, r HAVING count(DISTINCT rank) > 1""")
def rank_conflicts(spark, sf):
    return R.conflicting_pairs(_valid(spark, sf))


@query("rank_parse_stats", f"""
WITH {SQL_RAW},
pairs AS (SELECT w, r, count(DISTINCT rank) AS k, count(*) AS c FROM raw GROUP BY w, r)
SELECT CAST(sum(c) AS BIGINT) AS source_rows, CAST(sum(c - k) AS BIGINT) AS exact_duplicate_rows,
       count(*) FILTER (k > 1) AS conflicting_pairs,
       CAST(coalesce(sum(k) FILTER (k > 1), 0) AS BIGINT) AS excluded_conflicting_rows,
       count(*) FILTER (k = 1) AS rows
FROM pairs""")
def rank_parse_stats(spark, sf):
    return R.parse_stats(_valid(spark, sf))


# Events and documents as badly formed rows of a list.
@query("gate_rank_rows", r"""
WITH e AS (SELECT event_type AS w, props AS f,
             CASE event_type WHEN 'click' THEN k WHEN 'error' THEN CAST(value AS VARCHAR) WHEN 'purchase' THEN '0' || k
                  WHEN 'signup' THEN k || '0000000' ELSE NULL END AS r
           FROM (SELECT *, regexp_extract(props, '[0-9]+') AS k FROM events)),
d AS (SELECT text AS w, text AS f, CAST(n_chars AS VARCHAR) AS r FROM documents),
t AS (SELECT trim(w, chr(10) || chr(32) || chr(9)) AS w, trim(f, chr(10) || chr(32) || chr(9)) AS f, r FROM (FROM e UNION ALL FROM d)),
c AS (SELECT CASE WHEN r IS NULL THEN 'malformed row' WHEN w = '' THEN 'empty word' WHEN f = '' THEN 'empty form'
                  WHEN length(w) > 128 THEN 'word too long' WHEN length(f) > 256 THEN 'form too long'
                  WHEN NOT regexp_full_match(r, '[1-9][0-9]*') THEN 'invalid rank'
                  WHEN CAST(r AS BIGINT) > 10000000 THEN 'rank out of range' ELSE 'valid' END AS reason FROM t)
SELECT reason, count(*) AS n FROM c GROUP BY reason""")
def gate_rank_rows(spark, sf):
    k = F.regexp_extract("props", "[0-9]+", 0)
    kind = F.col("event_type")
    rank = (
        F.when(kind == "click", k).when(kind == "error", F.col("value").cast("string"))
        .when(kind == "purchase", F.concat(F.lit("0"), k)).when(kind == "signup", F.concat(k, F.lit("0000000")))
    )
    events = table(spark, sf, "events").select(kind.alias("Word"), F.col("props").alias("Form"), rank.alias("Rank"))
    docs = table(spark, sf, "documents").select(
        F.col("text").alias("Word"), F.col("text").alias("Form"),
        F.col("n_chars").cast("string").alias("Rank"),
    )
    checked = R.row_reasons(events.unionByName(docs), limits=R.STRICT_LIMITS)
    return checked.groupBy(F.coalesce("reason", F.lit("valid")).alias("reason")).agg(F.count("*").alias("n"))


@query("src_key_list", rf"""
SELECT DISTINCT unnest(regexp_extract_all(lower(text), '{WORD}')) AS key FROM documents""")
def key_list(spark, sf):
    path = work_path(spark, "keys")
    lists = table(spark, sf, "documents").select(F.to_json(F.array_distinct(word_list("text"))).alias("value"))
    lists.write.text(path)
    return files.key_list(spark, path, strict=True).select("key").distinct()


@query("limit_keys", "SELECT p_partkey AS pos, p_name AS key FROM part ORDER BY p_partkey LIMIT 100")
def limit_keys(spark, sf):
    keys = table(spark, sf, "part").select(F.col("p_partkey").alias("pos"), F.col("p_name").alias("key"))
    return files.limit_keys(keys, 100)


@query("sort_codepoint", rf"""
WITH w AS (SELECT DISTINCT unnest(regexp_extract_all(lower(text), '{WORD}')) AS key FROM documents)
SELECT key, row_number() OVER (ORDER BY key) AS ord FROM w""")
def sort_codepoint(spark, sf):
    words = document_words(spark, sf).distinct().withColumnRenamed("w", "key")
    return full_rank(words, [], [F.asc("key")])
