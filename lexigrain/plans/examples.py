"""Example words: greedy choice, fallback, best overall."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators import examples as E
from ..session import staged
from .base import SQL_WORDS, query, source_words, table
from .turns import SQL_PAYLOAD_WORDS, turn_payloads

# Largest rank of an example word, here as in the payloads' own catalogue.
RANK_CUTOFF = 25_000

# Generic greedy choice over a table g(key, i, label, items): groups in order, items
# in order; at most 3 groups take 2 unseen items each.
SQL_GREEDY = """
st AS (SELECT key, CAST(0 AS BIGINT) AS i, CAST([] AS VARCHAR[]) AS seen, CAST([] AS VARCHAR[]) AS out, 0 AS taken FROM (SELECT DISTINCT key FROM g)
       UNION ALL
       SELECT s.key, s.i + 1, list_concat(s.seen, n.fresh),
              list_concat(s.out, list_transform(n.fresh, lambda x, j: (s.taken + 1) || '|' || n.label || '|' || j || '|' || x)),
              s.taken + CASE WHEN len(n.fresh) > 0 THEN 1 ELSE 0 END
       FROM st s JOIN (SELECT s2.key, s2.i, g.label, list_filter(g.items, lambda x: NOT list_contains(s2.seen, x))[1:2] AS fresh
                       FROM st s2 JOIN g ON g.key = s2.key AND g.i = s2.i + 1) n ON n.key = s.key AND n.i = s.i
       WHERE s.taken < 3),
picked AS (SELECT key, unnest(arg_max(out, i)) AS pick FROM st GROUP BY key)"""


@query("topn_greedy", f"""
WITH RECURSIVE {SQL_WORDS},
c AS (SELECT u.source AS key, u.lang AS label, u.w, r.rank FROM (SELECT DISTINCT source, lang, w FROM words) u JOIN ranks r USING (lang, w)),
top AS (SELECT *, row_number() OVER (PARTITION BY key, label ORDER BY rank, w) AS p FROM c QUALIFY p <= 6),
g AS (SELECT key, label, list(w ORDER BY rank, w) AS items, row_number() OVER (PARTITION BY key ORDER BY min(rank), label) AS i
      FROM top GROUP BY key, label),
{SQL_GREEDY}
SELECT key, pick FROM picked""")
def topn_greedy(spark, sf):
    """Common words of each source, by language; a word shared by languages shows once."""
    words = source_words(spark, sf).withColumn("pos", F.col("w"))
    chosen = E.greedy_groups(words, ["source"], ["lang"], ["w"])
    return _picks(chosen, "source", "lang", F.col("w"))


def _picks(chosen: DataFrame, key: str, label: str, item) -> DataFrame:
    pick = F.concat_ws("|", F.col("ord").cast("string"), F.col(label), F.col("place").cast("string"), item)
    return chosen.select(F.col(key).alias("key"), pick.alias("pick"))


@query("fn_clean_example", f"""
WITH {SQL_PAYLOAD_WORDS}
SELECT key, grp, pos, surface, gloss, rank, word_id, reading_index, surface || '=' || reading AS ruby FROM clean""")
def fn_clean_example(spark, sf):
    words = E.payload_words(turn_payloads(spark, sf), rank_cutoff=RANK_CUTOFF)
    ruby = F.concat_ws(",", F.transform("ruby", lambda s: F.concat_ws("=", s["base"], s["reading"])))
    return words.select(
        "key", F.col("grp").cast("bigint").alias("grp"), F.col("pos").cast("bigint").alias("pos"),
        "surface", "gloss", "rank", "word_id", "reading_index", ruby.alias("ruby"),
    )


SQL_EXAMPLES = f"""{SQL_PAYLOAD_WORDS},
item AS (SELECT key, grp, any_value(label) AS label, word_id || '/' || reading_index AS item, min({{'rank': rank, 'pos': pos, 'surface': surface}}) AS m
         FROM clean WHERE grp >= 0 AND label IS NOT NULL GROUP BY key, grp, word_id, reading_index),
g AS (SELECT key, any_value(label) AS label, list(item ORDER BY m) AS items,
        row_number() OVER (PARTITION BY key ORDER BY min(m.rank), grp) AS i FROM item GROUP BY key, grp),
{SQL_GREEDY}"""


@query("examples_selected", f"""
WITH RECURSIVE {SQL_EXAMPLES},
spare AS (SELECT key, word_id, reading_index, min({{'rank': rank, 'pos': pos, 'surface': surface}}) AS m FROM clean
          WHERE grp = -1 AND key NOT IN (SELECT key FROM picked) GROUP BY key, word_id, reading_index)
SELECT key, pick FROM picked
UNION ALL
SELECT key, '1||' || row_number() OVER (PARTITION BY key ORDER BY m) || '|' || word_id || '/' || reading_index FROM spare
QUALIFY row_number() OVER (PARTITION BY key ORDER BY m) <= 3""")
def examples_selected(spark, sf):
    """Greedy choice of each turn, or its top words where no group has a usable word."""
    chosen = E.select_examples(staged(E.payload_words(turn_payloads(spark, sf), rank_cutoff=RANK_CUTOFF), "words"))
    item = F.concat_ws("/", F.col("word_id").cast("string"), F.col("reading_index").cast("string"))
    return _picks(chosen, "key", "label", item)


@query("topn_fallback", """
WITH best AS (SELECT p_brand, p_name, min(p_retailprice) AS price FROM part GROUP BY ALL),
chosen AS (SELECT DISTINCT p_brand FROM part WHERE p_type = 'PROMO' AND p_size > 49)
SELECT p_brand, p_name, row_number() OVER (PARTITION BY p_brand ORDER BY price, p_name) AS place
FROM best WHERE p_brand NOT IN (FROM chosen) QUALIFY place <= 3""")
def topn_fallback(spark, sf):
    """Cheapest names of the brands without a large promotion part."""
    parts = table(spark, sf, "part")
    chosen = parts.where("p_type = 'PROMO' and p_size > 49")
    named = parts.withColumn("name", F.col("p_name"))
    found = E.fallback_items(named, chosen, ["p_brand"], ["p_name"], "p_retailprice", "name")
    return found.select("p_brand", "p_name", "place")


SQL_BEST = """
b AS (SELECT p_brand, p_name, min({'price': p_retailprice, 'kind': p_type, 'part': p_partkey}) AS m FROM part GROUP BY ALL)"""


def _best(spark, sf) -> DataFrame:
    return E.best_per_item(
        table(spark, sf, "part"), ["p_brand"], ["p_name"], ("p_retailprice", "p_type", "p_partkey")
    )


@query("best_per_key", f"WITH {SQL_BEST} SELECT p_brand, p_name, m.price AS p_retailprice, m.kind AS p_type, m.part AS p_partkey FROM b")
def best_per_key(spark, sf):
    return _best(spark, sf)


SQL_TOP = f"{SQL_BEST}, top AS (SELECT p_brand, p_name, m.part AS p_partkey, row_number() OVER (PARTITION BY p_brand ORDER BY m.price, p_name) AS ord FROM b QUALIFY ord <= 6)"


def _top(spark, sf) -> DataFrame:
    return E.top_n(_best(spark, sf), ["p_brand"], [F.asc("p_retailprice"), F.asc("p_name")], E.MAX_GLOBAL)


@query("topk_global", f"WITH {SQL_TOP} SELECT p_brand, p_name, p_partkey, ord FROM top")
def topk_global(spark, sf):
    return _top(spark, sf).select("p_brand", "p_name", "p_partkey", F.col("ord").cast("bigint").alias("ord"))


@query("examples_minus_global", f"""
WITH {SQL_TOP} SELECT p_partkey, p_brand, p_name FROM part p
WHERE NOT EXISTS (SELECT 1 FROM top t WHERE t.p_brand = p.p_brand AND t.p_name = p.p_name)""")
def examples_minus_global(spark, sf):
    parts = table(spark, sf, "part").select("p_partkey", "p_brand", "p_name")
    return E.minus_shown(parts, _top(spark, sf), ["p_brand"], ["p_name"])


@query("words_best_overall", f"""
WITH {SQL_PAYLOAD_WORDS},
b AS (SELECT key, word_id, reading_index, min({{'rank': rank, 'surface': surface}}) AS m FROM clean GROUP BY ALL)
SELECT key, word_id, reading_index, m.rank AS rank, m.surface AS surface,
       row_number() OVER (PARTITION BY key ORDER BY m.rank, word_id, reading_index) AS ord FROM b QUALIFY ord <= 6""")
def words_best_overall(spark, sf):
    top = E.global_top(E.payload_words(turn_payloads(spark, sf), rank_cutoff=RANK_CUTOFF))
    return top.select("key", "word_id", "reading_index", "rank", "surface", F.col("ord").cast("bigint").alias("ord"))
