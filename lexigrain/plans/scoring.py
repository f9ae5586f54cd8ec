"""From ranked words to reading distributions.

Words become Japanese-like surfaces: cut into chunks of three letters, a chunk with
a consonant first is spelled by one character per consonant (the repeat mark after
itself), any other chunk is spelled out in kana. Readings a character may take are
the chunks often seen for it.
"""

from __future__ import annotations

import re
from decimal import Decimal

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.text import REPEAT_MARK
from ..functions.weights import exact_weight
from ..operators import alignment as A
from ..operators import distribution as D
from ..operators import gates as G
from ..operators import ranklist as R
from ..operators import readings as RD
from ..operators import scores as S
from ..session import spread, staged
from .base import (
    CONSONANTS, HAN, HIRA, KATA, LETTERS, SQL_RAW, SQL_WORDS, WORD, document_words, hira, kata, query, raw_list,
    source_words, table,
)

ALONE, COMPOUND, FREQUENT = 5, 10, 20

# Words that a text may hold, and the number of a document that has none: less than any bigint.
PLACES, NO_DOCUMENT = Decimal(2**31), Decimal(-(2**63) - 1)


def chunks(w):
    return F.regexp_extract_all(w, F.lit(".{1,3}"), F.lit(0))


def _key(x):
    first = F.substring(x, 1, 1)
    return F.when(F.translate(first, CONSONANTS, "") == "", F.translate(first, CONSONANTS, HAN))


def _spelled(cs):
    def one(x, i):
        repeated = (i > 0) & (_key(F.get(cs, i - 1)) == _key(x))
        return F.coalesce(F.when(repeated, REPEAT_MARK), _key(x), hira(x))

    return F.array_join(F.transform(cs, one), "")


def lexicon(spark, sf) -> DataFrame:
    """Conflict-free list rows with derived surfaces, and the word itself as ``w``."""
    checked = R.row_reasons(R.collapsed(raw_list(spark, sf)))
    free = R.conflict_free(R.valid_rows(checked)).withColumnRenamed("surface", "w")
    cs = chunks(F.col("w"))
    return staged(free.select("w", _spelled(cs).alias("surface"), "reading", "rank"), "lexicon")


def inventory(lex: DataFrame) -> DataFrame:
    """``key, reading, n``: chunks seen often enough to be readings of their key."""
    seen = lex.select(F.explode(chunks(F.col("w"))).alias("x")).select(_key(F.col("x")).alias("key"), hira("x").alias("reading"))
    counts = seen.where("key is not null").groupBy("key", "reading").agg(F.count("*").alias("n"))
    return counts.where(F.col("n") >= ALONE)


def options(inv: DataFrame) -> DataFrame:
    """``key, alone, compound``; three letters bound the options of a key."""
    many = F.collect_list(F.when(F.col("n") >= COMPOUND, F.col("reading")))
    return inv.groupBy("key").agg(
        A.longest_first(F.collect_list("reading")).alias("alone"), A.longest_first(many).alias("compound")
    )


def groups(inv: DataFrame) -> DataFrame:
    kind = F.when(F.col("n") >= FREQUENT, "On").when(F.col("n") >= COMPOUND, "Kun").otherwise("Other")
    return inv.select("key", "reading", F.col("n").alias("ord"), kind.alias("reading_class"))


def aligned(spark, sf) -> tuple[DataFrame, DataFrame]:
    """The aligned list and the reading inventory, both written once."""
    lex = lexicon(spark, sf)
    inv = staged(inventory(lex), "inventory")
    return staged(A.align(lex, options(inv)), "aligned"), inv


SQL_LEX = f"""{SQL_RAW},
cut AS (SELECT w, r, rank, regexp_extract_all(w, '.{{1,3}}') AS cs FROM free),
lex AS (SELECT w, r, rank, len(cs) AS n, array_to_string(list_transform(cs, lambda x, i:
          CASE WHEN NOT contains('{CONSONANTS}', x[1]) THEN translate(x, '{LETTERS}', '{HIRA}')
               WHEN i > 1 AND cs[i - 1][1] = x[1] THEN '{REPEAT_MARK}'
               ELSE translate(x[1], '{CONSONANTS}', '{HAN}') END), '') AS surface FROM cut),
parts AS (SELECT w, r, unnest(cs) AS x, generate_subscripts(cs, 1) AS i FROM cut),
keyed AS (SELECT w, r, i, CASE WHEN contains('{CONSONANTS}', x[1]) THEN translate(x[1], '{CONSONANTS}', '{HAN}') END AS key,
            translate(x, '{LETTERS}', '{HIRA}') AS o FROM parts),
opt AS (SELECT key, o, count(*) AS c FROM keyed WHERE key IS NOT NULL GROUP BY key, o HAVING count(*) >= {ALONE})"""

# The same, with the tables that are read more than once computed once.
SQL_LEX_ONCE = re.sub(r"\b(raw|free|cut|lex|parts|keyed|opt) AS \(", r"\1 AS MATERIALIZED (", SQL_LEX)

SQL_ALIGN = f"""{SQL_LEX},
toks AS (SELECT w, r, i, key,
           CASE WHEN key IS NULL THEN '=' || o
                WHEN coalesce(lag(key) OVER ws, lead(key) OVER ws) IS NULL THEN 'a' || key ELSE 'c' || key END AS k
         FROM keyed WINDOW ws AS (PARTITION BY w ORDER BY i)),
choice AS (SELECT 'a' || key AS k, key, o FROM opt
           UNION ALL SELECT 'c' || key, key, o FROM opt WHERE c >= {COMPOUND}
           UNION ALL SELECT DISTINCT '=' || o, NULL, o FROM keyed WHERE key IS NULL),
st AS (SELECT w, CAST(1 AS BIGINT) AS i, CAST(0 AS BIGINT) AS used, CAST([] AS VARCHAR[]) AS picks FROM lex
       UNION ALL
       SELECT s.w, s.i + 1, s.used + z.len,
              CASE WHEN c.key IS NULL THEN s.picks ELSE list_append(s.picks, c.key || c.o) END
       FROM st s JOIN toks t ON t.w = s.w AND t.i = s.i
                 JOIN (VALUES (1), (2), (3)) z(len) ON true
                 JOIN choice c ON c.k = t.k AND c.o = substr(t.r, s.used + 1, z.len) AND length(c.o) = z.len),
solved AS (SELECT st.w, any_value(st.picks) AS picks FROM st JOIN lex ON lex.w = st.w AND st.i = lex.n + 1 AND st.used = length(lex.r)
           GROUP BY st.w HAVING count(*) = 1),
rows AS (SELECT l.*, g.picks, EXISTS (SELECT 1 FROM keyed k JOIN opt ON opt.key = k.key WHERE k.w = l.w) AS relevant,
           CASE WHEN rank > 100000 THEN 1 / sqrt(rank) * ((100000.0 / rank) * (100000.0 / rank)) ELSE 1 / sqrt(rank) END AS weight
         FROM lex l LEFT JOIN solved g USING (w))"""

SQL_SCORES = f"""{SQL_ALIGN},
pairs AS (SELECT w, weight, unnest(list_distinct(picks)) AS p FROM rows WHERE relevant AND picks IS NOT NULL),
scores AS (SELECT p[1] AS key, p[2:] AS reading, round(CAST(sum(CAST(weight AS DECIMAL(28,18))) AS DOUBLE), 9) AS score
           FROM pairs GROUP BY p)"""


@query("rank_relevant", f"""
WITH {SQL_LEX_ONCE},
known AS MATERIALIZED (SELECT DISTINCT key FROM opt)
SELECT DISTINCT l.surface, l.r AS reading, l.rank FROM lex l JOIN keyed k ON k.w = l.w AND k.r = l.r JOIN known ON known.key = k.key""")
def rank_relevant(spark, sf):
    lex = lexicon(spark, sf)
    return R.relevant(lex.drop("w"), options(inventory(lex)))


@query("surface_tokens", f"""
WITH {SQL_LEX},
ch AS (SELECT w, surface, r, unnest(string_split(surface, '')) AS ch, generate_subscripts(string_split(surface, ''), 1) - 1 AS idx FROM lex),
k AS (SELECT *, CASE WHEN ch IN (SELECT key FROM opt) THEN ch END AS own FROM ch)
SELECT surface, r AS reading, CAST(idx AS BIGINT) AS idx,
       CASE WHEN ch = '{REPEAT_MARK}' THEN last_value(own IGNORE NULLS) OVER (PARTITION BY w ORDER BY idx) ELSE own END AS key
FROM k""")
def surface_tokens(spark, sf):
    lex = lexicon(spark, sf)
    rows = A.surface_tokens(A.surface_chars(lex, options(inventory(lex))))
    return rows.select("surface", "reading", F.explode("steps").alias("t")).select(
        "surface", "reading", F.col("t.idx").cast("bigint").alias("idx"), "t.key"
    )


_SOUND = """CASE WHEN contains('{0}', x[1]) THEN translate(x[1], '{0}', '{1}') || x[2:] END"""


@query("reading_options", f"""
WITH {SQL_LEX},
own AS (SELECT key, o AS x FROM opt),
stem AS (SELECT DISTINCT key, regexp_replace(x, '[^ぁ-ヿ]', '', 'g') AS x FROM own),
variant AS (
  SELECT key, {_SOUND.format('かきくけこさしすせそたちつてとはひふへほ', 'がぎぐげござじずぜぞだぢづでどばびぶべぼ')} AS x FROM stem
  UNION ALL SELECT key, {_SOUND.format('はひふへほ', 'ぱぴぷぺぽ')} FROM stem
  UNION ALL SELECT key, CASE WHEN length(x) >= 2 AND contains('くきちつ', x[-1]) THEN x[:-2] || 'っ' END FROM stem),
allowed AS (SELECT key, o AS x FROM opt
            UNION SELECT key, {_SOUND.format('かきくけこさしすせそたちつてとはひふへほ', 'がぎぐげござじずぜぞだぢづでどばびぶべぼ')} FROM own
            UNION SELECT key, x[:-2] || 'っ' FROM own WHERE length(x) = 3),
found AS (SELECT * FROM (SELECT * FROM stem UNION SELECT * FROM variant WHERE x IS NOT NULL)
         WHERE (key, x) IN (SELECT (key, x) FROM allowed WHERE x IS NOT NULL)
         AND (key, x) NOT IN (SELECT (key, o) FROM opt WHERE c < {COMPOUND} AND length(o) = 1))
SELECT key, row_number() OVER (PARTITION BY key ORDER BY -length(x), x) - 1 AS ord, x AS reading FROM found""")
def reading_options(spark, sf):
    inv = inventory(lexicon(spark, sf))
    # Frequent chunks are listed in katakana, the others with an inflection after the dot.
    frequent = F.col("n") >= COMPOUND
    voiced = F.translate(F.substring("reading", 1, 1), A.PLAIN_FIRST, A.VOICED_FIRST)
    plain = F.translate(F.substring("reading", 1, 1), A.PLAIN_FIRST, "") == ""
    per_key = inv.groupBy("key").agg(
        F.collect_list(F.when(frequent, F.translate("reading", HIRA, KATA))).alias("on"),
        F.collect_list(F.when(~frequent, F.concat("reading", F.lit(".る")))).alias("kun"),
        F.collect_list(F.when(frequent | (F.length("reading") > 1), F.col("reading"))).alias("own"),
        F.collect_list(F.when(plain, F.concat(voiced, F.substr("reading", F.lit(2))))).alias("voiced"),
        F.collect_list(F.when(F.length("reading") == 3, F.concat(F.left("reading", F.lit(2)), F.lit("っ")))).alias("stopped"),
    )
    found = A.compositional_options("on", "kun", F.concat("own", "voiced", "stopped"))
    rows = per_key.select("key", F.posexplode(found).alias("ord", "reading"))
    return rows.withColumn("ord", F.col("ord").cast("bigint"))


@query("align_unique", f"WITH RECURSIVE {SQL_ALIGN} SELECT surface, r AS reading, rank, CASE WHEN relevant THEN array_to_string(picks, ',') END AS picks FROM rows")
def align_unique(spark, sf):
    rows, _ = aligned(spark, sf)
    picks = F.array_join(F.transform("alignment", lambda a: F.concat(a["key"], a["reading"])), ",")
    return rows.select("surface", "reading", "rank", F.when(F.col("relevant") | F.col("alignment").isNotNull(), picks).alias("picks"))


@query("reading_scores", f"""
WITH RECURSIVE {SQL_SCORES}
SELECT s.key, s.reading, s.score,
       CASE WHEN c >= {FREQUENT} THEN 'On' WHEN c >= {COMPOUND} THEN 'Kun' ELSE 'Other' END AS reading_class
FROM scores s JOIN opt ON opt.key = s.key AND opt.o = s.reading WHERE s.score > 0""")
def reading_scores(spark, sf):
    rows, inv = aligned(spark, sf)
    return S.reading_scores(rows, groups(inv)).drop("ord")


SQL_STATS = f"""{SQL_SCORES},
keyed_scores AS (SELECT * FROM scores WHERE score > 0),
stats AS (SELECT count(*) AS rows, count(*) FILTER (relevant) AS relevant_rows,
       count(*) FILTER (relevant AND picks IS NOT NULL) AS aligned_rows,
       count(*) FILTER (relevant AND picks IS NULL) AS ambiguous_rows,
       CAST(coalesce(sum(len(list_distinct(picks))) FILTER (relevant AND picks IS NOT NULL), 0) AS BIGINT) AS reading_assignments,
       CAST(sum(CAST(weight AS DECIMAL(28,18))) FILTER (relevant) AS DOUBLE) AS relevant_weight,
       CAST(sum(CAST(weight AS DECIMAL(28,18))) FILTER (relevant AND picks IS NOT NULL) AS DOUBLE) AS aligned_weight,
       (SELECT count(DISTINCT key) FROM keyed_scores) AS keys_with_scores,
       (SELECT count(*) FROM keyed_scores) AS groups_with_scores
FROM rows)"""


@query("alignment_stats", f"""
WITH RECURSIVE {SQL_STATS}
SELECT * REPLACE (round(relevant_weight, 9) AS relevant_weight, round(aligned_weight, 9) AS aligned_weight),
       round(aligned_weight / relevant_weight, 9) AS weight_coverage FROM stats""")
def alignment_stats(spark, sf):
    rows, inv = aligned(spark, sf)
    stats = S.alignment_stats(rows, S.reading_scores(rows, groups(inv)))
    for c in ("relevant_weight", "aligned_weight", "weight_coverage"):
        stats = stats.withColumn(c, F.round(c, 9))
    return stats


LOW_FLOORS = {"rows": 1_000, "relevant_rows": 1_000, "aligned_rows": 1_000, "keys_with_scores": 10, "weight_coverage": 0.85}


@query("gate_coverage", f"""
WITH RECURSIVE {SQL_STATS},
list_pairs AS (SELECT w, r, count(DISTINCT rank) AS k, count(*) AS c FROM raw GROUP BY w, r),
p AS (SELECT sum(c) AS source_rows, sum(c - k) AS dup, count(*) FILTER (k > 1) AS pairs,
             coalesce(sum(k) FILTER (k > 1), 0) AS excluded FROM list_pairs),
a AS (SELECT *, aligned_weight / relevant_weight AS coverage FROM stats, p)
SELECT unnest([
  {{'check_name': 'floor rows', 'ok': rows >= 1000}},
  {{'check_name': 'floor relevant_rows', 'ok': relevant_rows >= 1000}},
  {{'check_name': 'floor aligned_rows', 'ok': aligned_rows >= 1000}},
  {{'check_name': 'floor keys_with_scores', 'ok': keys_with_scores >= 10}},
  {{'check_name': 'floor weight_coverage', 'ok': coverage >= 0.85}},
  {{'check_name': 'counts are not negative', 'ok': least(source_rows, dup, pairs, excluded) >= 0}},
  {{'check_name': 'source rows add up', 'ok': source_rows = rows + dup + excluded}},
  {{'check_name': 'conflicts have two rows or more', 'ok': excluded >= 2 * pairs}},
  {{'check_name': 'conflicts and exclusions agree', 'ok': (pairs = 0) = (excluded = 0)}},
  {{'check_name': 'rows are nested', 'ok': aligned_rows BETWEEN 0 AND relevant_rows AND relevant_rows <= rows}},
  {{'check_name': 'ambiguous rows add up', 'ok': ambiguous_rows = relevant_rows - aligned_rows}},
  {{'check_name': 'assignments cover rows', 'ok': reading_assignments >= aligned_rows}},
  {{'check_name': 'keys, groups, assignments nested', 'ok': keys_with_scores > 0 AND keys_with_scores <= groups_with_scores
      AND groups_with_scores <= reading_assignments}},
  {{'check_name': 'coverage at most one', 'ok': coverage <= 1}},
  {{'check_name': 'weights are nested', 'ok': aligned_weight > 0 AND aligned_weight <= relevant_weight
      AND relevant_weight <= relevant_rows AND aligned_weight <= aligned_rows}},
  {{'check_name': 'coverage is the weight ratio', 'ok': abs(coverage * relevant_weight - aligned_weight) <= 1e-9 * relevant_weight}}], recursive := true) FROM a""")
def gate_coverage(spark, sf):
    rows, inv = aligned(spark, sf)
    stats = S.alignment_stats(rows, S.reading_scores(rows, groups(inv)))
    parsed = R.parse_stats(R.valid_rows(R.row_reasons(R.collapsed(raw_list(spark, sf))))).drop("rows")
    facts = parsed.select(F.struct(*parsed.columns)).scalar()
    both = stats.withColumn("_p", facts).select(*stats.columns, "_p.*")
    return G.coverage_checks(both, LOW_FLOORS)


# Scores of (source, first letter) and of (source, language): each distinct word
# adds the weight of its rank once.
SQL_INITIALS = f"""{SQL_WORDS},
used AS (SELECT DISTINCT source, lang, w FROM words),
weighted AS (SELECT u.source, u.lang, u.w[1] AS initial, CAST(1 / sqrt(r.rank) AS DECIMAL(28,18)) AS weight
             FROM used u JOIN ranks r USING (lang, w)),
scored AS (SELECT 'initial ' || source AS key, initial AS reading, CAST(sum(weight) AS DECIMAL(38,12)) AS v FROM weighted GROUP BY ALL
           UNION ALL SELECT 'language ' || source, lang, CAST(sum(weight) AS DECIMAL(38,12)) FROM weighted GROUP BY ALL),
places AS (SELECT *, row_number() OVER (PARTITION BY key ORDER BY v DESC, reading) AS p, count(*) OVER (PARTITION BY key) AS n,
             sum(v) OVER (PARTITION BY key) AS total FROM scored),
segs AS (SELECT key, least(p, 5) AS ord, CASE WHEN p <= 4 THEN reading ELSE '' END AS reading, sum(v) AS v, any_value(n) AS n, any_value(total) AS total
         FROM places GROUP BY 1, 2, 3),
sh AS (SELECT *, CAST(v AS DOUBLE) * 100.0 / CAST(total AS DOUBLE) AS e FROM segs),
pl AS (SELECT *, 100 - sum(floor(e)) OVER (PARTITION BY key) AS missing,
         row_number() OVER (PARTITION BY key ORDER BY e - floor(e) DESC, ord) AS place FROM sh),
dist AS (SELECT key, CAST(ord AS BIGINT) AS ord, reading,
           CAST(floor(e) + CASE WHEN place <= missing THEN 1 ELSE 0 END AS BIGINT) AS percent,
           CASE WHEN reading = '' THEN '#767676' ELSE ['#0072b2', '#d55e00', '#009e73', '#cc79a7'][ord] END AS color,
           n >= 5 AS collapsed FROM pl)"""


def initial_scores(spark, sf) -> DataFrame:
    """``key, reading, score``: rank-weighted initials and languages of each source."""
    weighted = source_words(spark, sf).select(
        "source", "lang", F.substring("w", 1, 1).alias("initial"), exact_weight("rank").alias("weight")
    )
    pairs = F.array(
        F.struct(F.concat(F.lit("initial "), F.col("source")).alias("key"), F.col("initial").alias("reading")),
        F.struct(F.concat(F.lit("language "), F.col("source")).alias("key"), F.col("lang").alias("reading")),
    )
    rows = weighted.select("weight", F.explode(pairs).alias("p"))
    return rows.groupBy("p.key", "p.reading").agg(F.sum("weight").alias("score"))


def distributed(spark, sf) -> DataFrame:
    scores = initial_scores(spark, sf).withColumn("pos", F.lit(0)).withColumn("reading_class", F.lit("Other"))
    return D.distribution(scores, ["key"])


@query("dist_topk_other", f"WITH {SQL_INITIALS} SELECT * FROM dist")
def dist_topk_other(spark, sf):
    return distributed(spark, sf).drop("total", "reading_class")


@query("dist_labels", f"""
WITH {SQL_INITIALS},
named AS (SELECT key, ord, CASE WHEN reading = '' THEN 'Other' ELSE reading END AS name, percent FROM dist)
SELECT key, string_agg(name || ' ' || percent || ' percent', ', ' ORDER BY ord) AS alt_text,
       string_agg(name || ': ' || percent || '%', chr(10) ORDER BY ord) AS legend FROM named GROUP BY key""")
def dist_labels(spark, sf):
    return D.labels(distributed(spark, sf), ["key"])


@query("largest_remainder", """
WITH c AS (SELECT user_id, event_type, count(*) AS v FROM events GROUP BY ALL),
e AS (SELECT *, v * 100.0 / CAST(sum(v) OVER (PARTITION BY user_id) AS DOUBLE) AS e FROM c),
p AS (SELECT *, 100 - sum(floor(e)) OVER (PARTITION BY user_id) AS missing,
        row_number() OVER (PARTITION BY user_id ORDER BY e - floor(e) DESC, event_type) AS place FROM e)
SELECT user_id, event_type, v, CAST(floor(e) + CASE WHEN place <= missing THEN 1 ELSE 0 END AS BIGINT) AS percent FROM p""")
def largest_remainder(spark, sf):
    counts = table(spark, sf, "events").groupBy("user_id", "event_type").agg(F.count("*").alias("v"))
    return D.largest_remainder(counts, ["user_id"], "event_type", "v")


# Reading groups of a source: its whole words, with totals that may be zero or less.
SQL_GROUPS = f"""{SQL_WORDS},
g AS (SELECT source AS key, translate(w, '{LETTERS}', '{HIRA}') AS stem, length(w) - 3 AS total FROM words),
entries AS (SELECT key, stem, CAST(sum(total) AS BIGINT) AS entries FROM g WHERE total > 0 GROUP BY ALL)"""


def word_groups(spark, sf) -> DataFrame:
    words = document_words(spark, sf, "source").select("source", "w", (F.length("w") - 3).alias("total"))
    # Equal words add up before their text is worked on.
    summed = words.groupBy("source", "w").agg(F.sum(F.when(F.col("total") > 0, F.col("total"))).alias("total"))
    return summed.select(F.col("source").alias("key"), RD.reading_stem(kata("w")).alias("stem"), "total")


@query("reading_entry_counts", f"""
WITH {SQL_GROUPS} SELECT key, stem, entries, row_number() OVER (PARTITION BY key ORDER BY entries DESC, stem) AS ord FROM entries""")
def reading_entry_counts(spark, sf):
    return RD.ordered_counts(RD.entry_counts(word_groups(spark, sf), ["key"]), ["key"])


@query("topk_readings", f"""
WITH {SQL_GROUPS}
SELECT key, stem, entries, row_number() OVER (PARTITION BY key ORDER BY entries DESC, stem) AS ord FROM entries
QUALIFY ord <= 3""")
def topk_readings(spark, sf):
    top = RD.top_readings(RD.entry_counts(word_groups(spark, sf), ["key"]), ["key"])
    return top.withColumn("ord", F.col("ord").cast("bigint"))


def first_places(spark, sf) -> DataFrame:
    """``key, w, at``: the first place of each word of a source."""
    docs = spread(table(spark, sf, "documents").select("source", "doc_id", "text"))
    # Places are one number, the document's times 2^31 and the word's, so that the first ones are found by hashing
    # instead of sorting all words; a document without a number comes before all others.
    number = F.coalesce(F.col("doc_id").cast("decimal(20,0)"), F.lit(NO_DOCUMENT))
    words = docs.select(
        F.col("source").alias("key"), (number * F.lit(PLACES)).cast("decimal(38,0)").alias("base"),
        F.posexplode(F.regexp_extract_all(F.lower("text"), F.lit(WORD), F.lit(0))).alias("p", "w"),
    ).select("key", "w", (F.col("base") + F.col("p")).cast("decimal(38,0)").alias("at"))
    return words.groupBy("key", "w").agg(F.min("at").alias("at"))


@query("reading_group_order", rf"""
WITH w AS (SELECT source AS key, doc_id, unnest(regexp_extract_all(lower(text), '{WORD}')) AS w,
             generate_subscripts(regexp_extract_all(lower(text), '{WORD}'), 1) - 1 AS p FROM documents),
f AS (SELECT key, translate(w, '{LETTERS}', '{HIRA}') AS stem, min({{'doc': doc_id, 'p': p}}) AS first FROM w GROUP BY ALL)
SELECT key, stem, first.doc AS first_doc, CAST(first.p AS BIGINT) AS first_pos, row_number() OVER (PARTITION BY key ORDER BY first) AS ord FROM f""")
def reading_group_order(spark, sf):
    # The first place of each word comes first; only distinct words are turned into stems.
    rows = first_places(spark, sf).select("key", RD.reading_stem(kata("w")).alias("stem"), F.col("at").alias("pos"))
    p = F.pmod("first_pos", F.lit(PLACES)).cast("bigint")
    doc = ((F.col("first_pos") - p) / F.lit(PLACES)).cast("decimal(20,0)")
    return RD.group_order(rows, ["key"]).select(
        "key", "stem", F.when(doc != F.lit(NO_DOCUMENT), doc).cast("bigint").alias("first_doc"), p.alias("first_pos"), "ord",
    )
