"""The named queries of the operators: thin steps from the given tables to an operator and back."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import language, line_dedup, manifest, mixing, near_copies, neighbours, packing, page_text, quotes, repair, secret_scan, topk, toxicity

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def register(f):
        QUERIES[name] = f
        if sql is not None:
            ORACLES[name] = sql
        return f

    return register


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf.rstrip('/')}/{name}.parquet")


def glosses(docs: DataFrame) -> DataFrame:
    """Documents as records: their id is the key, their text the gloss."""
    return docs.select(F.col("doc_id").alias("key"), F.col("text").alias("gloss"), "lang", "source")


@query("op7_packing")
def op7_packing(spark, sf):
    pieces = packing.pack_glosses(
        glosses(table(spark, sf, "documents")), public_tokenizers.path("word_bpe_49k.json"), end_id=2,
    )
    return pieces.select(
        F.col("key").alias("doc_id"), "start", "length", F.crc32("ids").alias("ids_crc32"),
        F.col("n_tokens").alias("doc_tokens"), F.col("sequence").alias("sequence_id"), "offset", "bucket",
    )


@query("op4_neighbours")
def op4_neighbours(spark, sf):
    rows = table(spark, sf, "embeddings").select(F.col("vec_id").alias("key"), F.col("embedding").alias("vector"))
    found = neighbours.nearest(rows, rows.where("key % 50 = 0"), k=5)
    return found.select(F.col("query").alias("query_id"), "rank", F.col("key").alias("vec_id"), "score")


@query("op5_topk", """
WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(1024 * CAST(x AS DOUBLE)) AS BIGINT)) AS w
           FROM embeddings WHERE embedding IS NOT NULL
             AND list_count(embedding) = len(embedding) AND len(list_filter(embedding, lambda x: NOT isfinite(x))) = 0),
s AS (SELECT q.vec_id AS query_id, r.vec_id,
        CAST(list_sum(list_transform(range(1, len(q.w) + 1), lambda i: q.w[i] * r.w[i])) AS BIGINT) AS score
      FROM v q JOIN v r ON q.vec_id % 100 = 0 AND q.vec_id <> r.vec_id)
SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank, vec_id, score
FROM s QUALIFY row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) <= 10""")
def op5_topk(spark, sf):
    part = lambda x: F.floor(x.cast("double") * 1024)
    rows = table(spark, sf, "embeddings").where(
        "embedding IS NOT NULL AND NOT exists(embedding, x -> x IS NULL OR isnan(x) OR abs(x) = double('infinity'))"
    ).select(
        F.col("vec_id").alias("key"), F.transform("embedding", part).alias("scores"),
        F.transform("embedding", lambda _, i: i.cast("bigint")).alias("terms"),
    )
    found = topk.top_scores(rows, rows.where("key % 100 = 0"), k=10)
    return found.select(F.col("query").alias("query_id"), "rank", F.col("key").alias("vec_id"), "score")


def held_out(key: str) -> Column:
    """Whether a document is kept from training."""
    return F.coalesce(F.crc32(F.col(key).cast("string").cast("binary")) % 4 == 2, F.lit(False))


def language_model(spark: SparkSession, sf: str) -> language.LanguageModel:
    """Piece probabilities of the given documents' languages, without those held out."""
    known = glosses(table(spark, sf, "documents")).where(~held_out("key"))
    return language.train(known, public_tokenizers.path("piece_bpe_32k.model"), language="lang")


@query("op9_language")
def op9_language(spark, sf):
    found = language.identify(glosses(table(spark, sf, "documents")), language_model(spark, sf))
    return found.select(
        F.col("key").alias("doc_id"), held_out("key").alias("held_out"), F.col("language").alias("lang_pred"), "score",
    )


@query("op10_page_text")
def op10_page_text(spark, sf):
    pages = table(spark, sf, "pages").select(F.struct("page_id", "url").alias("key"), F.col("html").alias("markup"))
    return page_text.main_text(pages).select("key.page_id", "key.url", "text", F.char_length("text").cast("bigint").alias("n_chars"))


@query("op6_near_copies", r"""
WITH RECURSIVE w AS (
  SELECT doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                                   '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w FROM documents),
s AS (SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 3 THEN [w]
             ELSE list_distinct(list_transform(range(1, len(w) - 1), lambda i: w[i:i + 2])) END AS s FROM w),
d AS MATERIALIZED (SELECT dense_rank() OVER (ORDER BY list_sort(s)) AS u, * FROM s),
units AS MATERIALIZED (SELECT u, min(doc_id) AS rep, len(any_value(s)) AS n, any_value(s) AS s FROM d WHERE len(s) > 0 GROUP BY u),
t AS MATERIALIZED (SELECT rep, n, unnest(list_transform(s, lambda x: hash(x))) AS h FROM units),
links AS MATERIALIZED (
  SELECT a.rep AS a, b.rep AS b FROM t a JOIN t b ON a.h = b.h AND a.rep < b.rep AND 100 * least(a.n, b.n) >= 90 * greatest(a.n, b.n)
  GROUP BY a.rep, b.rep, a.n, b.n HAVING 100 * count(*) >= 90 * (a.n + b.n - count(*))),
both_ways AS (SELECT a, b FROM links UNION ALL SELECT b, a FROM links),
reach(a, b) AS (SELECT rep, rep FROM units UNION SELECT r.a, e.b FROM reach r JOIN both_ways e ON r.b = e.a),
c AS (SELECT a AS rep, min(b) AS component_id FROM reach GROUP BY a)
SELECT doc_id, CAST(len(d.s) AS BIGINT) AS n_shingles, coalesce(component_id, doc_id) AS component_id
FROM d LEFT JOIN units USING (u) LEFT JOIN c USING (rep)""")
def op6_near_copies(spark, sf):
    found = near_copies.near_copies(glosses(table(spark, sf, "documents")), words=3, percent=90)
    return found.select(F.col("key").alias("doc_id"), "n_shingles", F.col("component").alias("component_id"))


@query("op8_line_dedup")
def op8_line_dedup(spark, sf):
    found = line_dedup.remove_repeated_lines(glosses(table(spark, sf, "documents")))
    return found.select(F.col("key").alias("doc_id"), F.col("gloss").alias("text"), "removed")


@query("op2_quotes")
def op2_quotes(spark, sf):
    return quotes.conversations(table(spark, sf, "conversations"), thread="conv_id", position="turn")


def domains(spark: SparkSession, sf: str) -> DataFrame:
    """The labelled documents: toxic, or of high or low quality."""
    domain = F.when(F.col("toxic") == 1, "toxic").when(F.col("quality") == 1, "high").when(F.col("quality") == 0, "low")
    return table(spark, sf, "labels").select(F.col("doc_id").alias("key"), domain.alias("domain"))


@query("op1_mixing")
def op1_mixing(spark, sf):
    mixed = mixing.mix(
        glosses(table(spark, sf, "documents")), domains(spark, sf), {"high": 1.2, "low": 0.5, "toxic": 0.0}, relative=True,
    )
    return mixed.select(
        F.col("key").alias("doc_id"), "n_tokens", *[F.col("posterior")[d].alias(f"p_{d}") for d in ("high", "low", "toxic")],
        "rate", "copies",
    )


#: Score from which a document is said to be toxic.
TOXIC = 0.7


def toxicity_model(spark: SparkSession, sf: str) -> toxicity.ToxicityModel:
    """The classifier of the labelled documents that are not held out."""
    labels = table(spark, sf, "labels").select(F.col("doc_id").alias("key"), "toxic").where(~toxic_held_out("key"))
    return toxicity.train(glosses(table(spark, sf, "documents")), labels)


def toxic_held_out(key: str) -> Column:
    return F.coalesce(F.crc32(F.col(key).cast("string").cast("binary")) % 3 == 1, F.lit(False))


@query("op11_toxicity")
def op11_toxicity(spark, sf):
    found = toxicity.score(glosses(table(spark, sf, "documents")), toxicity_model(spark, sf))
    return found.select(
        F.col("key").alias("doc_id"), toxic_held_out("key").alias("held_out"), "score", F.when(F.col("score") >= TOXIC, 1).otherwise(0).alias("predicted"),
    )


def crc32_sql(text: str) -> str:
    """The unsigned CRC-32 of an ASCII text in SQL, bit by bit."""
    byte = "list_reduce(range(8), lambda c, k: xor(c >> 1, 3988292384 * (c & 1)), xor(crc, b))"
    codes = f"list_transform(range(1, len({text}) + 1), lambda i: CAST(ascii(substr({text}, i, 1)) AS BIGINT))"
    return f"xor(list_reduce({codes}, lambda crc, b: {byte}, CAST(4294967295 AS BIGINT)), 4294967295)"


@query("op12_repair", rf"""
WITH RECURSIVE hit AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
    {crc32_sql("(coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' '))")} % 20 AS h FROM conversations),
damaged AS (
  SELECT conv_id, turn, CASE WHEN h = 4 THEN 'user' ELSE role END AS role,
    CASE h WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text
  FROM (SELECT *, unnest(range(CASE h WHEN 0 THEN 0 WHEN 3 THEN 2 ELSE 1 END)) FROM hit)),
numbered AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS i FROM damaged),
m AS MATERIALIZED (
  SELECT *, left(role, 1) AS c, CASE WHEN NOT regexp_matches(text, '[^ 	-
]') THEN 'blank'
      WHEN row_number() OVER (PARTITION BY conv_id, role, text ORDER BY i) > 1 THEN 'duplicate'
      WHEN regexp_matches(text, '[^ 	-
.!?][ 	-
]*$') THEN 'truncated' ELSE '' END AS fault,
    lag(left(role, 1)) OVER (PARTITION BY conv_id ORDER BY i) AS b FROM numbered),
counts AS (
  SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (fault = 'blank') AS blank,
    count(*) FILTER (fault = 'duplicate') AS duplicate, count(*) FILTER (fault = 'truncated') AS truncated,
    count(*) FILTER (b IS NOT NULL AND b || c NOT IN ('su', 'ua', 'au')) AS illegal, max(i) AS n FROM m GROUP BY conv_id),
-- States: 0 start, 1 after s, 2 after u, 3 after a.
t(s, c, e) AS (VALUES (0, 's', 1), (0, 'u', 2), (1, 'u', 2), (3, 'u', 2), (2, 'a', 3)),
gap AS (SELECT s, e, 3 AS cost, 'I' AS letter FROM t WHERE c <> 's' UNION ALL SELECT s, s, 0, '' FROM (VALUES (0), (1), (2), (3)) x(s)),
r(conv_id, i, s, best) AS (
  SELECT conv_id, CAST(0 AS BIGINT), 0, {{'cost': 0, 'audit': ''}} FROM counts
  UNION ALL
  SELECT r.conv_id, m.i, x.e, min({{'cost': r.best.cost + gap.cost + x.cost, 'audit': r.best.audit || gap.letter || x.letter}})
  FROM r JOIN m ON m.conv_id IS NOT DISTINCT FROM r.conv_id AND m.i = r.i + 1 JOIN gap ON gap.s = r.s
  JOIN LATERAL (
    SELECT gap.e, 4 AS cost, 'D' AS letter
    UNION ALL SELECT t.e, CASE m.fault WHEN 'truncated' THEN 3 ELSE 0 END, 'K' FROM t WHERE t.s = gap.e AND t.c = m.c AND m.fault IN ('', 'truncated')
    UNION ALL SELECT t.e, CASE m.fault WHEN 'truncated' THEN 6 ELSE 3 END, 'R' FROM t WHERE t.s = gap.e AND t.c <> 's' AND m.fault IN ('', 'truncated')
  ) x ON true
  GROUP BY r.conv_id, m.i, x.e, len(r.best.audit || gap.letter || x.letter)),
best AS MATERIALIZED (
  SELECT r.conv_id, min({{'cost': best.cost + gap.cost, 'audit': best.audit || gap.letter}}) AS best
  FROM r JOIN counts ON r.conv_id IS NOT DISTINCT FROM counts.conv_id AND i = n JOIN gap ON gap.s = r.s WHERE gap.e IN (0, 3) GROUP BY r.conv_id),
letters AS (SELECT conv_id, substr(best.audit, p, 1) AS letter, p FROM (SELECT *, unnest(range(1, len(best.audit) + 1)) AS p FROM best)),
placed AS (SELECT *, count(*) FILTER (letter <> 'I') OVER w AS i, count(*) FILTER (letter <> 'D') OVER w AS place FROM letters
           WINDOW w AS (PARTITION BY conv_id ORDER BY p)),
edits AS (
  SELECT l.conv_id, place, CASE WHEN letter <> 'I' THEN m.text ELSE '' END AS text, letter, m.role,
    max(CASE WHEN place = 1 AND letter = 'K' AND m.c = 's' THEN 1 ELSE 0 END) OVER (PARTITION BY l.conv_id) AS sys
  FROM placed l LEFT JOIN m ON m.conv_id IS NOT DISTINCT FROM l.conv_id AND m.i = l.i WHERE letter <> 'D'),
texts AS (
  SELECT conv_id, string_agg(CASE WHEN letter = 'K' THEN role WHEN (place - sys) % 2 = 1 THEN 'user' ELSE 'assistant' END || ':' || text,
                             chr(10) ORDER BY place) AS text FROM edits GROUP BY conv_id)
SELECT o.conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate,
  coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal, CAST(coalesce(best.cost, 0) AS BIGINT) AS cost,
  coalesce(best.audit, '') AS audit, sha256(coalesce(texts.text, '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) o LEFT JOIN counts ON o.conv_id IS NOT DISTINCT FROM counts.conv_id
LEFT JOIN best ON o.conv_id IS NOT DISTINCT FROM best.conv_id LEFT JOIN texts ON o.conv_id IS NOT DISTINCT FROM texts.conv_id""")
def op12_repair(spark, sf):
    given = table(spark, sf, "conversations")
    name = F.concat_ws(":", *[F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("conv_id", "turn")])
    hit = given.select("conv_id", "turn", *[F.coalesce(c, F.lit(" ")).alias(c) for c in ("role", "text")], (F.crc32(name.cast("binary")) % 20).alias("h"))
    times = F.when(F.col("h") == 0, F.array().cast("array<int>")).when(F.col("h") == 3, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))
    text = F.when(F.col("h") == 1, "").when(F.col("h") == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text"))
    damaged = hit.select(
        "conv_id", "turn", F.when(F.col("h") == 4, "user").otherwise(F.col("role")).alias("role"), text.alias("text"), F.explode(times),
    ).drop("col")
    found, mended = repair.repair(damaged, thread="conv_id", position="turn")
    digests = repair.conversation_digests(mended).select(F.col("thread").alias("conv_id"), "sha256")
    found = found.withColumnRenamed("thread", "conv_id")
    both = given.select("conv_id").distinct().alias("o").join(found.alias("f"), F.expr("o.conv_id <=> f.conv_id"), "left").join(
        digests.alias("d"), F.expr("o.conv_id <=> d.conv_id"), "left",
    )
    longs = [F.coalesce(c, F.lit(0)).cast("bigint").alias(c) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")]
    empty = F.sha2(F.lit("").cast("binary"), 256)
    return both.select("o.conv_id", *longs, F.coalesce("audit", F.lit("")).alias("audit"), F.coalesce("sha256", empty).alias("repaired_sha256"))


LEAF_SQL = "sha256(" + " || ".join(
    f"coalesce(strlen(CAST({c} AS VARCHAR)) || ':' || CAST({c} AS VARCHAR), '-')" for c in ("doc_id", "source", "lang", "n_chars", "{text}")
) + ")"


@query("op13_manifest", f"""
WITH RECURSIVE rows AS MATERIALIZED (
  SELECT doc_id, lang, {LEAF_SQL.format(text="text")} AS leaf,
    CASE WHEN {crc32_sql("CAST(doc_id AS VARCHAR)")} % 3 = 0
      THEN {LEAF_SQL.format(text="translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')")} END AS shown FROM documents),
leaves AS MATERIALIZED (
  SELECT *, row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, leaf) - 1 AS r FROM rows),
low(lang, l, i, d, n) AS (
  SELECT lang, 0, r, leaf, count(*) OVER (PARTITION BY lang) FROM leaves
  UNION ALL SELECT lang, l, i, d, count(*) OVER (PARTITION BY lang) FROM (
    SELECT lang, l + 1 AS l, i // 8 AS i, sha256(string_agg(d, '' ORDER BY i)) AS d FROM low WHERE n > 1 GROUP BY lang, l, i // 8)),
low_nodes AS MATERIALIZED (SELECT * FROM low),
subroots AS MATERIALIZED (
  SELECT lang, d AS subroot, l AS height, row_number() OVER (ORDER BY lang NULLS FIRST) - 1 AS r FROM low_nodes WHERE n = 1),
high(l, i, d, n) AS (
  SELECT 0, r, subroot, count(*) OVER () FROM subroots
  UNION ALL SELECT l, i, d, count(*) OVER () FROM (
    SELECT l + 1 AS l, i // 8 AS i, sha256(string_agg(d, '' ORDER BY i)) AS d FROM high WHERE n > 1 GROUP BY l, i // 8)),
high_nodes AS MATERIALIZED (SELECT * FROM high),
-- All nodes in one numbering: those above a subroot follow its own level.
nodes AS MATERIALIZED (
  SELECT lang, l, i, d FROM low_nodes WHERE n > 1
  UNION ALL SELECT s.lang, s.height + h.l, h.i, h.d FROM high_nodes h, subroots s WHERE h.n > 1),
path(lang, r, own, l, i, now, siblings, up) AS (
  SELECT v.lang, v.r, v.own, 0, CASE WHEN height = 0 THEN s.r ELSE v.r END, v.own, '', height
  FROM (SELECT lang, r, leaf AS own FROM leaves UNION ALL SELECT lang, r, shown FROM leaves WHERE shown IS NOT NULL) v
  JOIN subroots s ON v.lang IS NOT DISTINCT FROM s.lang
  UNION ALL
  SELECT p.lang, p.r, p.own, p.l + 1, CASE WHEN p.l + 1 = p.up THEN any_value(s.r) ELSE p.i // 8 END,
    sha256(string_agg(CASE WHEN n.i = p.i THEN p.now ELSE n.d END, '' ORDER BY n.i)),
    p.siblings || coalesce(string_agg(n.d, '' ORDER BY n.i) FILTER (n.i <> p.i), ''), p.up
  FROM path p JOIN nodes n ON n.lang IS NOT DISTINCT FROM p.lang AND n.l = p.l AND n.i // 8 = p.i // 8
  JOIN subroots s ON p.lang IS NOT DISTINCT FROM s.lang
  GROUP BY p.lang, p.r, p.own, p.l, p.i, p.now, p.siblings, p.up),
ends AS (SELECT * FROM path QUALIFY l = max(l) OVER (PARTITION BY lang, r, own))
SELECT v.doc_id, v.leaf, s.subroot, h.d AS root, sha256(a.siblings) AS proof_sha256,
  b.now AS folded_root, b.now = h.d AS verified
FROM leaves v JOIN subroots s ON v.lang IS NOT DISTINCT FROM s.lang JOIN high_nodes h ON h.n = 1
JOIN ends a ON a.lang IS NOT DISTINCT FROM v.lang AND a.r = v.r AND a.own = v.leaf
JOIN ends b ON b.lang IS NOT DISTINCT FROM v.lang AND b.r = v.r AND b.own = coalesce(v.shown, v.leaf)""")
def op13_manifest(spark, sf):
    fields = ["doc_id", "source", "lang", "n_chars", "text"]
    tampered = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 0
    lower = F.translate("text", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    found = [*fields[:4], F.when(tampered, lower).otherwise(F.col("text"))]
    proved = manifest.prove(table(spark, sf, "documents"), fields, key="doc_id", source="lang", found=found)
    return proved.select("doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified")


#: Share of the distinct documents from which a word belongs to the dictionary of the secret scan.
COMMON = 0.002


@query("op3_secret_scan")
def op3_secret_scan(spark, sf):
    docs = table(spark, sf, "documents")
    # A document without an id has a path that ends in a slash.
    name = F.concat_ws("/", *[F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("source", "doc_id")])
    files = docs.select(name.alias("path"), F.col("text").alias("content"))
    # Findings of the labelled documents, told by their shape and what they are assigned to, where that tells.
    doc_id = F.element_at(F.split("path", "/"), -1).try_cast("bigint")
    found = secret_scan.places(files).select(doc_id.alias("doc_id"), "path", "at", "part", secret_scan.told().alias("secret"))
    reviewed = found.where("secret IS NOT NULL").join(table(spark, sf, "labels").select("doc_id").distinct(), "doc_id", "left_semi")
    found = secret_scan.scan(files, secret_scan.common_words(docs, COMMON), reviewed)
    return found.select(doc_id.alias("doc_id"), "at", "part", "candidate", "score")
