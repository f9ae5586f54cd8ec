"""Markup of the pages: strokes, components, whitelisting, unsafe content, references.

Paragraphs stand for strokes and links for named components.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import markup as M
from ..operators import gates as G
from ..session import work_path
from ..sources import files
from .base import SQL_WORDS, query, table, word_ranks

PARAGRAPH = r"<p\b[^>]*>([^<]*)"
LINK = r'<a href="([^"]*)"'
LABEL = r'<a href="(/)([^"]*)">([^<]*)</a>'
FIRST_LINK = "/the"


@query("markup_features", rf"""
WITH g AS (SELECT page_id, CASE WHEN contains(html, '</body>') THEN html ELSE replace(html, '<p', '<q') END AS html FROM pages),
f AS (SELECT page_id, len(regexp_extract_all(html, '<p\b[^>]*>')) AS n, regexp_extract_all(html, '{LINK}', 1) AS es FROM g),
e AS (SELECT page_id, e, min(i) AS i FROM (SELECT page_id, unnest(es) AS e, generate_subscripts(es, 1) AS i FROM f) GROUP BY ALL),
a AS (SELECT * FROM e UNION ALL SELECT page_id, '{FIRST_LINK}', 0 FROM f WHERE NOT list_contains(es, '{FIRST_LINK}'))
SELECT page_id, CAST(n AS BIGINT) AS stroke_count, e AS component,
       row_number() OVER (PARTITION BY page_id ORDER BY i) - 1 AS ord FROM a JOIN f USING (page_id) WHERE n > 0
UNION ALL SELECT page_id, NULL, NULL, NULL FROM f WHERE n = 0""")
def markup_features(spark, sf):
    """Paragraphs as strokes; pages that were cut short have none, and so no features."""
    whole = F.when(F.contains("html", F.lit("</body>")), F.col("html")).otherwise(F.replace("html", F.lit("<p"), F.lit("<q")))
    rows = table(spark, sf, "pages").select("page_id", whole.alias("html")).select(
        "page_id", M.stroke_count("html", PARAGRAPH).cast("bigint").alias("stroke_count"),
        F.posexplode_outer(M.components("html", F.lit(FIRST_LINK), LINK, PARAGRAPH)).alias("ord", "component"),
    )
    return rows.withColumn("ord", F.col("ord").cast("bigint"))


@query("markup_first_marker", f"""
SELECT page_id, list_filter(regexp_extract_all(html, '{LINK}', 1), lambda m: m <> '' AND m <> '/The')[1] AS marker FROM pages""")
def markup_first_marker(spark, sf):
    return table(spark, sf, "pages").select("page_id", M.first_marker("html", F.lit("/The"), LINK).alias("marker"))


@query("markup_whitelist", rf"""
SELECT page_id, '<svg xmlns="http://www.w3.org/2000/svg">'
  || array_to_string(list_transform(regexp_extract_all(html, '{PARAGRAPH}', 1), lambda d: '<path d="' || d || '"/>'), '')
  || array_to_string(list_transform(list_zip(regexp_extract_all(html, '{LABEL}', 2), regexp_extract_all(html, '{LABEL}', 3)),
       lambda t: '<text x="/" y="' || t[1] || '">' || t[2] || '</text>'), '') || '</svg>' AS svg FROM pages""")
def markup_whitelist(spark, sf):
    return table(spark, sf, "pages").select("page_id", M.rebuilt("html", PARAGRAPH, LABEL).alias("svg"))


@query("scan_unsafe_markup", r"""
WITH t AS (SELECT 'page' AS kind, html AS text FROM pages UNION ALL SELECT 'document', text FROM documents),
h AS (SELECT kind, unnest([CASE WHEN regexp_matches(text, '(?i)<script') THEN 'script' END, CASE WHEN contains(text, 'kvg:') THEN 'namespace' END,
        CASE WHEN regexp_matches(text, '(?i)xlink') THEN 'xlink' END, CASE WHEN regexp_matches(text, '(?i)\son\w+=') THEN 'handler' END,
        CASE WHEN regexp_matches(text, '(?i)<image') THEN 'image' END, CASE WHEN regexp_matches(text, '(?i)<!doctype') THEN 'doctype' END,
        'scanned']) AS hit FROM t)
SELECT kind, hit, count(*) AS n FROM h WHERE hit IS NOT NULL GROUP BY ALL""")
def scan_unsafe_markup(spark, sf):
    pages = table(spark, sf, "pages").select(F.lit("page").alias("kind"), F.col("html").alias("text"))
    docs = table(spark, sf, "documents").select(F.lit("document").alias("kind"), "text")
    hits = F.concat(M.unsafe_hits("text"), F.array(F.lit("scanned")))
    return pages.unionByName(docs).select("kind", F.explode(hits).alias("hit")).groupBy("kind", "hit").agg(F.count("*").alias("n"))


@query("dangling_refs", f"""
WITH r AS (SELECT DISTINCT unnest(regexp_extract_all(html, '{LINK}', 1)) AS ref FROM pages),
a AS (SELECT DISTINCT unnest(regexp_extract_all(html, '{LINK}', 1)) AS ref FROM pages WHERE contains(html, '<html lang="en">'))
SELECT ref FROM r WHERE ref NOT IN (FROM a)""")
def dangling_refs(spark, sf):
    """Links of all pages that no English page has."""
    pages = table(spark, sf, "pages")
    english = pages.where(F.contains("html", F.lit('<html lang="en">')))
    assets = english.select(F.explode(M.references("html", LINK)).alias("ref"))
    return pages.select(F.explode(M.references("html", LINK)).alias("ref")).distinct().join(assets, "ref", "left_anti")


def _corpus(spark, sf) -> str:
    """Pages as files, each in a folder named by its decimal number: one file per key."""
    path = work_path(spark, "corpus")
    pages = table(spark, sf, "pages").select(F.concat(F.col("page_id").cast("string"), F.lit(".svg")).alias("name"), F.col("html").alias("value"))
    files.write_per_name(pages, path)
    return path


@query("src_markup_corpus", "SELECT page_id, html AS svg FROM pages")
def src_markup_corpus(spark, sf):
    rows = files.markup_texts(spark, _corpus(spark, sf), r"name=([0-9]+)\.svg/")
    text = F.regexp_replace("svg", r"\n\z", "")
    return rows.select(F.col("name").cast("bigint").alias("page_id"), text.alias("svg"))


@query("src_file_digest", """
SELECT page_id, CAST(octet_length(encode(html)) + 1 AS BIGINT) AS byte_count, sha256(html || chr(10)) AS sha256 FROM pages""")
def src_file_digest(spark, sf):
    rows = files.digests(spark, _corpus(spark, sf))
    name = F.regexp_extract("path", r"name=([0-9]+)\.svg/", 1)
    return rows.where(name != "").select(name.cast("bigint").alias("page_id"), "byte_count", "sha256")


@query("gate_path_canonical", r"""
WITH p AS (SELECT url AS path FROM pages UNION ALL SELECT split_part(url, '://', 2) FROM pages
           UNION ALL SELECT unnest(regexp_extract_all(html, '<a href="([^"]*)"', 1)) FROM pages)
SELECT path, NOT (path LIKE '%\%' OR path = '' OR path LIKE '/%' OR path LIKE '%/' OR contains(path, '//')
                  OR regexp_matches(path, '(^|/)\.{1,2}(/|$)')) AS ok, count(*) AS n FROM p GROUP BY ALL""")
def gate_path_canonical(spark, sf):
    pages = table(spark, sf, "pages")
    paths = pages.select(F.col("url").alias("path"))
    bare = pages.select(F.get(F.split("url", "://"), 1).alias("path"))
    links = pages.select(F.explode(F.regexp_extract_all("html", F.lit(LINK), F.lit(1))).alias("path"))
    rows = paths.unionByName(bare).unionByName(links)
    return rows.groupBy("path", G.canonical_path("path").alias("ok")).agg(F.count("*").alias("n"))


@query("gate_inventory_policy", f"""
WITH {SQL_WORDS},
f AS (SELECT DISTINCT substr(ref, 2) AS path FROM (SELECT unnest(regexp_extract_all(html, '{LINK}', 1)) AS ref FROM pages) WHERE ref LIKE '/%'),
req AS (SELECT DISTINCT w AS path FROM ranks WHERE rank <= 50),
forb AS (SELECT DISTINCT w AS path FROM ranks WHERE rank > 1000)
SELECT path, 'missing' AS fault FROM req WHERE path NOT IN (FROM f)
UNION ALL SELECT path, 'forbidden' FROM f WHERE path IN (FROM forb)
UNION ALL SELECT path, 'unexpected folder' FROM f WHERE contains(path, '/') AND NOT regexp_full_match(path, '[a-z]+/[a-z]+')""")
def gate_inventory_policy(spark, sf):
    """Links as files: the commonest words are required, rare ones forbidden."""
    pages = table(spark, sf, "pages")
    refs = pages.select(F.explode(M.references("html", LINK)).alias("ref")).where("ref like '/%'")
    names = refs.select(F.substr("ref", F.lit(2)).alias("path")).distinct()
    ranked = word_ranks(spark, sf)
    rule = F.when(F.col("rank") <= 50, "required").when(F.col("rank") > 1000, "forbidden")
    policy = ranked.select(F.col("w").alias("path"), rule.alias("rule")).where("rule is not null").distinct()
    return G.inventory_policy(names, policy, r"\A[a-z]+/[a-z]+\z")
