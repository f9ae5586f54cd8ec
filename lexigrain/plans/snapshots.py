"""Inventories, verification, work-lists, change detection and versions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators import gates as G
from ..operators import snapshot as SN
from ..operators import versions as VS
from ..operators.ranking import full_rank
from ..session import staged
from .base import query, table


def _named(docs: DataFrame) -> DataFrame:
    return docs.select(F.concat_ws("/", "source", F.concat(F.col("doc_id"), F.lit(".txt"))).alias("path"), "text")


def declared(spark, sf) -> DataFrame:
    """The lock: every document's path, size and digest."""
    return SN.inventory(_named(table(spark, sf, "documents")), "path", "text")


def found(spark, sf) -> DataFrame:
    """The files as found: toxic documents are gone, French ones are in capitals, those
    of one source are longer and those of another come twice, and pages are not declared."""
    docs = table(spark, sf, "documents")
    toxic = table(spark, sf, "labels").where("toxic = 1").select("doc_id")
    text = F.when(F.col("lang") == "fr", F.upper("text")).when(F.col("source") == "src3", F.concat("text", F.lit("!")))
    kept = docs.join(toxic, "doc_id", "left_anti").withColumn("text", F.coalesce(text, "text"))
    twice = kept.where("source = 'src5'")
    pages = table(spark, sf, "pages").select(F.col("url").alias("path"), F.col("html").alias("text"))
    return SN.inventory(_named(kept.unionByName(twice)).unionByName(pages), "path", "text")


SQL_FILES = """
decl AS (SELECT source || '/' || doc_id || '.txt' AS path, octet_length(encode(text)) AS byte_count, sha256(text) AS sha256 FROM documents),
kept AS (SELECT * REPLACE (CASE WHEN lang = 'fr' THEN upper(text) WHEN source = 'src3' THEN text || '!' ELSE text END AS text)
         FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels WHERE toxic = 1)),
act AS (SELECT source || '/' || doc_id || '.txt' AS path, octet_length(encode(text)) AS byte_count, sha256(text) AS sha256
        FROM (FROM kept UNION ALL FROM kept WHERE source = 'src5')
        UNION ALL SELECT url, octet_length(encode(html)), sha256(html) FROM pages)"""


@query("source_lock", f"WITH {SQL_FILES} SELECT path, CAST(byte_count AS BIGINT) AS byte_count, sha256, row_number() OVER (ORDER BY path) AS ord FROM decl")
def source_lock(spark, sf):
    return full_rank(declared(spark, sf), [], [F.asc("path")])


@query("source_checksums", f"WITH {SQL_FILES} SELECT sha256 || '  ' || path AS line FROM decl")
def source_checksums(spark, sf):
    return declared(spark, sf).select(SN.checksum_line().alias("line"))


@query("inventory_summary", f"WITH {SQL_FILES} SELECT count(*) AS file_count, CAST(sum(byte_count) AS BIGINT) AS byte_count, CAST(max(byte_count) AS BIGINT) AS largest FROM act")
def inventory_summary(spark, sf):
    return SN.summary(found(spark, sf))


@query("size_budgets", f"""
WITH {SQL_FILES}, s AS (SELECT count(*) AS n, sum(byte_count) AS t, max(byte_count) AS m FROM act)
SELECT 'members' AS budget, n AS found, CAST(100 AS BIGINT) AS allowed FROM s WHERE n > 100
UNION ALL SELECT 'total bytes', CAST(t AS BIGINT), 100000000000 FROM s WHERE t > 100000000000
UNION ALL SELECT 'member bytes', CAST(m AS BIGINT), 10000 FROM s WHERE m > 10000""")
def size_budgets(spark, sf):
    return SN.over_budget(found(spark, sf), 100, 100_000_000_000, 10_000)


@query("snapshot_verify", f"""
WITH {SQL_FILES},
d AS (SELECT path, count(*) AS n, min(byte_count) AS b, min(sha256) AS h FROM decl GROUP BY path),
a AS (SELECT path, count(*) AS n, min(byte_count) AS b, min(sha256) AS h FROM act GROUP BY path)
SELECT path, CASE WHEN contains(path, '//') THEN 'canonical' WHEN d.n > 1 OR a.n > 1 THEN 'duplicate' WHEN a.n IS NULL THEN 'missing'
   WHEN d.n IS NULL THEN 'undeclared' WHEN d.b <> a.b THEN 'size' WHEN d.h <> a.h THEN 'digest' ELSE 'ok' END AS status
FROM d FULL JOIN a USING (path)""")
def snapshot_verify(spark, sf):
    return SN.verify(declared(spark, sf), found(spark, sf))


@query("source_mutation", """
SELECT CAST(user_id AS VARCHAR) AS path, min(sha256(props)) AS first, max(sha256(props)) AS last, count(*) AS registrations
FROM events GROUP BY user_id HAVING min(sha256(props)) <> max(sha256(props))""")
def source_mutation(spark, sf):
    """Users as sources that registered differing properties."""
    rows = table(spark, sf, "events").select(F.col("user_id").cast("string").alias("path"), F.col("props").alias("content"))
    return SN.mutated(SN.inventory(rows))


@query("source_changed", f"""
WITH {SQL_FILES}
SELECT DISTINCT d.path, d.sha256, a.sha256 AS current FROM decl d LEFT JOIN act a USING (path) WHERE d.sha256 IS DISTINCT FROM a.sha256""")
def source_changed(spark, sf):
    return SN.changed_since(declared(spark, sf), found(spark, sf).distinct())


@query("quarantine", f"""
WITH {SQL_FILES}, q AS (SELECT path, sha256 FROM act) SELECT path, sha256, CAST(byte_count AS BIGINT) AS byte_count FROM decl WHERE (path, sha256) NOT IN (FROM q)""")
def quarantine(spark, sf):
    """Documents that are not quarantined; a quarantine of other content does not hold."""
    return SN.not_quarantined(declared(spark, sf), found(spark, sf)).select("path", "sha256", "byte_count")


@query("acquire_worklist", """
WITH landed AS (SELECT o_custkey AS key, bool_or(o_orderstatus <> 'P') AS valid FROM orders WHERE year(o_orderdate) = 1997 GROUP BY 1)
SELECT c_custkey AS key, CASE WHEN valid THEN 'use' WHEN NOT valid THEN 'refetch' WHEN c_acctbal < 0 THEN 'skip' ELSE 'fetch' END AS action,
       c_acctbal < 0 AND valid IS NOT NULL AS void_marker
FROM customer LEFT JOIN landed ON landed.key = c_custkey""")
def acquire_worklist(spark, sf):
    customers = table(spark, sf, "customer")
    landed = table(spark, sf, "orders").where("o_orderdate >= '1997-01-01' and o_orderdate < '1998-01-01'").select(
        F.col("o_custkey").alias("key"), (F.col("o_orderstatus") != "P").alias("valid")
    )
    negative = customers.where("c_acctbal < 0").select(F.col("c_custkey").alias("key"))
    return SN.worklist(customers.select(F.col("c_custkey").alias("key")), landed, negative)


SQL_PRINT = """
h AS (SELECT sha256(to_json({'doc_id': doc_id, 'lang': lang, 'text': text})) AS d FROM documents),
lanes AS (SELECT i, printf('%08x', CAST(sum(CAST('0x' || substr(d, 1 + 8 * i, 8) AS BIGINT)) % 4294967296 AS BIGINT)) AS t
          FROM h, range(8) r(i) GROUP BY i),
fp AS (SELECT (SELECT count(*) FROM h) AS rows, sha256((SELECT count(*) FROM h) || ':' || string_agg(t, ':' ORDER BY i)) AS fingerprint FROM lanes)"""


@query("content_fingerprint", f"WITH {SQL_PRINT} SELECT rows, fingerprint FROM fp")
def content_fingerprint(spark, sf):
    return VS.fingerprint(table(spark, sf, "documents"), ["text", "lang", "doc_id"])


@query("change_detection", """
WITH d AS (SELECT CAST(CAST(ts AS DATE) AS VARCHAR) AS day, sha256(count(DISTINCT user_id) || '/' || count(DISTINCT event_type)) AS fingerprint,
             count(*) AS n FROM events GROUP BY 1),
p AS (SELECT a.day, a.fingerprint, b.fingerprint AS prev, a.n,
        CASE WHEN a.n % 3 = 0 THEN replace(a.day, '-', '.') WHEN a.n % 3 = 1 THEN replace(a.day, '-', '.') || '.' || a.n
             WHEN b.day IS NOT NULL THEN replace(b.day, '-', '.') END AS prev_rev
      FROM d a LEFT JOIN d b ON CAST(b.day AS DATE) + 1 = CAST(a.day AS DATE))
SELECT day, CASE WHEN fingerprint = prev THEN NULL WHEN n % 3 = 0 THEN prev_rev || '.1'
                 WHEN n % 3 = 1 THEN replace(day, '-', '.') || '.' || (n + 1) ELSE replace(day, '-', '.') END AS revision FROM p""")
def change_detection(spark, sf):
    """Decision for each day of events, with the day before as the previous state."""
    days = table(spark, sf, "events").groupBy(F.to_date("ts").alias("d")).agg(
        F.count_distinct("user_id").alias("u"), F.count_distinct("event_type").alias("t"), F.count("*").alias("n")
    )
    states = staged(days.select(
        "d", F.col("d").cast("string").alias("day"), "n",
        F.sha2(F.concat_ws("/", "u", "t"), 256).alias("fingerprint"),
    ), "states")
    before = states.select(
        F.date_add("d", 1).alias("d"), F.col("fingerprint").alias("previous_fingerprint"), F.col("day").alias("day_before")
    )
    base = VS.date_to_revision("day")
    released = (
        F.when(F.col("n") % 3 == 0, base).when(F.col("n") % 3 == 1, F.concat_ws(".", base, F.col("n").cast("string")))
        .otherwise(VS.date_to_revision("day_before"))
    )
    rows = states.join(before, "d", "left").withColumn("previous_revision", released)
    return VS.decide_revision(rows).select("day", "revision")


SQL_LEDGER = """
led AS (SELECT strftime(ts, '%Y.%m.%d') || CASE WHEN user_id = 0 THEN '' ELSE '.' || user_id END AS revision FROM events),
k AS (SELECT revision[1:10] AS base, CAST(coalesce(nullif(revision[12:], ''), '0') AS INT) AS n FROM led)"""


def _ledger(spark, sf) -> DataFrame:
    suffix = F.when(F.col("user_id") == 0, "").otherwise(F.concat(F.lit("."), F.col("user_id").cast("string")))
    return table(spark, sf, "events").select(F.concat(F.date_format("ts", "yyyy.MM.dd"), suffix).alias("revision"))


@query("next_version", f"""
WITH {SQL_LEDGER},
days AS (SELECT DISTINCT CAST(CAST(ts AS DATE) AS VARCHAR) AS day FROM events UNION SELECT DISTINCT CAST(CAST(ts AS DATE) + 1 AS VARCHAR) FROM events),
m AS (SELECT base, max(n) AS last FROM k GROUP BY base)
SELECT day, replace(day, '-', '.') < (SELECT max(base) FROM m) AS late,
       CASE WHEN replace(day, '-', '.') < (SELECT max(base) FROM m) THEN NULL WHEN last IS NULL THEN replace(day, '-', '.')
            ELSE replace(day, '-', '.') || '.' || (last + 1) END AS revision
FROM days LEFT JOIN m ON m.base = replace(day, '-', '.')""")
def next_version(spark, sf):
    d = F.to_date("ts")
    days = table(spark, sf, "events").select(
        F.explode(F.array(d.cast("string"), F.date_add(d, 1).cast("string"))).alias("day")
    ).distinct()
    return VS.next_version(_ledger(spark, sf), days)


@query("version_monotonic", f"""
WITH {SQL_LEDGER}, top AS (SELECT max({{'b': base, 'n': n}}) AS t FROM k),
c AS (SELECT DISTINCT strftime(o_orderdate + INTERVAL 26 YEAR, '%Y.%m.%d') AS revision FROM orders UNION SELECT DISTINCT revision FROM led)
SELECT revision, {{'b': revision[1:10], 'n': CAST(coalesce(nullif(revision[12:], ''), '0') AS INT)}} > t AS fresh,
       t > {{'b': revision[1:10], 'n': CAST(coalesce(nullif(revision[12:], ''), '0') AS INT)}} AS newer_exposed FROM c, top""")
def version_monotonic(spark, sf):
    later = table(spark, sf, "orders").select(F.date_format(F.expr("o_orderdate + interval 26 years"), "yyyy.MM.dd").alias("revision"))
    ledger = _ledger(spark, sf)
    return VS.monotonic(later.unionByName(ledger).distinct(), ledger)


@query("gate_min_count", "SELECT count(*) AS found, CAST(1000000000 AS BIGINT) AS minimum FROM documents HAVING count(*) < 1000000000")
def gate_min_count(spark, sf):
    short = G.minimum_count(table(spark, sf, "documents"), 1_000_000_000)
    return short.withColumn("minimum", F.col("minimum").cast("bigint"))
