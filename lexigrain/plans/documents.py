"""Nested documents, strict locks, payload files and what failed gates lead to, over the given tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import text as T
from ..functions import variants as V
from ..operators import documents as DC
from ..operators import locks as LK
from ..operators import publish as PB
from ..operators import snapshot as SN
from ..operators import versions as VS
from ..session import work_path
from ..sources import files, payloads
from .base import query, table


@query("card_references", """
WITH r AS (SELECT DISTINCT 'media/' || (conv_id % 97 + turn) || '.svg' AS path FROM conversations WHERE role <> 'system'),
a AS (SELECT DISTINCT 'media/' || doc_id || '.svg' AS path FROM documents WHERE lang = 'en')
SELECT path FROM r WHERE path NOT IN (FROM a)""")
def card_references(spark, sf):
    """Images in glossaries as deep as a turn's number, against English documents as assets; other nodes with a path do not count."""
    turns = table(spark, sf, "conversations")
    path = F.concat(F.lit("media/"), (F.col("conv_id") % 97 + F.col("turn")).cast("string"), F.lit(".svg"))
    node = F.to_json(F.struct(F.when(F.col("role") == "system", "a").otherwise("img").alias("tag"), path.alias("path")))
    decoy = F.lit('{"tag":"img","path":7,"data":{"tag":["img"],"path":"x"}}')
    wrap = lambda inner, i: F.concat(F.lit('{"tag":"span","content":["'), i.cast("string"), F.lit('",'), inner, F.lit("]}"))
    nested = F.aggregate(F.sequence(F.lit(0), F.col("turn")), F.concat(F.lit("["), node, F.lit(","), decoy, F.lit("]")), wrap)
    docs = turns.select("conv_id", "turn", F.try_parse_json(F.concat(F.lit('{"type":"structured-content","content":'), nested, F.lit("}"))).alias("doc"))
    assets = table(spark, sf, "documents").where("lang = 'en'").select(F.concat(F.lit("media/"), F.col("doc_id").cast("string"), F.lit(".svg")).alias("path"))
    return DC.dangling(DC.asset_references(docs, "doc", "conv_id", "turn"), assets)


ROW = [("expression", "string"), ("reading", "string"), ("score", "integer"), ("glossary", "array"), ("stats", "object"), ("tags", "string")]


@query("gate_row_shapes", """
SELECT conv_id, turn, '' AS place, 'no array' AS fault FROM conversations WHERE turn % 7 = 6
UNION ALL SELECT conv_id, turn, '', '5 columns, not 6' FROM conversations WHERE turn % 7 = 5
UNION ALL SELECT conv_id, turn, '/0', 'expression is no string: bigint' FROM conversations WHERE turn % 7 < 5 AND role = 'system'
UNION ALL SELECT conv_id, turn, '/2', 'score is no integer: ' || CASE turn % 7 WHEN 3 THEN 'string' ELSE 'boolean' END FROM conversations WHERE turn % 7 IN (3, 4)
UNION ALL SELECT conv_id, turn, '/3', 'glossary is no array: string' FROM conversations WHERE turn % 7 < 5 AND contains(text, 'qu')
UNION ALL SELECT conv_id, turn, '/4', 'stats is no object: void' FROM conversations WHERE turn % 7 < 5 AND conv_id % 4 = 1""")
def gate_row_shapes(spark, sf):
    """Turns as JSON rows of six columns, some of them of another kind or number."""
    turns = table(spark, sf, "conversations")
    text = F.to_json(F.array("text"))
    columns = [
        F.when(F.col("role") == "system", F.col("conv_id").cast("string")).otherwise(F.lit('"x"')), F.lit('""'),
        F.when(F.col("turn") % 7 == 3, F.lit('"3"')).when(F.col("turn") % 7 == 4, F.lit("true")).otherwise(F.col("turn").cast("string")),
        F.when(F.contains("text", F.lit("qu")), F.lit('"qu"')).otherwise(text),
        F.when(F.col("conv_id") % 4 == 1, F.lit("null")).otherwise(F.lit('{"Grade":"1"}')), F.lit('""'),
    ]
    row = F.concat(F.lit("["), F.concat_ws(",", *columns), F.lit("]"))
    short = F.concat(F.lit("["), F.concat_ws(",", *columns[:5]), F.lit("]"))
    json = F.when(F.col("turn") % 7 == 6, text.substr(F.lit(2), F.length(text) - 2)).when(F.col("turn") % 7 == 5, short).otherwise(row)
    return DC.row_faults(turns.select("conv_id", "turn", F.try_parse_json(json).alias("row")), "row", ROW, "conv_id", "turn")


@query("snapshot_nested", """
WITH f AS (SELECT doc_id, doc_id // 25 AS k, doc_id || '.txt' AS path, text,
  CASE doc_id // 25 % 11 WHEN 9 THEN text || '!' WHEN 10 THEN replace(text, 'a', 'b') ELSE text END AS now FROM documents),
s AS (SELECT DISTINCT k, CASE k % 11 WHEN 1 THEN 'outer lock: unparsable' WHEN 2 THEN 'outer lock: schema' WHEN 3 THEN 'inner lock: members'
        WHEN 4 THEN 'outer lock: digest' WHEN 5 THEN 'outer lock: size' WHEN 6 THEN 'outer lock: unparsable' WHEN 7 THEN 'locks differ'
        WHEN 8 THEN 'outer lock: path' END AS status FROM f)
SELECT 'snapshot ' || k AS name, NULL AS path, status FROM s WHERE status IS NOT NULL
UNION ALL
SELECT 'snapshot ' || k, path, CASE WHEN k % 11 = 0 AND doc_id % 5 = 0 THEN 'missing' WHEN strlen(now) <> strlen(text) THEN 'size'
         WHEN now <> text THEN 'digest' ELSE 'ok' END FROM f WHERE k % 11 NOT BETWEEN 1 AND 8""")
def snapshot_nested(spark, sf):
    """Snapshots of 25 documents with a lock beside and one inside, each kind of fault in every eleventh."""
    docs = table(spark, sf, "documents")
    k = F.floor(F.col("doc_id") / 25).cast("bigint")
    case = k % 11
    name = F.concat(F.lit("snapshot "), k.cast("string"))
    path = F.concat(F.col("doc_id").cast("string"), F.lit(".txt"))
    record = F.struct(path.alias("path"), F.octet_length("text").cast("bigint").alias("byteCount"), F.sha2(F.col("text").cast("binary"), 256).alias("sha256"))
    locks = docs.groupBy(k.alias("k")).agg(F.sort_array(F.collect_list(record)).alias("files")).select(
        "k", F.to_json(F.struct(F.lit(1).alias("schemaVersion"), "files")).alias("lock"),
    )
    changes = {  # of the outer lock, of the inner one
        2: ('"schemaVersion":1', '"schemaVersion":2', None), 3: (None, '"byteCount":', '"size":'), 4: ('"sha256":"', '"sha256":"X', None),
        5: ('"byteCount":', '"byteCount":-', None), 6: ('"schemaVersion":1', '"schemaVersion":1,"schemaVersion":1', None),
        7: (None, '"byteCount":', '"byteCount":1'), 8: ('"path":"', '"path":"../', None),
    }
    which = F.col("k") % 11
    outer, inner = F.when(which == 1, F.left("lock", F.length("lock") - 1)), F.when(F.lit(False), F.lit(""))
    for n, (a, b, c) in changes.items():
        if a is not None:
            outer = outer.when(which == n, F.replace("lock", F.lit(a), F.lit(b)))
        else:
            inner = inner.when(which == n, F.replace("lock", F.lit(b), F.lit(c)))
    snapshots = locks.select(
        F.concat(F.lit("snapshot "), F.col("k").cast("string")).alias("name"), outer.otherwise(F.col("lock")).alias("outer"),
        inner.otherwise(F.col("lock")).alias("inner"),
    )
    now = F.when(case == 9, F.concat("text", F.lit("!"))).when(case == 10, F.replace("text", F.lit("a"), F.lit("b"))).otherwise(F.col("text"))
    kept = docs.where(~((case == 0) & (F.col("doc_id") % 5 == 0))).select(name.alias("name"), path.alias("path"), now.alias("content"))
    found = SN.inventory(kept.select(F.struct("name", "path").alias("path"), "content"))
    return LK.verify_nested(snapshots, found.select("path.name", "path.path", "byte_count", "sha256"))


@query("src_payload_files", """
WITH j AS (SELECT conv_id || '-' || turn AS key, turn, '{"character":"' || conv_id || '-' || turn || '","frequencyRank":' || turn || ',"role":"' || role || '"}' || chr(10) AS t
           FROM conversations)
SELECT key, key AS character, CAST(turn AS BIGINT) AS rank, CAST(strlen(t) AS BIGINT) AS byte_count, sha256(t) AS sha256 FROM j""")
def src_payload_files(spark, sf):
    """A file for each turn, named by the code points of its key; read back by the names of an inventory, digests taken on the way."""
    turns = table(spark, sf, "conversations").select(F.concat_ws("-", "conv_id", "turn").alias("key"), F.col("turn").alias("frequencyRank"), "role")
    path = work_path(spark, "payload-files")
    json = F.to_json(F.struct(F.col("key").alias("character"), "frequencyRank", "role"))
    named = turns.select(T.key_file_name("key", "json").alias("name"), json.alias("value"))
    files.write_per_name(named, path)
    inventory = named.select(F.concat(F.lit(f"{path}/name="), "name").alias("path"))
    docs = payloads.from_files(files.read_listed(spark, inventory, work_path(spark, "payloads-read"), at_once=2_000))
    return docs.select("key", V.string_field("v", "$.character").alias("character"), V.int_field("v", "$.frequencyRank").alias("rank"), "byte_count", "sha256")


def _lanes(of: str, by: str) -> str:
    """The lane digest of column ``d`` of a table, for each group."""
    return f"""SELECT {by}, sha256(any_value(n) || ':' || string_agg(printf('%08x', CAST(s % 4294967296 AS BIGINT)), ':' ORDER BY i)) AS fingerprint, any_value(n) AS rows
      FROM (SELECT {by}, i, count(*) AS n, sum(CAST('0x' || substr(d, 1 + 8 * i, 8) AS BIGINT)) AS s FROM {of}, range(8) r(i) GROUP BY {by}, i) GROUP BY {by}"""


SQL_TREE = f"""
d AS (SELECT 'documents' AS domain, lang AS part, sha256('documents:' || to_json({{'doc_id': doc_id, 'lang': lang, 'source': source, 'text': text}})) AS d FROM documents
      UNION ALL SELECT 'labels', CAST(doc_id % 8 AS VARCHAR), sha256('labels:' || to_json({{'doc_id': doc_id, 'quality': quality, 'toxic': toxic}})) FROM labels),
p AS MATERIALIZED ({_lanes('d', 'domain, part')}),
q AS (SELECT domain, sha256(to_json({{'fingerprint': fingerprint, 'part': part, 'rows': rows}})) AS d FROM p),
o AS ({_lanes('q', 'domain')})"""


@query("fingerprint_tree", f"""
WITH {SQL_TREE}
SELECT domain, part, rows, fingerprint FROM p
UNION ALL SELECT 'all', NULL, (SELECT CAST(sum(rows) AS BIGINT) FROM p), sha256(string_agg(domain || '=' || fingerprint, chr(10) ORDER BY domain)) FROM o""")
def fingerprint_tree(spark, sf):
    """Documents by language and labels by bucket, each part with its digest, and one over all."""
    docs = VS.part_prints(table(spark, sf, "documents"), "documents", F.col("lang"), ["doc_id", "lang", "source", "text"])
    labels = VS.part_prints(table(spark, sf, "labels"), "labels", F.col("doc_id") % 8, ["doc_id", "quality", "toxic"])
    parts = docs.unionByName(labels)
    return parts.unionByName(VS.combined(parts).select(F.lit("all").alias("domain"), F.lit(None).cast("string").alias("part"), "rows", "fingerprint"))


@query("gate_consequences", """
WITH d AS (SELECT strftime(ts, '%Y-%m-%d') AS dt, count(*) AS n, sha256(CAST(count(*) AS VARCHAR)) AS h FROM events GROUP BY 1),
limits AS (SELECT median(n) AS m FROM d)
SELECT 'file' AS kind, dt, NULL AS key FROM d, limits WHERE NOT (n < m AND n % 2 = 0)
UNION ALL SELECT DISTINCT 'mark', dt, user_id FROM (SELECT strftime(ts, '%Y-%m-%d') AS dt, user_id FROM events WHERE event_type = 'error') JOIN d USING (dt), limits WHERE n >= m""")
def gate_consequences(spark, sf):
    """Days with too few events are quarantined and lose their marks; those of an odd number come back with another digest."""
    events = table(spark, sf, "events").withColumn("dt", F.date_format("ts", "yyyy-MM-dd"))
    days = events.groupBy("dt").agg(F.count("*").alias("n")).withColumn("sha256", F.sha2(F.col("n").cast("string"), 256))
    least = days.agg(F.median("n")).first()[0]
    failed = days.where(F.col("n") < least)
    ledger = work_path(spark, "ledger")
    entry = lambda kind, path, digest: failed.select(
        F.lit(kind).alias("kind"), path.alias("path"), digest.alias("sha256"), "dt", F.lit("too few events").alias("reason"),
    )
    none = F.lit(None).cast("string")
    PB.append_entries(entry(PB.QUARANTINE, F.col("dt"), F.col("sha256")), ledger)
    PB.append_entries(entry(PB.VOID, none, none), ledger)
    entries = PB.read_ledger(spark, ledger)
    digest = F.when(F.col("n") % 2 == 1, F.sha2("sha256", 256)).otherwise(F.col("sha256"))
    held = PB.usable(days.select(F.col("dt").alias("path"), digest.alias("sha256")), entries)
    marks = events.where("event_type = 'error'").select(F.col("user_id").alias("key"), "dt", F.col("ts").alias("at"))
    live = PB.live_marks(marks, entries).select(F.lit("mark").alias("kind"), "dt", "key").distinct()
    return held.select(F.lit("file").alias("kind"), F.col("path").alias("dt"), F.lit(None).cast("bigint").alias("key")).unionByName(live)
