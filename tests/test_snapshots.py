import pytest
from pyspark.sql import functions as F

from lexigrain import session
from lexigrain.functions import markup as M
from lexigrain.operators import banks as B
from lexigrain.operators import gates as G
from lexigrain.operators import snapshot as SN
from lexigrain.operators import versions as VS
from lexigrain.session import work_path
from lexigrain.sources import files, sinks
from lexigrain.streaming import landing as L

HEALTHY = {
    "rows": 449_000, "source_rows": 449_397, "exact_duplicate_rows": 97, "conflicting_pairs": 140, "excluded_conflicting_rows": 300,
    "relevant_rows": 293_000, "aligned_rows": 259_000, "ambiguous_rows": 34_000, "reading_assignments": 500_000,
    "relevant_weight": 1000.0, "aligned_weight": 940.0, "weight_coverage": 0.94, "keys_with_scores": 3_846, "groups_with_scores": 4_200,
}
BROKEN = [
    {"rows": 399_999}, {"relevant_rows": 249_999}, {"aligned_rows": 179_999}, {"keys_with_scores": 3_499}, {"weight_coverage": 0.84},
    {"source_rows": 449_396}, {"exact_duplicate_rows": -1}, {"conflicting_pairs": 151}, {"conflicting_pairs": 0}, {"ambiguous_rows": 33_999},
    {"reading_assignments": 258_999}, {"groups_with_scores": 3_000}, {"groups_with_scores": 500_001}, {"weight_coverage": 0.95},
    {"weight_coverage": float("nan")}, {"weight_coverage": float("inf")}, {"relevant_weight": 300_000.0}, {"aligned_weight": 1000.1},
    {"aligned_weight": 0.0}, {"relevant_weight": float("nan")}, {"reading_assignments": 40_000_000}, {"rows": None}, {"source_rows": 600_001},
]


def test_coverage_gate(spark):
    base = [("healthy", HEALTHY)] + [(str(i), HEALTHY | change) for i, change in enumerate(BROKEN)]
    names = list(HEALTHY)
    kinds = ", ".join(f"{n} {'double' if isinstance(HEALTHY[n], float) else 'bigint'}" for n in names)
    df = spark.createDataFrame([(k, *[v[n] for n in names]) for k, v in base], f"id string, {kinds}")
    for k, _ in base:
        failed = G.coverage_checks(df.where(F.col("id") == k), max_rows=600_000, max_keys_per_row=128).where("not ok").count()
        assert (failed == 0) == (k == "healthy"), k


def test_paths(spark):
    good = ["cache/x", "a", "a/b.c/d", "..a/b", ".hidden"]
    bad = ["", "/a", "a/", "a//b", "./a", "a/./b", "a/../b", "..", "a\\b", None]
    df = spark.createDataFrame([(p,) for p in good + bad], "p string")
    assert [r.ok for r in df.select(G.canonical_path("p").alias("ok")).collect()] == [True] * len(good) + [False] * len(bad)


def test_verification(spark):
    def table(*names):
        return spark.createDataFrame([(n, c) for n, c in names], "path string, content string")

    lock = SN.inventory(table(("a", "1"), ("b", "2"), ("c", "3"), ("d", "4"), ("e", "5"), ("e", "5"), ("x/./y", "6")))
    found = SN.inventory(table(("a", "1"), ("b", "9"), ("c", "33"), ("z", "0"), ("e", "5"), ("x/./y", "6")))
    status = {r.path: r.status for r in SN.verify(lock, found).collect()}
    assert status == {"a": "ok", "b": "digest", "c": "size", "d": "missing", "e": "duplicate", "z": "undeclared", "x/./y": "canonical"}
    docs = spark.createDataFrame([('{"files":[{"path":"a","byteCount":1,"sha256":"s"},{"path":"b","byteCount":true,"sha256":"t"}]}',), ('{"files":[],"files":[{"path":"q"}]}',)], "j string")
    table_ = SN.lock_table(docs.select(F.try_parse_json("j").alias("lock")))
    assert sorted(tuple(r) for r in table_.collect()) == [("a", 1, "s"), ("b", None, "t")]


def test_mutations_and_quarantine(spark, rows):
    seen = spark.createDataFrame([("a", "1"), ("a", "1"), ("b", "1"), ("b", "2")], "path string, sha256 string")
    assert rows(SN.mutated(seen), "path", "registrations") == [("b", 2)]
    now = spark.createDataFrame([("a", "3")], "path string, sha256 string")
    assert rows(SN.changed_since(seen, now), "path", "sha256") == [("a", "1"), ("b", "1"), ("b", "2")]
    held = spark.createDataFrame([("a", "1"), ("b", "9")], "path string, sha256 string")
    assert rows(SN.not_quarantined(seen.distinct(), held)) == [("b", "1"), ("b", "2")]


def test_worklist(spark, rows):
    wanted = spark.createDataFrame([(k,) for k in "abcde"], "key string")
    landed = spark.createDataFrame([("a", True), ("b", False), ("c", True)], "key string, valid boolean")
    negative = spark.createDataFrame([("c",), ("d",), ("d",)], "key string")
    assert rows(SN.worklist(wanted, landed, negative)) == [
        ("a", "use", False), ("b", "refetch", False), ("c", "use", True), ("d", "skip", False), ("e", "fetch", False)
    ]


def test_policy_shapes_and_counts(spark, rows):
    found = spark.createDataFrame([("a",), ("bad",), ("m/0a.svg",), ("n/x.txt",)], "path string")
    policy = spark.createDataFrame([("a", "required"), ("b", "required"), ("bad", "forbidden"), ("c", "forbidden")], "path string, rule string")
    assert rows(G.inventory_policy(found, policy, r"\Am/[0-9a-f]+\.svg\z")) == [("b", "missing"), ("bad", "forbidden"), ("n/x.txt", "unexpected folder")]
    assert G.licence_missing(found, r"\Am/", "LICENCE").count() == 1
    assert G.licence_missing(found, r"\Aq/", "LICENCE").count() == 0
    assert G.minimum_count(found, 4).count() == 0 and G.minimum_count(found, 5).count() == 1
    meta = spark.createDataFrame([("a", "freq", 1), ("", "freq", 1), ("b", "x", 1), ("c", "ipa", 0)], "term string, type string, value bigint")
    assert rows(G.meta_shape(meta), "fault") == [("empty term",), ("unknown type",), ("value is not positive",)]
    terms = spark.createDataFrame([("場", 0x5834, 0, "g"), ("場", 0x5834, 0, "g"), ("ab", 97, 0, "g"), ("c", 98, 0, "g"), ("d", 100, 0, None)], "expression string, sequence bigint, score bigint, glossary string")
    assert rows(G.term_shape(terms), "fault") == [("key is not one character",), ("missing column",), ("more than one row",), ("sequence is not the code point",)]
    docs = spark.createDataFrame([('{"a":1}',)], "j string").select(F.try_parse_json("j").alias("doc"))
    assert rows(G.missing_fields(docs, "doc", ["a", "b"])) == [("b",)]
    sized = spark.createDataFrame([("a", 5), ("b", 6)], "path string, byte_count bigint")
    assert rows(SN.over_budget(sized, 1, 10, 6), "budget") == [("members",), ("total bytes",)]


def test_fingerprint_ignores_order_and_partitions(spark):
    data = [(i, f"t{i % 5}") for i in range(200)]
    df = spark.createDataFrame(data, "id int, t string")
    prints = {VS.fingerprint(d, ["id", "t"]).first().fingerprint for d in (df, df.repartition(7), df.orderBy(F.desc("id")))}
    assert len(prints) == 1
    for other in (data[1:], data + data[:1], [(0, "x")] + data[1:]):
        assert VS.fingerprint(spark.createDataFrame(other, "id int, t string"), ["id", "t"]).first().fingerprint not in prints


def test_publish_decision(spark):
    data = [
        ("abc", "2026-08-16", None, None, "2026.08.16"), ("abc", "2026-08-16", "abc", "2026.08.16", None),
        ("xyz", "2026-08-16", "abc", "2026.08.16", "2026.08.16.1"), ("xyz", "2026-08-16", "abc", "2026.08.16.4", "2026.08.16.5"),
        ("xyz", "2026-08-17", "abc", "2026.08.16", "2026.08.17"), ("xyz", "2026-08-17", None, "2026.08.17", "2026.08.17.1"),
    ]
    df = spark.createDataFrame(data, "fingerprint string, day string, previous_fingerprint string, previous_revision string, want string")
    assert all(r.revision == r.want for r in VS.decide_revision(df).collect())


def test_next_version(spark, rows):
    ledger = spark.createDataFrame([("2026.08.19",), ("2026.08.19.2",), ("2026.08.19.7",), ("2026.08.18.99",), ("v1",)], "revision string")
    days = spark.createDataFrame([("2026-08-18",), ("2026-08-19",), ("2026-08-20",)], "day string")
    assert rows(VS.next_version(ledger, days)) == [("2026-08-18", None, True), ("2026-08-19", "2026.08.19.8", False), ("2026-08-20", "2026.08.20", False)]
    some = spark.createDataFrame([("2026.08.19.7",), ("2026.08.19.10",), ("2026.08.19.6",)], "revision string")
    assert rows(VS.monotonic(some, ledger)) == [("2026.08.19.10", True, False), ("2026.08.19.6", False, True), ("2026.08.19.7", False, False)]
    none = ledger.where("false")
    assert rows(VS.next_version(none, days), "revision") == [("2026.08.18",), ("2026.08.19",), ("2026.08.20",)]


def test_sinks(spark):
    df = spark.createDataFrame([("b", 1, None), ("a", 2, "é")], "key string, n int, t string")
    path = work_path(spark, "json-test")
    sinks.write_canonical_json(df, path)
    assert [r.value for r in spark.read.text(path).orderBy("value").collect()] == ['{"key":"a","n":2,"t":"é"}', '{"key":"b","n":1,"t":null}']
    assert files.digests(spark, path).where("byte_count > 0").count() == files.sizes(spark, path).where("byte_count > 0").count()
    target = work_path(spark, "dated")
    days = spark.createDataFrame([(1, "2026-01-01"), (2, "2026-01-02")], "n int, dt string")
    sinks.land_dated(days, target)
    sinks.land_dated(spark.createDataFrame([(3, "2026-01-02")], "n int, dt string"), target)
    assert sorted(r.n for r in spark.read.parquet(target).collect()) == [1, 3]
    with pytest.raises(Exception):
        sinks.write_canonical_json(df, path)


def test_landing_takes_only_what_is_new(spark):
    source, target, checkpoint = (work_path(spark, n) for n in ("in", "out", "state"))
    schema = spark.range(1).selectExpr("id", "'2026-01-01' dt").schema

    def run():
        return L.land(L.file_stream(spark, schema, source), target, checkpoint)

    spark.range(5).selectExpr("id", "'2026-01-01' dt").write.parquet(source)
    assert (run(), run()) == (5, 0)
    spark.range(3).selectExpr("id + 5 id", "'2026-01-02' dt").write.mode("append").parquet(source)
    assert (run(), run()) == (3, 0)
    assert spark.read.parquet(target).count() == 8


def test_conflicts_span_batches(spark, rows):
    source, target, checkpoint = (work_path(spark, n) for n in ("pairs-in", "pairs-out", "pairs-state"))
    schema = "surface string, reading string, rank bigint"

    def land(data):
        spark.createDataFrame(data, schema).write.mode("append").parquet(source)
        stream = L.file_stream(spark, spark.createDataFrame([], schema).schema, source)
        L.append_batches(stream, target, checkpoint, L.pair_ranges)
        return rows(L.conflict_free_pairs(spark.read.parquet(target)))

    assert land([("a", "x", 1), ("b", "y", 2)]) == [("a", "x", 1), ("b", "y", 2)]
    assert land([("a", "x", 1), ("b", "y", 3)]) == [("a", "x", 1)]


def test_negative_marks(spark, rows):
    marks = spark.createDataFrame([("a", "d1", 1, "absent"), ("a", "d1", 2, "present"), ("b", "d1", 1, "absent"), ("b", "d2", 1, "present")], "key string, dt string, ts int, status string")
    assert rows(L.suppressed(L.latest_marks(marks))) == [("b", "d1")]


def test_shape_gate_reports_a_missing_sequence(spark, rows):
    terms = spark.createDataFrame([("場", 0x5834, 0, "g"), ("所", None, 0, "g"), ("空", 1, 0, "g")], "expression string, sequence bigint, score bigint, glossary string")
    assert rows(G.term_shape(terms)) == [("所", "sequence is not the code point"), ("空", "sequence is not the code point")]


def test_manifest_takes_facts_of_any_type(spark):
    one = spark.createDataFrame([(3, "ab12", None)], "n bigint, digest string, licence string")
    two = spark.createDataFrame([(("x", 1.5),)], "source struct<name:string,share:double>")
    assert B.manifest(one, two).first().manifest == '{"digest":"ab12","licence":null,"n":3,"source":{"name":"x","share":1.5}}'


def test_versions_past_an_int_and_with_zero_suffixes(spark, rows):
    ledger = spark.createDataFrame([("2026.08.19.4000000000",), ("2026.08.18.0",), ("2026.08.18.01",)], "revision string")
    days = spark.createDataFrame([("2026-08-19",)], "day string")
    assert rows(VS.next_version(ledger, days), "revision") == [("2026.08.19.4000000001",)]
    some = spark.createDataFrame([("2026.08.19.3",), ("2026.08.19." + "9" * 30,)], "revision string")
    assert rows(VS.monotonic(some, ledger), "fresh", "newer_exposed") == [(False, False), (False, True)]


def test_markup_without_a_path_has_no_features(spark):
    df = spark.createDataFrame([('<g element="a"></g>',)], "svg string")
    assert df.select(M.components("svg", F.lit("k"), element='element="([^"]*)"', path="<path").alias("c")).first().c is None


def test_an_unknown_master_needs_a_shared_folder():
    class Session:
        class conf:  # noqa: N801
            @staticmethod
            def get(name, default):
                return {"spark.master": Session.master}.get(name, default)

    for master in ("", "yarn", "local-cluster[2,1,1024]", "spark://h:7077"):
        Session.master = master
        with pytest.raises(RuntimeError):
            session.shared_dir(Session)


def test_a_job_scope_leaves_nothing_behind(spark):
    with session.job_scope(spark):
        path = session.work_path(spark, "scoped")
        spark.range(3).write.parquet(path)
        assert spark.read.parquet(path).count() == 3
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        spark.read.parquet(path)


def test_landing_counts_every_batch(spark):
    source, target, checkpoint = (work_path(spark, n) for n in ("many-in", "many-out", "many-state"))
    spark.range(120).selectExpr("id", "'2026-01-01' dt").repartition(120).write.parquet(source)
    stream = L.file_stream(spark, spark.range(1).selectExpr("id", "'x' dt").schema, source, max_files=1)
    assert L.land(stream, target, checkpoint) == 120 and spark.read.parquet(target).count() == 120
