"""Nested documents, shapes of JSON rows, strict locks, and days that are judged before they land."""

import json

import pytest
from pyspark.sql import functions as F

from lexigrain.operators import documents as DC
from lexigrain.operators import locks as LK
from lexigrain.session import work_path
from lexigrain.streaming import landing as L


def parsed(spark, *texts):
    return spark.createDataFrame(list(enumerate(texts)), "i int, t string").select("i", F.try_parse_json("t").alias("doc"))


def test_references_are_found_at_any_depth(spark):
    deep = {"tag": "img", "path": "deep.svg"}
    for _ in range(6):
        deep = [{"tag": "div", "content": [deep, "text", None, 5]}]
    docs = [deep, {"tag": "img", "path": "a.svg", "more": {"a/b~c": {"tag": "img", "path": "b.svg"}}}, {"tag": "img", "path": 7}, {"tag": "a", "path": "x"}, 5, [], {}]
    df = parsed(spark, *map(json.dumps, docs), "{broken", None)
    got = sorted((r.i, r.place, r.path) for r in DC.asset_references(df, "doc", "i").collect())
    assert got == [(0, "/0/content/0" * 6, "deep.svg"), (1, "", "a.svg"), (1, "/more/a~1b~0c", "b.svg")]
    assets = spark.createDataFrame([("a.svg",), ("deep.svg",), ("unused.svg",)], "path string")
    assert [r.path for r in DC.dangling(DC.asset_references(df, "doc"), assets).collect()] == ["b.svg"]
    assert DC.asset_references(df.where("false"), "doc", "i").collect() == []


def test_rows_have_their_shape(spark):
    rows = parsed(spark, '["a",1,[]]', '["a",true,{}]', '["a",1]', '{"a":1}', "[null,2.5,[1]]", None)
    faults = DC.row_faults(rows, "doc", [("key", "string"), ("score", "integer"), ("glossary", "any")], "i")
    assert sorted(map(tuple, faults.collect())) == [
        (1, "/1", "score is no integer: boolean"), (2, "", "2 columns, not 3"), (3, "", "no array"), (4, "/0", "key is no string: void"),
        (4, "/1", "score is no integer: decimal"), (5, "", "no array"),
    ]
    shape = DC.shapes(parsed(spark, '["a",1]', '["b",2]'), "doc").first()
    assert shape.rows == 2 and shape["shape"].startswith("ARRAY<")


GOOD = {"schemaVersion": 1, "files": [{"path": p, "byteCount": n, "sha256": d * 64} for p, n, d in (("b/x.csv", 5, "b"), ("a.csv", 0, "a"))]}


def changed(**other):
    return json.dumps(GOOD | {"files": [GOOD["files"][0] | other, GOOD["files"][1]]})


@pytest.mark.parametrize("text,fault", [
    (json.dumps(GOOD), None), (json.dumps(GOOD)[:-1], "unparsable"), (None, "unparsable"), (json.dumps(GOOD).replace('{"sch', '{"schemaVersion":1,"sch'), "unparsable"),
    (json.dumps(GOOD | {"schemaVersion": 2}), "schema"), (json.dumps(GOOD | {"schemaVersion": True}), "schema"), ("[]", "schema"),
    (json.dumps(GOOD | {"files": {}}), "inventory"), (json.dumps({"schemaVersion": 1}), "inventory"), (changed(more=1), "members"),
    (json.dumps(GOOD | {"files": [5]}), "members"), (changed(path="../x"), "path"), (changed(path="SOURCE-LOCK.json"), "path"), (changed(path=7), "path"),
    (changed(byteCount=-1), "size"), (changed(byteCount=True), "size"), (changed(byteCount="5"), "size"), (changed(sha256="B" * 64), "digest"),
    (changed(sha256="b" * 63), "digest"), (changed(path="a.csv"), "duplicate"), (changed(byteCount=99), "total"),
])
def test_a_lock_is_read_strictly(spark, text, fault):
    row = LK.strict(spark.createDataFrame([(text,)], "lock string"), max_total=50).first()
    assert row.fault == fault and (row.files is None) == (fault is not None)
    if not fault:
        assert [f.path for f in row.files] == ["a.csv", "b/x.csv"]


def test_locks_and_files_are_compared_three_ways(spark):
    good, other = json.dumps(GOOD), changed(byteCount=6)
    snapshots = [("ok", good, json.dumps(GOOD | {"files": GOOD["files"][::-1]})), ("differ", good, other), ("inner", good, None), ("gone", good, good), ("none", '{"schemaVersion":1,"files":[]}', '{"schemaVersion":1,"files":[]}')]
    files = [(s, f["path"], f["byteCount"], f["sha256"]) for s in ("ok", "differ", "inner") for f in GOOD["files"]]
    files += [("ok", "extra.csv", 1, "c" * 64), ("gone", "a.csv", 0, "f" * 64), ("none", "x", 1, "d" * 64), ("none", "x", 1, "d" * 64), ("none", "../x", 1, "d" * 64), ("unknown", "y", 1, "e" * 64)]
    got = LK.verify_nested(spark.createDataFrame(snapshots, "name string, outer string, inner string"), spark.createDataFrame(files, "name string, path string, byte_count long, sha256 string"))
    assert sorted(map(tuple, got.collect()), key=repr) == sorted([
        ("ok", "a.csv", "ok"), ("ok", "b/x.csv", "ok"), ("ok", "extra.csv", "undeclared"), ("differ", None, "locks differ"), ("inner", None, "inner lock: unparsable"),
        ("gone", "a.csv", "digest"), ("gone", "b/x.csv", "missing"), ("none", "x", "duplicate"), ("none", "../x", "canonical"), ("unknown", "y", "undeclared"),
    ], key=repr)


def test_a_day_lands_only_when_its_batch_is_good(spark, tmp_path):
    kind = "dt string, surface string, rank long"
    arrivals, target, checkpoint = str(tmp_path / "in"), work_path(spark, "landed"), work_path(spark, "state")
    judge = lambda rows: rows.where("rank <= 0")

    def land(*rows, judge=judge):
        df = spark.createDataFrame(list(rows), kind)
        df.coalesce(1).write.mode("append").parquet(arrivals)
        L.land_checked(L.file_stream(spark, df.schema, arrivals), target, checkpoint, judge)

    def now():
        return sorted(map(tuple, L.accepted_days(spark, target, spark.createDataFrame([], kind).schema).collect()))

    land(("2026-08-15", "a", 1), ("2026-08-16", "b", 0))
    assert now() == [("2026-08-15", "a", 1)]
    land(("2026-08-15", "c", -1), ("2026-08-16", "d", 4))
    assert now() == [("2026-08-15", "a", 1), ("2026-08-16", "d", 4)]

    def lost(rows):
        raise RuntimeError("lost")

    with pytest.raises(Exception, match="lost"):
        land(("2026-08-15", "e", 5), judge=lost)
    assert now() == [("2026-08-15", "a", 1), ("2026-08-16", "d", 4)]
    L.land_checked(L.file_stream(spark, spark.createDataFrame([], kind).schema, arrivals), target, checkpoint, judge)
    assert now() == [("2026-08-15", "e", 5), ("2026-08-16", "d", 4)]


def test_state_of_a_distinct_stream_is_dropped_past_its_delay(spark, tmp_path):
    kind = "k int, at timestamp"
    arrivals, target, checkpoint = str(tmp_path / "in"), work_path(spark, "distinct"), work_path(spark, "distinct-state")
    held = []

    def run(*rows):
        df = spark.createDataFrame([(k, None if t is None else f"2026-08-{t:02} 00:00:00") for k, t in rows], "k int, at string").select("k", F.to_timestamp("at").alias("at"))
        df.coalesce(1).write.mode("append").parquet(arrivals)
        stream = L.distinct_stream(L.file_stream(spark, df.schema, arrivals), ["k"], "at", "2 days")
        query = stream.writeStream.format("parquet").option("path", target).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
        query.awaitTermination()
        held.append(query.lastProgress["stateOperators"][0]["numRowsTotal"])

    run((1, 1), (1, 1), (2, 1))
    run((1, 2), (3, 20))
    run((1, 2), (4, 20), (3, 20))
    got = sorted(r.k for r in spark.read.parquet(target).collect())
    assert got == [1, 2, 3, 4]
    # Keys 1 and 2 are past the delay once 20 has been seen: their state is gone.
    assert held[-1] == 2
