"""The build job on a small catalogue: what it writes, and that a failed gate leaves nothing."""

import json
import os

import pytest
from test_records import PLACE, table, word

from lexigrain.operators import build as BU
from lexigrain.operators import gates as G
from lexigrain.operators import publish as PB
from lexigrain.operators import versions as VS
from lexigrain.session import work_path
from lexigrain.sources import files, payloads, sinks

LIFE = {"character": "生", "meanings": ["life"], "onReadings": ["セイ"], "kunReadings": ["い.きる"], "frequencyRank": 3,
        "wordsByReading": [{"reading": "せい", "totalWords": 9, "words": [word(11, 5)]}]}
SVG = '<svg xmlns:kvg="x"><g kvg:element="{0}" kvg:phon="寺"><path d="M1,1c1,1 2,2 3,3"/></g></svg>'


def sources(spark, docs=(PLACE, LIFE), ranks=None):
    ranks = ranks or [("場", "ば", "100"), ("生", "せい", "400"), ("生場", "せいば", "900"), ("x", "y", "5"), ("x", "y", "5")]
    empty = "cast(array() as array<string>)"
    fallback = spark.sql(
        f"select '唖' key, array('mute') meanings, array('ア') `on`, {empty} kun, {empty} nanori, 10L stroke_count, null grade, null jlpt"
    )
    markup = [(k, SVG.format(k)) for k in "場生"] + [("無", "<svg></svg>")]
    return BU.Sources(
        table(spark, *docs), spark.createDataFrame(ranks, "Word string, Form string, Rank string"),
        fallback.selectExpr("* except (grade, jlpt)", "cast(null as bigint) grade", "cast(null as bigint) jlpt"),
        spark.createDataFrame(markup, "key string, svg string"),
    )


def counts(df):
    return {r["stage"]: r["rows"] for r in df.collect()}


def test_a_build_writes_once_and_only_when_something_changed(spark):
    target = work_path(spark, "build")
    first = counts(BU.build(spark, sources(spark), target, "2026-08-16"))
    assert first == {"payloads": 2, "records": 2, "merged": 3, "ranked": 4, "aligned": 3, "scored": 2, "markup": 2, "families": 2,
                     "terms": 3, "keys": 3, "meta": 2, "assets": 2, "written": 5}
    assert PB.published(spark, target, "terms").count() == 3
    manifest = spark.read.text(f"{target}/2026.08.16/manifest").first().value
    assert all(f'"{k}":{n}' in manifest for k, n in {"total": 3, "primary": 2, "fallback": 1, "strokes": 2, "families": 1, "assets": 2}.items())
    again = counts(BU.build(spark, sources(spark), target, "2026-08-17"))
    assert again["written"] == 0
    changed = LIFE | {"meanings": ["birth"]}
    assert counts(BU.build(spark, sources(spark, (PLACE, changed)), target, "2026-08-16"))["written"] == 5
    assert PB.previous_state(spark, target).first().revision == "2026.08.16.1"
    with open(f"{target}/current.json", "w") as pointer:
        pointer.write("{broken")
    os.unlink(f"{target}/.current.json.crc")
    assert tuple(PB.previous_state(spark, target).first()) == (None, None, None)
    with pytest.raises(FileNotFoundError):
        PB.published(spark, target, "terms")


@pytest.mark.parametrize("fault", ["identity", "rank", "floor", "strokes", "quality"])
def test_a_failed_gate_leaves_no_output(spark, fault):
    target = work_path(spark, "closed")
    given, limits = sources(spark), BU.Limits()
    if fault == "identity":
        wrong = table(spark, LIFE | {"character": "活"}).selectExpr("'生' key", "v")
        given = BU.Sources(wrong, given.ranks, given.fallback, given.markup)
    elif fault == "rank":
        given = sources(spark, ranks=[("場", "ば", "01")])
    elif fault == "floor":
        limits = BU.Limits(floors=G.FLOORS)
    elif fault == "strokes":
        limits = BU.Limits(min_strokes=3)
    else:
        given, limits = sources(spark, (PLACE, LIFE | {"meanings": []})), BU.Limits(top_rank=1000)
    with pytest.raises(ValueError):
        BU.build(spark, given, target, "2026-08-16", limits)
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        spark.read.text(target)


def test_a_card_has_its_place_in_a_family_that_is_a_bank(spark):
    given, target = sources(spark), work_path(spark, "family")
    keys = "場生持時詩侍"
    docs = [PLACE, LIFE] + [LIFE | {"character": k, "frequencyRank": 10 + i} for i, k in enumerate(keys[2:])]
    markup = spark.createDataFrame([(k, SVG.format(k)) for k in keys], "key string, svg string")
    BU.build(spark, BU.Sources(table(spark, *docs), given.ranks, given.fallback, markup), target, "2026-08-16")
    members = PB.published(spark, target, "families").orderBy("ord").collect()
    ranked = sorted(docs, key=lambda d: d["frequencyRank"])
    assert [(m.component, m.ord, m.member, m.size) for m in members] == [("寺", i + 1, d["character"], 6) for i, d in enumerate(ranked)]
    cards = {r["expression"]: json.loads(r["glossary"]) for r in PB.published(spark, target, "terms").collect() if r["expression"] in keys}
    assert {k: c["family"] for k, c in cards.items()} == {m.member: {"component": "寺", "ord": m.ord, "size": 6} for m in members}


class Stopped(Exception):
    pass


def test_a_run_that_was_lost_at_any_write_publishes_nothing_and_the_next_one_all(spark, monkeypatch):
    target = work_path(spark, "lost")
    BU.build(spark, sources(spark), target, "2026-08-15")
    before = sorted(map(repr, PB.published(spark, target, "terms").collect()))
    changed = sources(spark, (PLACE, LIFE | {"meanings": ["birth"]}))

    def lost_after(n, f):
        writes = []

        def run(*args):
            writes.append(f(*args))
            if len(writes) == n:
                raise Stopped
        return run

    def lost(*args):
        raise Stopped

    stops = [(sinks, "write_bank", lost_after(1, sinks.write_bank)), (sinks, "write_bank", lost_after(6, sinks.write_bank)), (PB, "_renamed", lost)]
    for module, name, stop in stops:
        with monkeypatch.context() as m:
            m.setattr(module, name, stop)
            with pytest.raises(Stopped):
                BU.build(spark, changed, target, "2026-08-15")
        assert PB.previous_state(spark, target).first().revision == "2026.08.15"
        assert sorted(map(repr, PB.published(spark, target, "terms").collect())) == before
    assert counts(BU.build(spark, changed, target, "2026-08-15"))["written"] == 5
    assert PB.previous_state(spark, target).first().revision == "2026.08.15.1"
    clean = work_path(spark, "clean")
    BU.build(spark, changed, clean, "2026-08-15")
    for bank in ("terms", "keys", "meta", "families", "assets", "prints"):
        assert sorted(map(repr, PB.published(spark, target, bank).collect())) == sorted(map(repr, PB.published(spark, clean, bank).collect()))


def test_each_thing_that_ships_changes_the_fingerprint(spark):
    terms = spark.sql("select 'a' expression, map('x', 1, 'y', 2) stats union all select 'b', map('x', 1)")
    meta = spark.sql("select 'a' term, 5L value union all select 'b', 6L")
    assets = spark.sql("select 'a' key, 'aa' sha256")
    facts = spark.sql("select 'licence' name, 'CC0' value")
    given = {"terms": (terms, "expression"), "meta": (meta, "term"), "assets": (assets, "key")}
    printed = lambda facts=facts, **other: VS.combined(BU.content_prints(given | other, facts)).first().fingerprint
    prints = [
        printed(), printed(terms=(terms.where("expression = 'a'"), "expression")), printed(meta=(meta.replace(6, 7), "term")),
        printed(assets=(assets.replace("aa", "ab"), "key")), printed(facts.replace("CC0", "CC-BY")), printed(None),
        printed(assets=(assets.limit(0), "key")), printed(assets=(meta, "term"), meta=(assets, "key")),
    ]
    assert len(set(prints)) == len(prints)
    assert printed(terms=(terms.repartition(3).orderBy("expression"), "expression")) == prints[0]
    # Only the parts that changed are read again.
    known = BU.content_prints(given, facts)
    again = known.where("domain = 'meta'")
    assert VS.combined(VS.refreshed(known, again, again)).first().fingerprint == prints[0]
    assert VS.combined(VS.refreshed(known, again.where("false"), again)).first().fingerprint != prints[0]
    assert VS.combined(known.where("false")).first().rows == 0


def test_a_source_that_changes_while_it_is_read_stops_the_build(spark, tmp_path):
    docs = {"場": PLACE, "生": LIFE}
    for key, doc in docs.items():
        (tmp_path / f"{ord(key):x}.json").write_text(json.dumps(doc))
    names = spark.createDataFrame([(f"file:{tmp_path}/{ord(k):x}.json",) for k in docs], "path string")
    held = payloads.from_files(files.read_listed(spark, names, work_path(spark, "read"), at_once=1))
    assert {r.key for r in held.collect()} == set(docs)
    given, target = sources(spark), work_path(spark, "mutated")

    def now(consumed):
        return files.read_listed(spark, consumed, work_path(spark, "now"))

    def changing(consumed):
        (tmp_path / f"{ord('生'):x}.json").write_text("{}")
        return now(consumed)

    read = BU.Sources(held, given.ranks, given.fallback, given.markup, current=changing)
    with pytest.raises(G.GateError, match="changed"):
        BU.build(spark, read, target, "2026-08-15")
    assert PB.previous_state(spark, target).first().revision is None
    (tmp_path / f"{ord('生'):x}.json").write_text(json.dumps(LIFE))
    assert counts(BU.build(spark, BU.Sources(held, given.ranks, given.fallback, given.markup, current=now), target, "2026-08-15"))["written"] == 5


def test_a_lot_that_was_read_is_not_read_again(spark, tmp_path):
    for i in range(5):
        (tmp_path / f"{i}.json").write_text(str(i))
    names = spark.createDataFrame([(f"file:{tmp_path}/{i}.json",) for i in range(5)] * 2, "path string")
    target = work_path(spark, "lots")
    first = files.read_listed(spark, names, target, at_once=2).collect()
    assert sorted((bytes(r.content), r.byte_count) for r in first) == [(str(i).encode(), 1) for i in range(5)]
    (tmp_path / "0.json").write_text("changed")
    assert sorted(files.read_listed(spark, names, target, at_once=2).collect()) == sorted(first)
    assert files.read_listed(spark, names.where("false"), work_path(spark, "none")).collect() == []


def test_a_failed_gate_is_held_against_that_very_source_and_voids_the_marks_of_the_day(spark):
    given, target, ledger = sources(spark), work_path(spark, "held"), work_path(spark, "ledger")
    listed = lambda digest: spark.createDataFrame([("ranks.csv", 10, digest)], BU.FILES)
    at = lambda digest: BU.Sources(given.payloads, given.ranks, given.fallback, given.markup, rank_files=listed(digest))
    with pytest.raises(G.GateError, match="coverage"):
        BU.build(spark, at("a" * 64), target, "2026-08-15", BU.Limits(floors=G.FLOORS), ledger)
    with pytest.raises(G.GateError, match="quarantined"):
        BU.build(spark, at("a" * 64), target, "2026-08-15", ledger=ledger)
    marks = spark.sql("select '無' key, '2026-08-15' dt, timestamp'2026-08-15 01:00:00' at union all select '無', '2026-08-14', timestamp'2026-08-14 01:00:00'")
    assert PB.live_marks(marks, PB.read_ledger(spark, ledger)).count() == 2
    with pytest.raises(G.GateError, match="stroke"):
        BU.build(spark, at("b" * 64), target, "2026-08-15", BU.Limits(min_strokes=3), ledger)
    held = PB.read_ledger(spark, ledger)
    assert sorted((r.kind, r.path, r.dt) for r in held.collect()) == [("quarantine", "ranks.csv", "2026-08-15"), ("void", None, "2026-08-15")]
    late = spark.sql("select '後' key, '2026-08-15' dt, current_timestamp() + interval 1 hour at")
    assert sorted((r.key, r.dt) for r in PB.live_marks(marks.union(late), held).collect()) == [("後", "2026-08-15"), ("無", "2026-08-14")]
    assert counts(BU.build(spark, at("b" * 64), target, "2026-08-15", ledger=ledger))["written"] == 5
    assert PB.read_ledger(spark, work_path(spark, "never")).collect() == []
