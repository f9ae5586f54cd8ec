import json
import random

import pytest
from pyspark.sql import functions as F

from lexigrain.operators import banks as B
from lexigrain.operators import distribution as D
from lexigrain.operators import examples as E
from lexigrain.operators import families as FM
from lexigrain.operators import gates as G
from lexigrain.operators import readings as RD
from lexigrain.operators import records as R
from lexigrain.session import work_path
from lexigrain.sources import files, payloads, xml_dictionary


def word(i, rank, surface="あ", index=0, **other):
    return {"wordId": i, "readingIndex": index, "reading": surface, "readingFurigana": surface, "mainDefinition": f"g{i}", "frequencyRank": rank, **other}


def table(spark, *docs):
    data = [(d.get("character") if isinstance(d, dict) else str(i), json.dumps(d)) for i, d in enumerate(docs)]
    return payloads.parsed(spark.createDataFrame(data, "key string, json string"))


PLACE = {
    "character": "場", "meanings": ["location", " place ", "location", 7, "???"], "onReadings": ["ジョウ", "チョウ", None], "kunReadings": ["ば"],
    "frequencyRank": 57, "strokeCount": 12, "grade": 2.0, "jlptLevel": True,
    "wordsByReading": [
        {"reading": "ジョウ", "totalWords": 100, "words": [word(1, 50), word(2, 10), word(3, 60), 7, None]},
        {"reading": "ば", "totalWords": 20, "words": [word(2, 5), word(1, 6), word(9, True), word("9", 3), word(8, "4"), word(7, 2.0)]},
        {"reading": "じょう", "totalWords": 5, "words": [word(1, 9)]},
        3, {"reading": "x", "totalWords": True}, {"reading": "y", "totalWords": "12"}, {"reading": "z", "totalWords": -3}, {"words": {}},
    ],
    "topWords": [word(4, 2), word(5, 25001), word(6, 3, "x<y")],
}


def test_normalized_record(spark):
    lone = {"character": "生", "topWords": [word(4, 2), word(4, 1), word(6, 3), word(7, 4), word(8, 5)]}
    docs = table(spark, PLACE, lone, {"character": "ab"}, [1], {"character": 5})
    got = {r.key: r for r in R.normalized(docs, 25_000).collect()}
    assert sorted(got) == ["場", "生"]
    r = got["場"]
    assert (r.keyword, r.senses, r.on, r.kun) == ("location", ["location", "place"], ["ジョウ", "チョウ"], ["ば"])
    assert (r.frequency_rank, r.stroke_count, r.grade, r.jlpt) == (57, 12, None, None)
    assert [(g.reading, g.reading_class, [w.word_id for w in g.words]) for g in r.examples] == [("ば", "Kun", [2, 1]), ("ジョウ", "On", [3])]
    assert [(w.word_id, w.rank) for w in r.global_words] == [(4, 2), (2, 5), (1, 6), (3, 60)]
    assert [tuple(c) for c in r.reading_entry_counts] == [("じょう", 105, "On"), ("ば", 20, "Kun")]
    assert r.reading_frequency_scores == []
    s = got["生"]
    assert [(g.label, [w.word_id for w in g.words]) for g in s.examples] == [("Other", [4, 6, 7])]
    assert s.keyword is None and s.reading_entry_counts == []
    inventory = [(x.reading, x.ord, x.reading_class) for x in R.reading_inventory(docs).orderBy("ord").collect()]
    assert inventory == [("じょう", 1, "On"), ("ば", 2, "Kun"), ("x", 3, "Other"), ("y", 4, "Other"), ("z", 5, "Other")]
    scores = spark.createDataFrame([("場", 2, "ば", "Kun", 0.5), ("場", 1, "じょう", "On", 0.2)], "key string, ord int, reading string, reading_class string, score double")
    attached = {r.key: r.reading_frequency_scores for r in R.with_scores(R.normalized(docs, 25_000), scores).collect()}
    assert [tuple(x) for x in attached["場"]] == [("じょう", 0.2, "On"), ("ば", 0.5, "Kun")] and attached["生"] == []


def model_greedy(words):
    groups = {}
    for g, item, rank, pos in words:
        groups.setdefault(g, []).append((rank, pos, item))
    seen, out = set(), []
    for g in sorted(groups, key=lambda g: (min(groups[g])[0], g)):
        taken = []
        for _, _, item in sorted(groups[g]):
            if item not in seen and len(taken) < 2:
                seen.add(item)
                taken.append(item)
        if taken:
            out.append((g, taken))
        if len(out) == 3:
            break
    return [(n, g, p, item) for n, (g, items) in enumerate(out, 1) for p, item in enumerate(items, 1)]


@pytest.mark.parametrize("seed", range(3))
def test_greedy_choice_against_a_model(spark, seed):
    rng = random.Random(seed)
    data = []
    for key in range(40):
        items = rng.randint(1, 8)
        for g in range(rng.randint(1, 60)):
            for pos in range(rng.randint(1, 5)):
                data.append((key, g, rng.randint(0, items), rng.randint(1, 9), pos))
    df = spark.createDataFrame(data, "key int, g int, item int, rank int, pos int")
    got = {}
    for r in E.greedy_groups(df, ["key"], ["g"], ["item"]).collect():
        got.setdefault(r.key, []).append((r.ord, r.g, r.place, r.item))
    for key in range(40):
        assert sorted(got[key]) == model_greedy([d[1:] for d in data if d[0] == key])


def test_distribution(spark, rows):
    data = [("x", 0, "a", "On", 20.0), ("x", 1, "b", "On", 1.0), ("x", 2, "c", "Kun", 50.0), ("x", 3, "d", "On", 20.0), ("x", 4, "e", None, 9.0),
            ("x", 5, "n", "On", float("nan")), ("x", 6, "i", "On", float("inf")), ("x", 7, "z", "On", 0.0), ("x", 8, "", "On", 4.0),
            ("y", 1, "q", "Kun", 1.0), ("y", 0, "q", "On", 1.0), ("y", 2, "r", "Kun", 4.0), ("v", 0, "r", "Kun", -1.0)]
    seg = D.distribution(spark.createDataFrame(data, "key string, pos int, reading string, reading_class string, score double"), ["key"])
    assert rows(seg, "key", "ord", "reading", "reading_class", "percent", "color", "collapsed") == [
        ("x", 1, "c", "Kun", 50, "#0072b2", True), ("x", 2, "a", "On", 20, "#d55e00", True), ("x", 3, "d", "On", 20, "#009e73", True),
        ("x", 4, "e", "Other", 9, "#cc79a7", True), ("x", 5, "", "Other", 1, "#767676", True),
        ("y", 1, "r", "Kun", 67, "#0072b2", False), ("y", 2, "q", "On", 33, "#d55e00", False),
    ]
    text = {r.key: (r.alt_text, r.legend) for r in D.labels(seg, ["key"]).collect()}
    assert text["y"] == ("r 67 percent, q 33 percent", "r: 67%\nq: 33%")


def test_largest_remainder_against_a_model(spark):
    rng = random.Random(5)
    data = [(k, i, rng.choice([0, 1, 1, 3, 7, 50])) for k in range(30) for i in range(rng.randint(1, 300))] + [(99, 0, 0)]
    got = D.largest_remainder(spark.createDataFrame(data, "k int, i int, v bigint"), ["k"], "i", "v")
    found = {}
    for r in got.collect():
        found.setdefault(r.k, {})[r.i] = r.percent
    assert 99 not in found
    for k in range(30):
        values = [v for kk, _, v in data if kk == k]
        total = sum(values)
        if not total:
            assert k not in found
            continue
        exact = [v * 100.0 / total for v in values]
        floors = [int(x) for x in exact]
        for i in sorted(range(len(values)), key=lambda i: (-(exact[i] - floors[i]), i))[: 100 - sum(floors)]:
            floors[i] += 1
        assert [found[k][i] for i in range(len(values))] == floors


def test_families(spark, rows):
    pairs = spark.createDataFrame([("時", "寺"), ("持", "寺"), ("待", "寺"), ("校", "交"), ("寺", "寺"), ("x", None), ("時", "寺")], "key string, component string")
    ranks = spark.createDataFrame([("時", 200), ("持", 400), ("待", 100)], "key string, rank bigint")
    members = FM.family_members(pairs, ranks)
    assert rows(members, "ord", "member", "size") == [(1, "待", 3), (2, "時", 3), (3, "持", 3)]
    assert {r.member: (r.siblings, r.previous, r.next) for r in FM.siblings(members).collect()} == {
        "待": (2, None, "時"), "時": (2, "待", "持"), "持": (2, "時", None),
    }
    asked = spark.createDataFrame([("時",), ("校",)], "key string")
    assert rows(FM.siblings_of(members, asked), "ord", "sibling") == [(1, "待"), (3, "持")]
    one = FM.family_members(pairs, ranks.where("key = '時'"))
    assert rows(one, "ord", "member") == [(1, "時"), (2, "待"), (3, "持")]


def test_a_large_family_has_the_same_form(spark):
    pairs = spark.range(1000).select(F.format_string("k%04d", "id").alias("key"), F.lit("寺").alias("component"))
    got = {r.member: (r.ord, r.siblings, r.previous, r.next) for r in FM.siblings(FM.family_members(pairs)).collect()}
    assert len(got) == 1000 and got["k0500"] == (501, 999, "k0499", "k0501") and got["k0999"][3] is None


XML = """<?xml version="1.0"?><dictionary>
<character><literal>場</literal><misc><grade>2</grade><stroke_count>12</stroke_count><jlpt>x</jlpt></misc><reading_meaning>
<rmgroup><reading r_type="ja_on">ジョウ</reading><reading r_type="ja_kun">ば</reading><reading r_type="pinyin">chang</reading>
<meaning>location</meaning><meaning m_lang="fr">lieu</meaning></rmgroup><rmgroup><meaning> place </meaning></rmgroup><nanori>なみ</nanori></reading_meaning></character>
<character><literal>丄</literal><reading_meaning><rmgroup><reading r_type="pinyin">shang</reading></rmgroup></reading_meaning></character>
<character><literal>ab</literal><reading_meaning><rmgroup><meaning>no</meaning></rmgroup></reading_meaning></character>
<character><literal>無</literal></character>
<character><literal>唖</literal><misc><stroke_count>10</stroke_count></misc><reading_meaning><rmgroup><reading r_type="ja_on">ア</reading><meaning>mute</meaning></rmgroup></reading_meaning></character>
<character><literal>唖</literal><misc><stroke_count>11</stroke_count></misc><reading_meaning><rmgroup><reading r_type="ja_on">アク</reading><meaning>dumb</meaning></rmgroup></reading_meaning></character>
</dictionary>"""


def test_xml_fallback_and_merge(spark, rows):
    path = work_path(spark, "xml-test")
    spark.createDataFrame([(XML,)], "value string").coalesce(1).write.text(path)
    index = xml_dictionary.read(spark, path)
    assert rows(index, "key", "meanings", "on", "kun", "nanori", "stroke_count", "grade", "jlpt") == [
        ("唖", ["dumb"], ["アク"], [], [], 11, None, None), ("場", ["location", "place"], ["ジョウ"], ["ば"], ["なみ"], 12, 2, None),
    ]
    # Two files: the later path wins, whatever its size.
    both = work_path(spark, "xml-two")
    for name, body in (("a", XML), ("b", XML.replace("<meaning>dumb", "<meaning>silent").replace("アク", "アイ"))):
        spark.createDataFrame([(body,)], "value string").coalesce(1).write.text(f"{both}/{name}")
    two = xml_dictionary.read(spark, f"{both}/*")
    assert rows(two.where("key = '唖'"), "meanings", "on") == [(["silent"], ["アイ"])]
    merged = R.merge_priority(R.normalized(table(spark, PLACE)), R.fallback_records(index))
    got = {r.key: r for r in merged.collect()}
    assert (got["場"].origin, got["場"].frequency_rank) == ("primary", 57)
    assert (got["唖"].origin, got["唖"].frequency_rank, got["唖"].examples, got["唖"].reading_frequency_scores) == ("fallback", None, [], [])
    assert rows(R.source_counts(merged)) == [(2, 1, 1)]


def test_banks_and_cards(spark):
    records = R.normalized(table(spark, PLACE, {"character": "空"}), 25_000)
    terms = {r.expression: r for r in B.term_rows(records, F.lit("card")).collect()}
    assert (terms["場"].sequence, terms["場"].score, terms["場"].reading) == (0x5834, 0, "")
    keys = {r.character: r for r in B.key_rows(records).collect()}
    assert keys["場"].on == "ジョウ チョウ" and keys["場"].stats == {"Frequency rank": "57", "Strokes": "12"} and keys["空"].stats == {}
    assert [tuple(r) for r in B.meta_rows(records).collect()] == [("場", "freq", 57)]
    alias = B.alias_rows(spark.createDataFrame([("髙", "高")], "alias string, canonical string")).first()
    assert (alias.expression, alias.glossary, alias.sequence) == ("髙", "variant of 高", 0x9AD9)
    dist = spark.createDataFrame([("場", "alt", "leg")], "key string, alt_text string, legend string")
    cards = {r.key: r for r in B.cards(records, distribution=dist).collect()}
    c, empty = cards["場"], cards["空"]
    assert (c.hero.keyword, c.meaning, c.top_readings, c.details) == ("location", "location; place", ["じょう", "ば"], ["Rank 57", "12 strokes"])
    assert c.distribution.alt_text == "alt" and len(c.words) == 4 and c.more_words is None and c.strokes is None
    assert empty.hero.keyword == "空"
    assert [empty[x] for x in ("top_readings", "meaning", "distribution", "words", "all_readings", "details", "more_words", "family")] == [None] * 8


def test_more_words_are_those_not_shown(spark):
    many = {"character": "場", "wordsByReading": [{"reading": "ば", "words": [word(i, i) for i in range(1, 8)]}, {"reading": "じ", "words": [word(20, 20), word(21, 21)]}]}
    card = B.cards(R.normalized(table(spark, many))).first()
    assert [w.word_id for w in card.words] == [1, 2, 3, 4, 5, 6]
    assert [[w.word_id for w in g.words] for g in card.more_words] == [[20, 21]]


def test_key_list(spark, rows):
    docs = payloads.parsed(spark.createDataFrame([('["b","",3,"a"]',)], "json string"))
    assert rows(files.key_items(docs)) == [(0, "b"), (3, "a")]
    with pytest.raises(Exception, match="no key"):
        files.key_items(docs, strict=True).collect()
    for text in ('{"a":1}', "nope"):
        with pytest.raises(Exception, match="not an array"):
            files.key_items(payloads.parsed(spark.createDataFrame([(text,)], "json string"))).collect()
    assert files.key_items(payloads.parsed(spark.createDataFrame([("[]",)], "json string")), strict=True).collect() == []
    keys = spark.createDataFrame([(2, "c"), (0, "a"), (1, "b")], "pos int, key string")
    assert rows(files.limit_keys(keys, 2)) == [(0, "a"), (1, "b")]


def test_quality_floor_and_identity(spark, rows):
    bare = {"character": "空", "frequencyRank": 1000, "meanings": ["sky"], "onReadings": ["クウ"]}
    rare = {"character": "稀", "frequencyRank": 1001}
    records = R.normalized(table(spark, PLACE, bare, rare))
    assert rows(G.top_rank_quality(records), "key") == [("空",)]
    with pytest.raises(G.GateError):
        G.require_none(G.top_rank_quality(records), "quality floor")
    pairs = spark.createDataFrame([("場", "場"), ("生", "場"), ("a", None)], "key string, character string")
    assert rows(G.identity(pairs), "key") == [("a",), ("生",)]


def test_entry_counts_keep_genuine_totals_only(spark, rows):
    doc = {"character": "場", "wordsByReading": [{"reading": r, "totalWords": t} for r, t in zip("abcdefg", [5, 0, -3, True, "12", 2.5, None])]}
    counts = RD.entry_counts(RD.payload_readings(table(spark, doc)), ["key"])
    assert rows(counts) == [("場", "a", 5)]
