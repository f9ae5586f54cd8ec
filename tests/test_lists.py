import itertools
import random

import pytest
from pyspark.sql import functions as F

from lexigrain.operators import alignment as A
from lexigrain.operators import ranklist as R
from lexigrain.operators import scores as S
from lexigrain.operators.ranking import competition_rank, full_rank, top_n
from lexigrain.session import work_path
from lexigrain.sources import ranked_csv

RAW = "Word string, Form string, Rank string"


def checked(spark, data, limits=None):
    return R.row_reasons(spark.createDataFrame(data, RAW), limits=limits)


def test_duplicates_and_conflicts(spark, rows):
    valid = R.valid_rows(checked(spark, [
        ("甲", "こう", "100"), ("甲", "こう", "100"), ("乙", "おつ", "400"), ("丙", "へい", "500"), ("丙", "へい", "600"),
    ]))
    assert rows(R.conflict_free(valid)) == [("乙", "おつ", 400), ("甲", "こう", 100)]
    assert rows(R.parse_stats(valid)) == [(5, 1, 1, 2, 2)]
    assert rows(R.conflicting_pairs(valid)) == [("丙", "へい", 2)]


def test_folding_comes_before_comparison(spark, rows):
    valid = R.valid_rows(checked(spark, [
        ("発", "はつ", "100"), ("発", "ハツ", "200"), ("Ａ", "エー", "300"), ("A", "えー", "300"), ("乙", "おつ", "400"),
    ]))
    assert rows(R.conflict_free(valid)) == [("A", "えー", 300), ("乙", "おつ", 400)]
    assert rows(R.parse_stats(valid)) == [(5, 1, 1, 2, 2)]


@pytest.mark.parametrize("rank", ["+1", "1_0", "١", "１", "01", " 1", "", "0", "1\n", "10000001", "99999999999999999999"])
def test_bad_ranks(spark, rank):
    assert checked(spark, [("甲", "こう", rank)], R.STRICT_LIMITS).first().reason in ("invalid rank", "rank out of range")


def test_nothing_is_limited_unless_asked_for(spark, rows):
    data = [("a" * 500, "b" * 900, "3000000000"), ("a", "b", "9" * 30)]
    assert [r.reason for r in checked(spark, data).collect()] == [None, "rank out of range"]
    assert [r[2] for r in rows(R.valid_rows(checked(spark, data)))] == [3000000000]


def test_reasons(spark):
    data = [
        (" ", "a", "1"), ("a", "　", "1"), ("a" * 129, "a", "1"), ("a", "b" * 257, "1"), ("a", "b", None),
        ("a" * 128, "b" * 256, "10000000"),
    ]
    got = [r.reason for r in checked(spark, data, R.STRICT_LIMITS).collect()]
    assert got == ["empty word", "empty form", "word too long", "form too long", "malformed row", None]


def write(spark, text):
    path = work_path(spark, "csv-test")
    spark.createDataFrame([(text,)], "value string").coalesce(1).write.option("lineSep", "\n").text(path)
    return path


def test_csv(spark, rows):
    path = write(spark, '﻿Word,Form,Rank\n甲,こう,1\n"a,""b",ab,2\n')
    assert rows(ranked_csv.read(spark, path)) == [('a,"b', "ab", 2), ("甲", "こう", 1)]
    with pytest.raises(ValueError, match="row limit"):
        ranked_csv.read(spark, path, max_rows=1)


@pytest.mark.parametrize("text", [
    "word,Form,Rank\na,b,1\n", "Word,Form\na,b\n", "Word,Form,Rank\na,b\n", "Word,Form,Rank\na,b,1,2\n",
    "Word,Form,Rank\na,b,x\n", "Word,Form,Rank\na,b,1\na,b,2\n",
])
def test_csv_refused(spark, text):
    with pytest.raises(ValueError):
        ranked_csv.read(spark, write(spark, text))


def align(spark, words, options):
    given = spark.createDataFrame([(s, r, i + 1) for i, (s, r) in enumerate(words)], "surface string, reading string, rank bigint")
    table = spark.createDataFrame(options, "key string, alone array<string>, compound array<string>")
    found = A.align(given, table).orderBy("rank").collect()
    return [None if r.alignment is None else [tuple(x) for x in r.alignment] for r in found]


def test_alignment_examples(spark):
    kou, otsu = ("甲", ["こう", "こ"], ["こう", "こ"]), ("乙", ["おつ"], ["おつ"])
    assert align(spark, [("甲乙", "こうおつ"), ("甲乙", "かんおつ")], [kou, otsu]) == [[(0, "甲", "こう"), (1, "乙", "おつ")], None]
    assert align(spark, [("甲乙", "こうあ")], [kou, ("乙", ["あ", "うあ"], ["あ", "うあ"])]) == [None]
    assert align(spark, [("生々", "なまなま")], [("生", ["なま"], ["なま"])]) == [[(0, "生", "なま"), (1, "生", "なま")]]
    fresh = [("桐", ["きり"], ["きり"]), ("生", ["せい", "い", "いく"], ["せい", "い"])]
    assert align(spark, [("桐生", "きりいく"), ("生", "いく")], fresh) == [None, [(0, "生", "いく")]]
    han = [f"甲{c}" for c in "〇⺀〡\U0002ebf0\U0003347f乙"]
    assert align(spark, [(s, "こう" + s[1]) for s in han], [kou]) == [None] * len(han)
    assert align(spark, [("甲 乙", "こうおつ"), ("甲の", "こうの"), ("甲ノ", "こうの")], [kou, otsu]) == [
        None, [(0, "甲", "こう")], [(0, "甲", "こう")]
    ]


def test_alignment_is_exact_however_many_segmentations_there_are(spark):
    many = ("甲", ["あ", "ああ", "あああ"], ["あ", "ああ", "あああ"])
    words = [("甲" * 4, "あ" * 4), ("甲" * 4, "あ" * 12), ("甲" * 6, "あ" * 18), ("甲" * 6, "あ" * 17), ("甲" * 40, "あ" * 80)]
    assert align(spark, words, [many]) == [
        [(i, "甲", "あ") for i in range(4)], [(i, "甲", "あああ") for i in range(4)], [(i, "甲", "あああ") for i in range(6)], None, None,
    ]


def model_align(surface, reading, alone, compound):
    tokens, previous = [], None
    for ch in surface:
        if ch in alone:
            previous = ch
            tokens.append(ch)
        elif ch == "々" and previous:
            tokens.append(previous)
        elif ch == "々":
            return None
        else:
            previous = None
            tokens.append("=" + ch)
    choices = []
    for i, t in enumerate(tokens):
        if t[0] == "=":
            choices.append([t[1]])
            continue
        near = [tokens[j][0] != "=" for j in (i - 1, i + 1) if 0 <= j < len(tokens)]
        choices.append((compound if any(near) else alone)[t])
    found = [p for p in itertools.product(*choices) if "".join(p) == reading]
    return [(i, t, o) for i, (t, o) in enumerate(zip(tokens, found[0])) if t[0] != "="] if len(found) == 1 else None


def test_alignment_against_brute_force(spark):
    rng = random.Random(7)
    alone = {k: sorted({"".join(rng.choices("あい", k=rng.randint(1, 2))) for _ in range(2)}) for k in "甲乙丙"}
    compound = {k: v[:1] + ["い"][: k == "乙"] for k, v in alone.items()}
    compound = {k: sorted(set(v)) for k, v in compound.items()}
    words = sorted({
        ("".join(rng.choices("甲乙丙々あい", k=rng.randint(1, 3))), "".join(rng.choices("あい", k=rng.randint(1, 5)))) for _ in range(600)
    })
    words = [w for w in words if set(w[0]) & set("甲乙丙")]
    got = align(spark, words, [(k, alone[k], compound[k]) for k in alone])
    assert got == [model_align(s, r, alone, compound) for s, r in words]
    assert sum(g is not None for g in got) > 20


def test_reading_options(spark):
    df = spark.createDataFrame(
        [(["ジョウ", "ハ-ク", "ﾁﾞ"], ["たか.い", "ち.る"], ["じょう", "はく", "ばく", "ぱく", "はっ", "たか", "だか", "ち", "ぢ", "た"])],
        "o array<string>, k array<string>, a array<string>",
    )
    got = df.select(A.compositional_options("o", "k", "a").alias("x")).first().x
    assert got == ["じょう", "たか", "だか", "はく", "はっ", "ばく", "ぱく", "ち", "ぢ"]


def test_scores_and_statistics(spark, rows):
    given = spark.createDataFrame(
        [("甲", "こう", 100), ("甲乙", "こうおつ", 400), ("甲丁", "こうてい", 500), ("かな", "かな", 1), ("甲甲", "こうこう", 0)],
        "surface string, reading string, rank bigint",
    )
    options = spark.createDataFrame([("甲", ["こう"], ["こう"]), ("乙", ["おつ"], ["おつ"])], "key string, alone array<string>, compound array<string>")
    groups = spark.createDataFrame([("甲", "こう", 1, "On"), ("乙", "おつ", 1, "On"), ("乙", "いつ", 2, "On")], "key string, reading string, ord int, reading_class string")
    aligned = A.align(given, options)
    scores = S.reading_scores(aligned, groups)
    assert rows(scores, "key", "reading", "score", "reading_class") == [("乙", "おつ", 0.05, "On"), ("甲", "こう", 0.15, "On")]
    stats = S.alignment_stats(aligned, scores).first()
    assert tuple(stats)[:5] == (5, 4, 2, 1, 3)
    assert stats.keys_with_scores == stats.groups_with_scores == 2
    assert abs(stats.weight_coverage - 0.15 / (0.15 + 500**-0.5)) < 1e-12


def test_relevant(spark, rows):
    given = spark.createDataFrame([("甲a", "x", 1), ("々", "x", 2), ("ab", "x", 3)], "surface string, reading string, rank bigint")
    assert rows(R.relevant(given, spark.createDataFrame([("甲",)], "key string"))) == [("甲a", "x", 1)]


@pytest.mark.parametrize("partitions", [1, 3, 16])
def test_ranks_hold_for_a_hot_group(spark, partitions):
    rng = random.Random(3)
    data = [("hot" if i % 3 else f"k{i % 7}", rng.randint(0, 20), i) for i in range(900)]
    df = spark.createDataFrame(data, "k string, v int, i int").repartition(partitions)
    want = {}
    for k in {d[0] for d in data}:
        for n, d in enumerate(sorted((d for d in data if d[0] == k), key=lambda d: (-d[1], d[2])), 1):
            want[d[2]] = n
    ranked = full_rank(df, ["k"], [F.desc("v"), F.asc("i")])
    assert {r.i: r.ord for r in ranked.collect()} == want
    top = top_n(df, ["k"], [F.desc("v"), F.asc("i")], 5)
    assert {r.i: r.ord for r in top.collect()} == {i: n for i, n in want.items() if n <= 5}
    shared = {r.i: r.rank for r in competition_rank(df, ["k"], "v").collect()}
    assert all(shared[d[2]] == 1 + sum(e[0] == d[0] and e[1] > d[1] for e in data) for d in data[::37])
    everything = full_rank(df, [], [F.asc("i")])
    assert {r.i: r.ord for r in everything.collect()} == {i: i + 1 for i in range(900)}


def test_top_n_limits_before_the_shuffle(spark):
    plan = top_n(spark.range(100).selectExpr("id % 3 k", "id v"), ["k"], [F.asc("v")], 2)
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert text.count("WindowGroupLimit") == 2
