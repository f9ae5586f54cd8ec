from pyspark.sql import functions as F

from lexigrain.functions import markup as M
from lexigrain.functions import text as T
from lexigrain.functions.weights import rank_weight


def apply(spark, values, f, kind="string"):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, x {kind}")
    return [r.y for r in df.select("i", f(F.col("x")).alias("y")).orderBy("i").collect()]


def test_reading_stem(spark):
    given = ["ジョウ", "たか.い", "-ゆ.き", "つか.える", "  ば  ", "", None, "　ば　"]
    assert apply(spark, given, T.reading_stem) == ["じょう", "たか", "ゆ", "つか", "ば", "", "", "ば"]


def test_kana_fold_keeps_the_long_mark(spark):
    assert apply(spark, ["ァヶーヷ漢a"], T.kana_fold) == ["ぁゖーヷ漢a"]


def test_reading_class(spark):
    df = spark.createDataFrame(
        [("じょう", ["ジョウ", "チョウ"], ["ば"]), ("ば", ["ジョウ"], ["ば"]), ("えき", ["ジョウ"], ["ば"]),
         ("たか", None, ["たか.い"]), ("だか", [], ["-だか"]), ("", [""], [""]), ("こ", ["コ"], ["こ"])],
        "r string, on array<string>, kun array<string>",
    )
    got = [r.c for r in df.select(T.reading_class("r", "on", "kun").alias("c")).collect()]
    assert got == ["On", "Kun", "Other", "Kun", "Kun", "Other", "On"]


def test_clean_text(spark):
    given = ["  measure \t place ", "", "MISSING", " ??? ", "a < b tag", "x>y", None, "a　b\x1cc", "missing it", "line\n<b"]
    assert apply(spark, given, T.clean_text) == [
        "measure place", None, None, None, None, None, None, "a b c", "missing it", None
    ]


def test_clean_array(spark):
    given = [["missing", "measure", "measure", "???", "fathom", "<b>plumb</b>"], None, []]
    assert apply(spark, given, T.clean_array, "array<string>") == [["measure", "fathom"], [], []]


def test_ruby_segments(spark):
    given = ["場[ば]所[しょ]", "測[はか]る", "bad[ruby", "", "　 ", "a[b][c]", "]a[", "あ[]", None, "[x]y"]
    got = apply(spark, given, T.ruby_segments)
    assert [None if s is None else [tuple(x) for x in s] for s in got] == [
        [("場", "ば"), ("所", "しょ")], [("測", "はか"), ("る", "")], None, None, None, None, None, [("あ", "")], None, None
    ]


def test_ruby_refuses_long_bad_text_quickly(spark):
    assert apply(spark, ["a" * 20000 + "["], T.ruby_segments) == [None]


def test_nfkc(spark):
    given = ["Ａｂ", "ｶﾞ", "発", "é", "é", None, "①"]
    assert apply(spark, given, T.nfkc) == ["Ab", "ガ", "発", "é", "é", None, "1"]
    assert apply(spark, [" ハツ　", "ｴｰ", None], T.nfkc_fold) == ["はつ", "えー", ""]
    assert apply(spark, [["ｱ", "b\x1fc"], [], None], T.nfkc_each, "array<string>") == [["ア", "bc"], [], []]


def test_character_classes_agree_with_their_counts(spark):
    text = "aあアー々〆〇漢⺀〡ヿ゠𠀋𪜀\U0002ebf0\U0003347f、。"
    chars = list(text)
    kana = apply(spark, chars, T.is_kana)
    han = apply(spark, chars, T.is_han)
    assert [c for c, k in zip(chars, kana) if k] == list("あアーヿ゠")
    assert [c for c, h in zip(chars, han) if h] == list("々〆〇漢⺀〡𠀋𪜀\U0002ebf0\U0003347f")
    assert apply(spark, [text], T.kana_count) == [sum(kana)]
    assert apply(spark, [text], T.han_count) == [sum(han)]


def test_keys_and_links(spark):
    assert apply(spark, ["場", "𠀋", "a"], T.code_point_hex) == ["05834", "2000b", "00061"]
    assert apply(spark, ["場", "a𠀋"], lambda c: T.key_file_name(c, "json")) == ["5834.json", "61_2000b.json"]
    assert apply(spark, ["場"], lambda c: T.asset_path(c, "m", "svg")) == ["m/05834.svg"]
    assert apply(spark, ["a b*~é/?"], T.query_link) == ["?query=a%20b%2A~%C3%A9%2F%3F"]
    assert apply(spark, [0x5834, 0x2000B, 97], T.from_code_point, "bigint") == ["場", "𠀋", "a"]
    assert apply(spark, [0, 1, 5, 6, None], T.level_label, "int") == [None, "N1", "N5", None, None]
    assert apply(spark, ["2026-08-16"], T.date_to_revision) == ["2026.08.16"]


def test_rank_weight(spark):
    got = apply(spark, [100, 400, 200000, 0, -1, 10_000_001, None], lambda r: rank_weight(r, 10_000_000), "bigint")
    assert got[:2] == [0.1, 0.05]
    assert abs(got[2] - 0.25 / 200000**0.5) < 1e-18
    assert got[3:] == [0.0] * 4
    open_ended = apply(spark, [10_000_000, 10_000_001, None], rank_weight, "bigint")
    assert 0 < open_ended[1] < open_ended[0] and open_ended[2] == 0.0


SVG = (
    '<svg xmlns:kvg="x"><g kvg:element="時" kvg:phon="寺"><path d="M1,1c1,1 2,2 3,3"/><path id="a" d="M5,5"/>'
    '<text transform="matrix(1 0 0 1 4.25 -9)">1</text><text transform="matrix(1 0 0 1 4 9)">0</text><script>x</script></g></svg>'
)


def test_markup(spark):
    df = spark.createDataFrame([("時", SVG), ("持", SVG), ("寺", SVG), ("x", "<g/>")], "key string, svg string")
    got = df.select(
        "key", M.stroke_count("svg"), M.components("svg", "key"), M.first_marker("svg", "key"), M.strokes("svg"),
        M.unsafe_hits("svg"), M.rebuilt("svg"),
    ).collect()
    assert [tuple(r)[1:4] for r in got] == [(2, ["時"], "寺"), (2, ["持", "時"], "寺"), (2, ["寺", "時"], None), (None, None, None)]
    assert got[0][4] == ["M1,1c1,1 2,2 3,3", "M5,5"]
    assert got[0][5] == ["script", "namespace"]
    assert got[0][6] == (
        '<svg xmlns="http://www.w3.org/2000/svg"><path d="M1,1c1,1 2,2 3,3"/><path d="M5,5"/>'
        '<text x="4.25" y="-9">1</text></svg>'
    )
    assert df.select(M.unsafe_hits(M.rebuilt("svg")).alias("h")).first().h == []
