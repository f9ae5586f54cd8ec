"""Steps whose cost grew faster than their input, or that ran in one task."""

import re

from pyspark.sql import functions as F

from lexigrain.functions.text import clean_array, clean_text
from lexigrain.operators import alignment as A
from lexigrain.plans import QUERIES, scoring, turns
from lexigrain.session import work_path
from lexigrain.sources import files


def plan(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def documents(spark, tmp_path, rows):
    df = spark.createDataFrame(rows, "doc_id bigint, lang string, source string, n_chars bigint, text string")
    df.coalesce(1).write.parquet(f"{tmp_path}/documents.parquet")
    return str(tmp_path)


def test_a_file_for_each_name_is_written_by_many_tasks(spark):
    path = work_path(spark, "per-name")
    rows = [(f"{i}.svg", f"text {i}\nend") for i in range(60)] + [("7.svg", "more"), ("8.svg", None), (None, "lost"), ("a b", "x")]
    df = spark.createDataFrame(rows, "name string, value string").coalesce(1)
    spark.sparkContext.setJobGroup("per-name", "per-name")
    files.write_per_name(df, path)
    tracker = spark.sparkContext.statusTracker()
    stages = [s for j in tracker.getJobIdsForGroup("per-name") for s in tracker.getJobInfo(j).stageIds]
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert max(i.numTasks for i in map(tracker.getStageInfo, stages) if i) > 8
    found = spark.read.option("recursiveFileLookup", True).text(path, wholetext=True)
    got = {r.f: r.value for r in found.select(F.regexp_extract("_metadata.file_path", "name=([^/]*)/", 1).alias("f"), "value").collect()}
    assert len(got) == 62 and got["3.svg"] == "text 3\nend\n"
    assert sorted(got["7.svg"].split("\n")) == ["", "end", "more", "text 7"] and sorted(got["8.svg"].split("\n"))[-2:] == ["end", "text 8"]
    assert got[files.NO_NAME] == "lost\n"


def test_names_of_a_lot_are_not_looked_up_by_a_task_each(spark, tmp_path):
    for i in range(90):
        (tmp_path / f"{i}.json").write_text(str(i))
    names = spark.createDataFrame([(f"file:{tmp_path}/{i}.json",) for i in range(90)], "path string")
    spark.sparkContext.setJobGroup("lots", "lots")
    read = files.read_listed(spark, names, work_path(spark, "lots-read"), at_once=40)
    tracker = spark.sparkContext.statusTracker()
    stages = [s for j in tracker.getJobIdsForGroup("lots") for s in tracker.getJobInfo(j).stageIds]
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert 0 < max(i.numTasks for i in map(tracker.getStageInfo, stages) if i) <= spark.sparkContext.defaultParallelism + 1
    assert sorted(int(bytes(r.content)) for r in read.collect()) == list(range(90))


def test_options_of_a_key_stay_out_of_the_grouping_and_all_that_occur_are_found(spark):
    many = [a + b for a in "あいうえおかきくけこ" for b in "さしすせそたちつてとなに"]
    options = spark.createDataFrame([("火", many + ["あ", ""], ["あさ"]), ("水", ["い"], None)], "key string, alone array<string>, compound array<string>")
    rows = spark.createDataFrame([("火ア", "あさあ", 1), ("火火", "あさかに", 2), ("水人　", "いさ", 3), ("ん", "ん", 4)], "surface string, reading string, rank bigint")
    chars = A.surface_chars(rows, options)
    gathered = re.findall(r"collect_list\(([^,]*),", plan(chars))
    assert gathered and all(re.fullmatch(r"known#\d+", x) for x in gathered)
    got = {r.surface: r.chars for r in chars.collect()}
    assert [(c.ch, c.alone, c.compound) for c in got["火ア"]] == [("火", ["あさ", "あ", ""], ["あさ"]), ("ア", None, None)]
    assert got["火ア"][1].literal == "あ" and [c.alone for c in got["火火"]] == [["あさ", "かに", "あ", ""]] * 2
    assert [c.literal for c in got["水人　"]][1:] == [A.STOP] * 2 and got["水人　"][0].compound is None and got["ん"][0].literal == "ん"
    solved = {r.surface: r.alignment for r in A.align(rows, options.withColumn("alone", F.array_remove("alone", ""))).collect()}
    assert [(a.key, a.reading) for a in solved["火ア"]] == [("火", "あさ")] and solved["火火"] is None and solved["水人　"] is None


def test_arrays_are_cleaned_as_their_elements_are(spark):
    rows = [
        ["a", "b", "a"], ["a", None, "b"], ["a", "", "b"], [""], [], None, ["MISSING", "a"], ["???", "x???"], ["a <b>"], [" a", "a"],
        ["\x00"], ["a\x00", "b"], ["\x00a", ""], ["a　b"], [None], ["dismissing"], ["a\nb", "a b"], ["", "a"], ["a", ""],
    ]
    df = spark.createDataFrame([(i, x) for i, x in enumerate(rows)], "i int, xs array<string>")
    one_by_one = F.coalesce(F.array_distinct(F.array_compact(F.transform("xs", clean_text))), F.array().cast("array<string>"))
    for r in df.select("i", clean_array("xs").alias("a"), one_by_one.alias("b")).collect():
        assert r.a == r.b, rows[r.i]
    assert "transform" in plan(df.select(clean_array("xs"))) and "CASE WHEN" in plan(df.select(clean_array("xs")))


def test_first_places_are_found_without_sorting_the_words(spark, tmp_path):
    rows = [
        (7, "en", "a", 3, "x y x"), (3, "en", "a", 3, "y z"), (3, "en", "a", 3, "q y"), (None, "en", "a", 3, "m z"), (-(2**63), "en", "b", 3, "k l"),
        (2**63 - 1, "en", "b", 3, "l k n"), (5, "en", "a", 0, None),
    ]
    sf = documents(spark, tmp_path, rows)
    df = scoring.reading_group_order(spark, sf)
    first = {}
    for doc, _, source, _, text in rows:
        for p, w in enumerate((text or "").split()):
            stem = w.translate(str.maketrans("abcdefghijklmnopqrstuvwxyz", "あいうえおかきくけこさしすせそたちつてとなにぬねのは"))
            at = (doc is not None, doc or 0, p)
            first[source, stem] = min(first.get((source, stem), at), at)
    want = []
    for source in {k for k, _ in first}:
        ordered = sorted((at, stem) for (k, stem), at in first.items() if k == source)
        want += [(source, stem, at[1] if at[0] else None, at[2], i) for i, (at, stem) in enumerate(ordered, 1)]
    assert sorted(map(tuple, df.collect()), key=repr) == sorted(want, key=repr)
    seen = scoring.first_places(spark, sf)
    assert "SortAggregate" not in seen._jdf.queryExecution().executedPlan().toString()


def test_a_text_is_cut_into_words_once_for_its_record(spark, tmp_path):
    sf = documents(spark, tmp_path, [(1, "en", "a", 9, "b a b"), (2, "es", "a", 4, None)])
    df = QUERIES["bank_kanji"](spark, sf)
    assert plan(df).count("regexp_extract_all") == 1
    assert {r.character: r.meanings for r in df.collect()}["d1"] == "a b"


def test_turns_are_dealt_over_more_tasks_than_cores(spark, tmp_path):
    df = spark.createDataFrame([(i, 0, "user", "a b") for i in range(20)], "conv_id bigint, turn bigint, role string, text string")
    df.coalesce(1).write.parquet(f"{tmp_path}/conversations.parquet")
    json = turns.turn_json(spark, str(tmp_path))
    assert f"RoundRobinPartitioning({4 * spark.sparkContext.defaultParallelism}" in json._jdf.queryExecution().executedPlan().toString() and json.count() == 20
