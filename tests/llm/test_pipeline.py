"""The stages of the pipeline on small documents with planted cases."""

import random

import corpus_pipeline as C
import pytest

TOXIC = "scum trash moron"
PLAIN = {
    "en": "the of and to in is that it for was house water small great river stone morning letter garden window".split(),
    "de": "der die und in den von zu das mit sich haus wasser klein fluss stein morgen brief garten fenster".split(),
}


@pytest.fixture(scope="module")
def planted(spark, tmp_path_factory):
    rng = random.Random(8)
    rows = []
    for i in range(160):
        lang = ("en", "de")[i % 2]
        lines = [" ".join(rng.choices(PLAIN[lang], k=14)) for _ in range(4)]
        if i % 8 == 3:
            lines[1] += " " + TOXIC
        rows.append([i, "\n".join(lines), lang, f"s{i % 3}", 0, "x"])
    text = rows[0][1]
    rows += [
        [200, text, "en", "s0", 0, "copy"],
        [201, text.replace(text.split()[20], "changed", 1).replace("\n", " "), "en", "s0", 0, "near copy"],
        [202, "new words stand here alone\n" + text.split("\n")[2], "en", "s1", 0, "passage"],
        [203, "12 34 -- !!", "en", "s1", 0, "no letters"], [204, None, None, None, None, None], [205, "", "en", "s1", 0, ""],
        [None, "the river of stone and the water was in it for that", None, None, None, "no id"],
        [0, text, "en", "s0", 0, "x"],
    ]
    sf = str(tmp_path_factory.mktemp("tables"))
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, removed string")
    docs.write.parquet(f"{sf}/documents.parquet")
    labels = [(i, 1, int(i % 8 == 3)) for i in range(0, 160)]
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{sf}/labels.parquet")
    out, docs = {}, spark.read.parquet(f"{sf}/documents.parquet")
    for name, stage in C.STAGES:
        docs = C.staged(stage(spark, docs, sf), name)
        out[name] = docs
    return out, sf, rows


def test_stages_keep_the_columns_of_documents(planted):
    out = planted[0]
    for name in list(out)[:-1]:
        assert out[name].columns == ["doc_id", "text", "lang", "source", "n_chars", "removed"], name


def test_each_stage_catches_its_cases_and_leaves_the_rest(planted):
    out, _, rows = planted
    ids = {name: [r["doc_id"] for r in df.collect()] for name, df in out.items()}
    assert set(ids["language_id"]) == set(range(160)) | {200, 201, 202, None}
    after = {r["doc_id"]: r for r in out["line_dedup"].collect()}
    assert 200 not in after and after[202]["text"] == "new words stand here alone" and after[0]["text"] == rows[0][1]
    assert after[202]["n_chars"] == len("new words stand here alone") and after[200 - 41]["removed"] == "x"
    assert 201 not in ids["near_duplicates"] and sorted(x for x in ids["near_duplicates"] if x is not None and x < 160) == list(range(160))
    toxic = {i for i in range(160) if i % 8 == 3}
    assert not toxic & set(ids["mixing_weights"]) and set(range(160)) - toxic <= set(ids["mixing_weights"])
    assert None in ids["near_duplicates"]
    for r in out["packing"].collect():
        assert r["length"] & (r["length"] - 1) == 0 and r["offset"] == 0


def test_run_applies_all_stages(spark, planted):
    out, sf, _ = planted
    assert C.run(spark, sf).drop("sequence_id").exceptAll(out["packing"].drop("sequence_id")).isEmpty()


def test_empty_documents(spark, planted, tmp_path):
    _, sf, _ = planted
    spark.read.parquet(f"{sf}/documents.parquet").where("false").write.parquet(f"{tmp_path}/documents.parquet")
    spark.read.parquet(f"{sf}/labels.parquet").where("false").write.parquet(f"{tmp_path}/labels.parquet")
    assert C.run(spark, str(tmp_path)).collect() == []


def test_decisions_on_a_row_meet_no_other_of_its_id(spark, planted):
    _, sf, rows = planted
    rng = random.Random(12)
    text = lambda extra="": "\n".join(" ".join(rng.choices(PLAIN["en"], k=14)) + extra for _ in range(4))
    plain, toxic = [text() for _ in range(6)], [text(f" {TOXIC}") for _ in range(6)]
    one, other = "some words that are new\n" + rows[0][1].split("\n")[1], text()
    added = [[None, t, "en", None, 0, "x"] for t in plain + toxic] + [[300, t, "en", "s0", 0, "x"] for t in (one, other)]
    docs = spark.createDataFrame(rows[:160] + added, spark.read.parquet(f"{sf}/documents.parquet").schema)
    mixed = [r["text"] for r in C.mixing_weights(spark, docs, sf).collect() if r["doc_id"] is None]
    assert not set(mixed) & set(toxic) and set(mixed) <= set(plain) and all(mixed.count(t) <= 2 for t in plain) and mixed
    lines = [r["text"] for r in C.repeated_lines(spark, docs, sf).collect() if r["doc_id"] == 300]
    assert sorted(lines) == sorted(["some words that are new", other])
    near = C.near_duplicates(spark, docs, sf).collect()
    assert sorted(r["text"] for r in near if r["doc_id"] == 300) == sorted([one, other])
    assert sorted(r["text"] for r in near if r["doc_id"] is None) == sorted(plain + toxic)
