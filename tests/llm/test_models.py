"""Mixing by fitted rates and the secret scan, on small tables with known answers."""

import random

import pytest

from lexigrain.llm import mixing, queries, secret_scan


@pytest.fixture(scope="module")
def mixed(spark):
    rng = random.Random(4)
    stock = {"on": "water river lake sea".split(), "kun": "fire smoke ash coal".split()}
    plain = "the a of in on and to with".split()
    rows = [(i, " ".join(rng.choices(stock[d], k=4) + rng.choices(plain, k=rng.randint(5, 60)))) for i in range(240) for d in [("on", "kun")[i % 2]]]
    odd = [(1000, None), (1001, ""), (None, "water fire"), (0, rows[0][1])]
    df = spark.createDataFrame([(k, g, 1, "x") for k, g in rows + odd], "key long, gloss string, rate int, domain string")
    labels = spark.createDataFrame([(i, ("on", "kun")[i % 2]) for i in range(0, 200)] + [(5, None), (None, "on"), (99999, "kun")], "key long, domain string")
    targets = {"on": 4000.0, "kun": 1000.0}
    return df, labels, targets, mixing.mix(df, labels, targets).collect()


def test_posteriors_tell_the_domains(mixed):
    rows = mixed[3]
    assert len(rows) == 244
    told = [max(r["posterior"], key=r["posterior"].get) == ("on", "kun")[r["key"] % 2] for r in rows if r["key"] is not None and 200 <= r["key"] < 240]
    assert sum(told) >= 0.95 * len(told)
    assert all(abs(sum(r["posterior"].values()) - 1) < 1e-6 and r["rate"] >= 0 for r in rows)


def test_expected_totals_meet_the_targets(mixed):
    _, _, targets, rows = mixed
    for d, wanted in targets.items():
        assert sum(r["n_tokens"] * r["rate"] * r["posterior"][d] for r in rows) == pytest.approx(wanted, rel=0.02)
    assert all(abs(r["copies"] - r["rate"]) <= 1.01 for r in rows)
    same = [r["copies"] for r in rows if r["key"] == 0]
    assert len(same) == 2 and same[0] == same[1]
    assert [r["n_tokens"] for r in rows if r["key"] in (1000, 1001)] == [0, 0]


def test_a_target_of_nothing_drops_the_domain(mixed):
    df, labels, _, _ = mixed
    rows = mixing.mix(df, labels, {"on": 1.0, "kun": 0.0}, relative=True).collect()
    assert all(r["copies"] == 0 for r in rows if r["posterior"]["kun"] > 0.99)
    assert all(r["copies"] >= 1 for r in rows if r["posterior"]["on"] > 0.999)


def test_mixing_without_labels_or_rows(mixed):
    df, labels, targets, _ = mixed
    for none in (labels.where("false"), labels.where("domain IS NULL")):
        unknown = mixing.mix(df, none, targets).collect()
        assert len(unknown) == 244 and {(r["posterior"], r["rate"], r["copies"]) for r in unknown} == {(None, 1.0, 1)}
    assert mixing.mix(df.where("false"), labels, targets).collect() == []
    one = mixing.mix(df, labels.where("domain = 'on'"), {"on": 2.0}, relative=True).collect()
    assert {round(r["rate"], 6) for r in one} == {2.0}


def test_the_forest_keeps_secrets_and_drops_the_rest(spark):
    rng = random.Random(9)
    key = lambda: "".join(rng.choices("0123456789abcdef", k=40))
    words = ["internationalization", "src/main/java/lexicon/Reading.java", "counterrevolutionary", "2026-08-16T10:00:00.000", "https://example.org/a/b/c"]
    files, labels, secrets = [], [], {}
    for i in range(120):
        path = f"conf/app{i}.txt" if i % 2 else f"docs/page{i}.md"
        if i % 2:
            secrets[path] = key()
            text = f'the token = "{secrets[path]}" is here and {rng.choice(words)} too'
            labels += [(path, 3, True), (path, 7, False)]
        else:
            text = f"see {rng.choice(words)} and {rng.choice(words)} for more"
            labels += [(path, 1, False), (path, 3, False)]
        files.append((path, text, 0.1))
    files += [(None, None, 0.2), ("x", "", 0.3), ("conf/app1.txt", files[1][1], 0.4)]
    df = spark.createDataFrame(files, "path string, content string, score double")
    marks = spark.createDataFrame(labels, "path string, at int, secret boolean")
    dictionary = spark.createDataFrame([(w,) for w in ["internationalization", "counterrevolutionary", "main", "java", None, "the"]], "word string")
    train = marks.where("path NOT LIKE '%9.txt'")
    out = secret_scan.scan(df, dictionary, train).collect()
    assert {(r["path"], r["candidate"]) for r in out} == set(secrets.items())
    assert sum(r["path"] == "conf/app1.txt" for r in out) == 2 and all(0.5 <= r["score"] <= 1 for r in out)
    untold = secret_scan.scan(df, dictionary, marks.where("secret")).collect()
    assert {r["score"] for r in untold} == {None} and len(untold) > len(out)
    assert secret_scan.scan(df.where("false"), dictionary, marks).collect() == []


def test_every_secret_of_a_word_is_found(spark):
    rng = random.Random(19)
    key = lambda: "".join(rng.choices("0123456789abcdef", k=40))
    path = lambda: "/usr/local/share/" + "".join(rng.choices("aeilnorst", k=6))
    files, labels, secrets = [], [], set()
    for i in range(80):
        a, b, name = key(), key(), f"conf/app{i}.json"
        text = '{"path":"%s","token":"%s","home":"%s","secret":"%s"}' % (path(), a, path(), b)
        text = text if i % 2 else f"path={path()}&token={a}&home={path()}&secret={b}"
        files.append((name, text))
        secrets |= {(name, 0, 1, a), (name, 0, 3, b)}
        labels += [(name, 0, part, part % 2 == 1) for part in range(4)] if i < 60 else []
    df = spark.createDataFrame(files, "path string, content string")
    marks = spark.createDataFrame(labels, "path string, at int, part int, secret boolean")
    words = spark.createDataFrame([("local",), ("share",), ("usr",)], "word string")
    found = secret_scan.scan(df, words, marks).collect()
    assert {(r["path"], r["at"], r["part"], r["candidate"]) for r in found} == secrets and len(found) == len(secrets)


def test_candidates_of_a_word_and_their_leads(spark):
    line = ",".join(f'"name{i}":"{"ab12" * 5}"' for i in range(3000))
    texts = ["x token=0123456789abcdef0123== y", "password=hunter2hunter2", 'api_key : "AAAABBBBCCCCDDDD"', line]
    df = spark.createDataFrame([(str(i), t) for i, t in enumerate(texts)], "path string, content string")
    rows = secret_scan.places(df).collect()
    short = {r["path"]: (r["at"], r["part"], r["candidate"], r["lead"]) for r in rows if r["path"] != "3"}
    assert short == {
        "0": (1, 0, "0123456789abcdef0123==", " x token="), "1": (0, 0, "password=hunter2hunter2", "  "),
        "2": (2, 0, "AAAABBBBCCCCDDDD", 'api_key : "'),
    }
    many = sorted((r["part"], r["lead"]) for r in rows if r["path"] == "3")
    assert [m[0] for m in many] == list(range(3000)) and many[2999][1] == '"name2999":"'


def _secrets(rng):
    some = lambda chars, n: "".join(rng.choices(chars, k=n))
    hexa, b64 = "0123456789abcdef", "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789"
    return [
        ('token = "%s"', some(hexa, 40)), ("token = %s", some(hexa, 40)), ("TOKEN = '%s'", some(hexa, 40).upper()),
        ("api_key=%s", some(hexa, 32)), ("secret: %s", some(b64, 44)), ("password=%s", some(b64, 24)), ("found %s", "AKIA" + some(b64[:26] + "234567", 16)),
    ]


def test_the_query_finds_secrets_of_every_shape(spark, tmp_path):
    rng = random.Random(21)
    stock = ["internationalization", "src/main/java/lexicon/Reading", "counterrevolutionary", "4785380592391139", "www.example.org/start/page"]
    docs, planted = [], {}
    for i in range(280):
        shape, value = _secrets(rng)[i % 7]
        docs.append((i, f"see {rng.choice(stock)} then {shape % value} and {rng.choice(stock)} too", "en", "web"))
        planted[i] = value
    # A document without an id is scanned like the others, also where its source is a number or missing.
    docs += [(None, docs[0][1], "en", "web"), (None, docs[7][1], "en", "17"), (3, None, None, None), (None, None, None, None)]
    spark.createDataFrame(docs, "doc_id long, text string, lang string, source string").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(i,) for i in range(210)], "doc_id long").write.parquet(f"{tmp_path}/labels.parquet")
    found = {}
    for r in queries.op3_secret_scan(spark, str(tmp_path)).collect():
        found.setdefault(r["doc_id"], []).append(r["candidate"])
    assert sorted(found.pop(None)) == sorted([planted[0], planted[7]])
    assert found == {i: [v] for i, v in planted.items()}


def test_what_the_shape_of_a_finding_tells(spark):
    rng = random.Random(22)
    rows = [(shape % value, True) for shape, value in _secrets(rng)]
    rows += [("see internationalization", False), ("path=/usr/local/share/x", False), ("token = internationalization", None),
             ("commit 24be64439e3e49cf46b2d7c90f3602a3d0b907ff", None), ("19@mail5.example.com", False)]
    df = spark.createDataFrame([(str(i), t) for i, (t, _) in enumerate(rows)], "path string, content string")
    got = secret_scan.places(df).select("path", secret_scan.told().alias("secret")).collect()
    assert {int(r["path"]): r["secret"] for r in got} == {i: s for i, (_, s) in enumerate(rows)}


@pytest.mark.parametrize("times", [1, 20])
def test_common_words_are_a_share_of_distinct_texts(spark, times):
    rows = [(f"the text {'abcdefghij'[i % 10] * 3} {'often' if i % 10 == 0 else ''} own{chr(97 + i // 26)}{chr(97 + i % 26)}",) for i in range(30 * times)]
    rows += [("the copied secret",)] * 40
    words = secret_scan.common_words(spark.createDataFrame(rows, "text string"), 0.08).collect()
    assert {"the", "text", "often"} <= {r["word"] for r in words}
    assert not {"copied", "secret"} & {r["word"] for r in words} and not any(r["word"].startswith("own") for r in words)


def test_rates_are_those_of_whole_gradient_steps(mixed):
    import numpy as np

    _, _, targets, rows = mixed
    p = np.array([[r["posterior"][d] for d in sorted(targets)] for r in rows])
    n = np.array([r["n_tokens"] for r in rows], float)
    wanted = np.array([targets[d] for d in sorted(targets)])
    inverse = np.linalg.pinv((p * n[:, None]).T @ p, rcond=1e-9, hermitian=True)
    rate = np.ones(len(rows))
    for _ in range(2000):
        rate = np.maximum(0.0, rate - p @ (inverse @ ((rate * n) @ p - wanted)))
    assert np.abs(np.array([r["rate"] for r in rows]) - rate).max() < 0.01 * rate.max() + 0.01


def test_traits_of_odd_glosses(spark):
    from pyspark.sql import functions as F

    texts = ["Ab\tAB\x0bab, \"cd\"\n12%", "", None, "É ñ " * 50_000, "｜ … a"]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, gloss string")
    rows = df.select("i", mixing.words("gloss").alias("w")).select("i", "w").join(df, "i").select("i", "w", mixing.traits("gloss", "w").alias("t"))
    got = {r["i"]: (r["w"], r["t"]) for r in rows.collect()}
    assert got[0][0] == ["ab", "ab", "ab,", '"cd"', "12%"]
    assert got[0][1] == ["ab", "ab", "cd", "12", f"#marks{10 * 4 // 18}", f"#capitals{10 * 3 // 18}", f"#digits{10 * 2 // 18}"]
    assert got[1] == ([], ["#marks0", "#capitals0", "#digits0"]) and got[2] == ([], [])
    assert len(got[3][0]) == 100_000 and got[3][1] == ["é", "ñ", "#marks0", "#capitals2", "#digits0"]
    assert df.select(F.max("i")).first()[0] == 4
