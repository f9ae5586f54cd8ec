"""Toxicity: counts and ratios by hand, held-out glosses, and the edges."""

import random

import numpy as np
import pytest

from lexigrain.llm import toxicity as T

RUDE = ["wretchling", "dunceling", "foulmouth", "vermino"]
SCHEMA = "key long, gloss string, toxic int, score string, weights int"


def plain(rng, n):
    return ["".join(rng.choices("abcdeilmnorstu", k=rng.randint(2, 8))) for _ in range(n)]


def gloss(rng, rude):
    words = plain(rng, rng.randint(3, 120))
    for _ in range(rng.randint(1, 3) if rude else 0):
        words.insert(rng.randrange(len(words) + 1), rng.choice([str.title, str.upper, str])(rng.choice(RUDE)) + rng.choice(["", ",", "!"]))
    return rng.choice([" ", "  ", "\n"]).join(words)


@pytest.fixture(scope="module")
def data(spark):
    rng = random.Random(2)
    rows = [(i, gloss(rng, i % 5 == 0), int(i % 5 == 0), "x", 1) for i in range(900)]
    return rows, spark.createDataFrame(rows, SCHEMA).repartition(4)


@pytest.fixture(scope="module")
def model(data):
    return T.train(data[1], data[1].where("key < 600").select("key", "toxic"))


def test_held_out_glosses_are_told(data, model):
    got = {r["key"]: r["score"] for r in T.score(data[1], model).collect()}
    held = [(got[i], toxic) for i, _, toxic, _, _ in data[0] if i >= 600]
    assert all(0 <= s <= 1 for s, _ in held)
    assert sum(s >= 0.7 for s, t in held if t) >= 0.9 * sum(t for _, t in held) and not any(s >= 0.7 for s, t in held if not t)


def test_ngrams_are_the_distinct_ones_of_each_text():
    texts = ["Ab  ba\tab", None, "", "x" * 5000, "ab ba ab", "İß 𠀋 ab"]
    found, starts = T.ngrams(texts)
    sets = [set(found[a:b]) for a, b in zip(starts[:-1], starts[1:])]
    assert all(len(s) == b - a for s, a, b in zip(sets, starts[:-1], starts[1:]))
    assert sets[0] == sets[4] and sets[1] == sets[2] == set()
    padded = " ab ba ab "
    assert len(sets[0]) == sum(len({padded[i:i + n] for i in range(len(padded) - n + 1)}) for n in T.LENGTHS)
    # x of any run: within, at the start, at the end.
    assert len(sets[3]) == 3 * len(T.LENGTHS)
    alone = [T.ngrams([t])[0] for t in texts]
    assert all(set(a) == s for a, s in zip(alone, sets))
    known = np.zeros(T.FEATURES, bool)
    known[list(sets[0])] = True
    some, at = T.ngrams(texts, known)
    assert [set(some[a:b]) for a, b in zip(at[:-1], at[1:])] == [s & sets[0] for s in sets]


def test_the_fit_goes_to_where_the_gradient_is_none(monkeypatch):
    monkeypatch.setattr(T, "ROUNDS", 3000)
    rng = np.random.default_rng(1)
    dense = (rng.random((200, 6)) < 0.4).astype(float)
    labels = (rng.random(200) < 1 / (1 + np.exp(1 - 3 * dense[:, 0] + 2 * dense[:, 3]))).astype(float)
    scale = rng.normal(size=6)
    weight = np.where(labels == 1, 2.0, 1.0)
    found = np.concatenate([np.flatnonzero(r) for r in dense]).astype(np.int32)
    base, w = T.fitted(found, np.concatenate([[0], np.cumsum(dense.sum(axis=1).astype(int))]), labels, weight, scale)
    p = 1 / (1 + np.exp(-(dense @ w + base)))
    gap = weight * (p - labels) / weight.sum()
    assert abs(gap.sum()) < 1e-5 and np.abs((dense.T @ gap) * scale + T.PENALTY * w / scale).max() < 1e-5


def test_scaling_is_the_log_ratio_of_shares(spark):
    rows = [(i, "abc" if i % 4 else "abc xyz", int(i % 4 == 0), "", 0) for i in range(40)]
    df = spark.createDataFrame(rows, SCHEMA)
    model = T.train(df, df)
    known = np.flatnonzero(model.known)
    assert set(known) == set(T.ngrams(["abc", "abc xyz"])[0])
    low, high = model.scores(["abc", "abc xyz"])
    assert low < 0.3 < 0.7 < high
    # "abc" is in every gloss of both labels: its ratio is about 0, so it adds next to nothing.
    word = T.ngrams(["abc"])[0]
    assert np.abs(model.weights[word[np.isin(word, T.ngrams(["abc xyz"])[0])]]).max() < 0.1


def test_odd_rows(spark, data, model):
    rows = [(None, None, None, "", 0), (1, "", None, "", 0), (1, "", None, "", 0), (2, RUDE[0] + " " + "lorem " * 100_000, None, "", 0), (3, " \t\n", 2, "", 0)]
    df = spark.createDataFrame(rows, SCHEMA)
    got = T.score(df, model).collect()
    base = 1 / (1 + np.exp(-model.base))
    assert len(got) == 5 and all(r["score"] == pytest.approx(base) for r in got if r["key"] in (None, 1, 3))
    assert T.score(df.where("false"), model).collect() == []
    untaught = T.train(df, df)
    assert {r["score"] for r in T.score(df, untaught).collect()} == {0.5}
    one = T.train(data[1], data[1].where("toxic = 1"))
    assert {round(r["score"], 6) for r in T.score(df, one).collect()} == {1.0}


def test_a_small_sample_still_learns(data):
    few = T.train(data[1], data[1].where("key < 600"), fitted_on=40)
    got = [r["score"] for r in T.score(data[1].where("key >= 600 AND toxic = 1"), few).collect()]
    assert np.mean(np.array(got) > 0.5) > 0.8
