"""Nearest neighbours and exact top-k, against brute force."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from lexigrain.llm import neighbours, shards, topk

SCHEMA = "key long, vector array<double>, rank string, score string"


def _vectors(n, seed=3):
    rng = np.random.default_rng(seed)
    return rng.standard_normal((n, 16))


def test_neighbours_reach_the_recall_and_the_exact_scores(spark):
    x = _vectors(600)
    rows = [(i, v.tolist(), "r", None) for i, v in enumerate(x)]
    df = spark.createDataFrame(rows, SCHEMA).repartition(3)
    found = neighbours.nearest(df, df.where("key % 50 = 0"), 5).collect()
    unit = x / np.linalg.norm(x, axis=1, keepdims=True)
    hits = 0
    for q in range(0, 600, 50):
        mine = sorted((r["rank"], r["key"], r["score"]) for r in found if r["query"] == q)
        assert [m[0] for m in mine] == [1, 2, 3, 4, 5]
        score = unit @ unit[q]
        score[q] = -9
        for _, key, s in mine:
            assert s == pytest.approx(score[key], abs=1e-12)
        hits += len({m[1] for m in mine} & set(np.argsort(-score)[:5].tolist()))
    assert hits >= 0.9 * 60


def test_neighbours_of_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 0.0]), (1, [2.0, 0.0]), (1, [2.0, 0.0]), (2, [0.0, 0.0]), (3, None), (4, [nan, 1.0]), (5, [inf, 1.0]),
            (6, [1.0, None]), (7, []), (None, [1.0, 0.0]), (8, [1.0, 0.0, 0.0]), (9, [1e-300, 1e-300])]
    df = spark.createDataFrame(rows, "key long, vector array<double>")
    found = neighbours.nearest(df, df.where("key IN (0, 1, 2, 3, 8)"), 5)
    by = {}
    for r in found.collect():
        by.setdefault(r["query"], []).append((r["rank"], r["key"]))
    assert sorted(by[0]) == [(1, 1), (2, 1), (3, 9)]
    assert sorted(by[1]) == [(1, 0), (1, 0), (2, 9), (2, 9)]  # the repeated query is answered twice
    assert set(by) == {0, 1}
    assert neighbours.nearest(df.where("false"), df.where("false"), 5).collect() == []
    assert neighbours.nearest(df, df.where("false"), 5).collect() == []


def test_neighbours_among_thousands_of_copies_are_those_of_the_smallest_keys(spark):
    x = np.random.default_rng(8).standard_normal((4000, 64))
    copies = np.random.default_rng(9).permutation(4000)[:2500]
    x[copies[:2000]], x[copies[2000:]] = x[copies[0]], x[copies[2000]]
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "key long, vector array<double>").coalesce(1)
    for group in (copies[:2000], copies[2000:]):
        asked = sorted(group.tolist())[::97]
        found = neighbours.nearest(df, df.where(df["key"].isin(asked)), 5).collect()
        mine = {q: [r["key"] for r in sorted(found, key=lambda r: r["rank"]) if r["query"] == q] for q in asked}
        assert mine == {q: [i for i in sorted(group.tolist()) if i != q][:5] for q in asked}


def test_chi_square():
    assert neighbours.chi_square_cdf(neighbours.chi_square_quantile(0.95, 12), 12) == pytest.approx(0.95)
    assert neighbours.chi_square_quantile(0.95, 2) == pytest.approx(5.991, abs=1e-3)


@pytest.mark.parametrize("rows_in_run", [4, 512])
def test_topk_equals_brute_force(spark, monkeypatch, rows_in_run):
    rng = random.Random(rows_in_run)
    rows = []
    for key in range(300):
        n = rng.choice([0, 3, 12, 12, 20])
        rows.append((key, rng.choices(range(24), k=n), [rng.randint(-40, 40) for _ in range(n)], "t"))
    df = spark.createDataFrame(rows, "key long, terms array<int>, scores array<long>, rank string").repartition(2)
    found = topk.top_scores(df, df.where("key % 20 = 0"), 10)
    mine = sorted((r["query"], r["rank"], r["key"], r["score"]) for r in found.collect())

    def vector(terms, scores):
        out = np.zeros(24, np.int64)
        np.add.at(out, np.array(terms, int), np.array(scores, np.int64))
        return out

    x = np.array([vector(t, s) for _, t, s, _ in rows])
    wanted = []
    for q in range(0, 300, 20):
        best = sorted((-int(x[k] @ x[q]), k) for k in range(300) if k != q)[:10]
        wanted += [(q, i + 1, k, -s) for i, (s, k) in enumerate(best)]
    assert mine == sorted(wanted)


def test_topk_of_odd_rows(spark):
    rows = [(0, [1, 1], [2, 3]), (1, [1], [4]), (1, [1], [4]), (2, None, [1]), (3, [1, 2], [1]), (4, [1], [None]), (None, [1], [9]), (5, [], [])]
    df = spark.createDataFrame(rows, "key long, terms array<int>, scores array<long>")
    found = topk.top_scores(df, df.where("key = 0"), 10)
    assert sorted((r["rank"], r["key"], r["score"]) for r in found.collect()) == [(1, 1, 20), (2, 1, 20), (3, 5, 0)]
    assert topk.top_scores(df.where("false"), df, 10).collect() == []


def test_shards_are_bounded(spark):
    df = spark.range(1000).repartition(1)
    sizes = [int.from_bytes(r["blob"][-3:-1], "little") for r in shards.cut(df, 300, lambda c: len(c["id"])).collect()]
    assert len(sizes) == 4


@pytest.mark.parametrize("lane_shards", [1, 40])
def test_floors_carried_between_shards_lose_nothing(spark, monkeypatch, lane_shards):
    monkeypatch.setattr(shards, "LANE_SHARDS", lane_shards)
    rng = np.random.default_rng(lane_shards)
    # Few values and many copies, so most of the k-th scores are ties between shards.
    x = rng.integers(-2, 3, (500, 3))
    x[::7] = x[0]
    keys = rng.permutation(500)
    df = spark.createDataFrame([(int(k), v.tolist()) for k, v in zip(keys, x, strict=True)], "key long, scores array<long>")
    df = df.select("key", F.expr("array(0, 1, 2)").alias("terms"), "scores")
    by_key = x[np.argsort(keys)]
    for read in (df.repartition(5), df.coalesce(1)):
        rows = read.select("key", F.col("terms").cast("array<bigint>").alias("terms"), "scores")
        build, answer = [], []
        monkeypatch.setattr(topk, "search", lambda r, q, b, a, *rest: (build.append(b), answer.append(a)))
        topk.top_scores(rows, rows, 6)
        found = shards.search(rows, rows.where("key % 9 = 0"), build[0], answer[0], 6, "bigint", shard_rows=30, block_queries=20).collect()
        mine = sorted((r["query"], r["rank"], r["key"], r["score"]) for r in found)
        wanted = []
        for q in range(0, 500, 9):
            best = sorted((-int(by_key[i] @ by_key[q]), i) for i in range(500) if i != q)[:6]
            wanted += [(q, n + 1, i, -v) for n, (v, i) in enumerate(best)]
        assert mine == wanted
