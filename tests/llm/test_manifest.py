"""The Merkle manifest of a source lock against a tree built by hand."""

import hashlib
import random

import pytest
from pyspark.sql import functions as F

from lexigrain.llm import manifest

SCHEMA = "path string, byte_count long, sha256 string, source string, top string, n long, low long"


def digest(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf(*values):
    return digest(*["-" if v is None else f"{len(str(v).encode())}:{v}" for v in values])


def tree(leaves):
    """The top of a list of digests, and for each of them its steps as (before, after)."""
    steps, level, groups = [[] for _ in leaves], list(leaves), [[i] for i in range(len(leaves))]
    while len(level) > 1:
        runs = [range(i, min(i + 8, len(level))) for i in range(0, len(level), 8)]
        for run in runs:
            for at in run:
                step = ("".join(level[j] for j in run if j < at), "".join(level[j] for j in run if j > at))
                for i in groups[at]:
                    steps[i].append(step)
        level, groups = [digest(*[level[j] for j in run]) for run in runs], [[i for j in run for i in groups[j]] for run in runs]
    return level[0], steps


def by_hand(rows):
    sources = {}
    for r in rows:
        sources.setdefault(r[3], []).append(r)
    order = sorted(sources, key=lambda s: (s is not None, (s or "").encode()))
    tops, steps = {}, {}
    for s in order:
        held = sorted(sources[s], key=lambda r: (r[0] is not None, (r[0] or "").encode(), leaf(*r[:3])))
        tops[s], below = tree([leaf(*r[:3]) for r in held])
        steps[s] = list(zip(held, below))
    root, above = tree([tops[s] for s in order])
    out = []
    for s, up in zip(order, above):
        for r, below in steps[s]:
            proof = digest(*[a + b for a, b in below + up])
            out.append((r[0], s, leaf(*r[:3]), tops[s], root, [tuple(x) for x in below + up], proof, root, True))
    return out


def entry(i, source, rng):
    return (f"{rng.random()}/{i:05x}.svg", rng.randrange(1 << 40), digest(str(i)), source, "clash", 1, 2)


@pytest.mark.parametrize("sizes", [{"strokes": 1}, {"strokes": 9}, {"strokes": 70, None: 8, "": 1, "ranks": 513, "é": 64, "z": 65}])
def test_proofs_are_those_of_a_tree_built_by_hand(spark, sizes):
    rng = random.Random(3)
    rows = [entry(i, s, rng) for s, n in sizes.items() for i in range(n)]
    df = spark.createDataFrame(rows, SCHEMA).repartition(5)
    got = manifest.prove(df).collect()
    plain = lambda r: (*r[:5], [tuple(s) for s in r[5]], *r[6:])
    assert sorted(map(plain, got), key=repr) == sorted(by_hand(rows), key=repr)


def test_more_sources_than_one_run(spark):
    rng = random.Random(5)
    rows = [entry(i, f"source{s:03}", rng) for s in range(70) for i in range(s % 3 + 1)]
    got = manifest.prove(spark.createDataFrame(rows, SCHEMA)).select("path", "root", "proof_sha256", "verified").collect()
    assert sorted(map(tuple, got)) == sorted((r[0], r[4], r[6], True) for r in by_hand(rows))


def test_nulls_ties_and_repeated_rows(spark):
    long = "x" * 300_000
    rows = [(None, None, None, None), (None, 1, "a", None), ("p", 1, "", "s"), ("p", 1, "", "s"), ("p", None, "a", "s"), ("q", 0, long, "s")]
    rows = [(*r, "clash", 1, 2) for r in rows]
    got = manifest.prove(spark.createDataFrame(rows, SCHEMA)).drop("steps").collect()
    assert sorted(map(tuple, got), key=repr) == sorted(((*r[:5], *r[6:]) for r in by_hand(rows)), key=repr)
    assert manifest.prove(spark.createDataFrame([], SCHEMA)).collect() == []


def test_what_was_tampered_with_does_not_verify(spark):
    rng = random.Random(7)
    rows = [entry(i, s, rng) for s in ("a", "b") for i in range(80)]
    df = spark.createDataFrame(rows, SCHEMA)
    changed = F.col("byte_count") % 3 == 0
    found = ["path", F.when(changed, F.col("byte_count") + 1).otherwise(F.col("byte_count")), "sha256"]
    hand = {r[0]: r for r in by_hand(rows)}
    for r in manifest.prove(df, found=found).collect():
        size = next(x[1] for x in rows if x[0] == r["path"])
        now = leaf(r["path"], size + (size % 3 == 0), next(x[2] for x in rows if x[0] == r["path"]))
        for before, after in hand[r["path"]][5]:
            now = digest(before, now, after)
        assert r["folded_root"] == now and r["verified"] == (size % 3 != 0) and r["root"] == hand[r["path"]][4]


def test_keys_that_are_numbers_ascend_as_numbers(spark):
    df = spark.range(20).selectExpr("id", "'s' source", "'é' text")
    got = {r["id"]: r for r in manifest.prove(df, ["id", "text"], key="id").collect()}
    leaves = [leaf(i, "é") for i in range(20)]
    top, steps = tree(leaves)
    assert all(got[i]["subroot"] == top and [tuple(s) for s in got[i]["steps"]] == steps[i] for i in range(20))
