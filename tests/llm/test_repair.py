"""Conversation repair against a search through all edits."""

import hashlib
import itertools
import random
import re

import pytest

from lexigrain.llm import queries, repair

NEXT = {("", "s"): "s", ("", "u"): "u", ("s", "u"): "u", ("a", "u"): "u", ("u", "a"): "a"}
SCHEMA = "thread long, position long, role string, text string, ord int, audit string"


def marked(rows):
    """Rows in order with their faults, as the docstring says."""
    rows = sorted(rows, key=lambda r: (r[1] is not None, r[1] or 0, r[2], r[3]))
    out, seen = [], set()
    for _, position, role, text in rows:
        solid = re.sub(r"[\x20\x09-\x0D]", "", text)
        fault = "blank" if not solid else "duplicate" if (role, text) in seen else "truncated" if solid[-1] not in ".!?" else None
        seen.add((role, text))
        out.append((position, role, text, fault))
    return out


def searched(rows, gap=2):
    """Cost, audit and mended rows by trying every edit, up to ``gap`` insertions in a row; all ways are kept that may be least."""
    ways = {"": {("", 0): []}}
    for row in [*rows, None]:
        for _ in range(gap):
            for (state, name) in [("u", "user"), ("a", "assistant")]:
                for s in list(ways):
                    if NEXT.get((s, state)):
                        for (audit, cost), kept in list(ways[s].items()):
                            ways.setdefault(state, {}).setdefault((audit + "I", cost + 3), [*kept, (name, "")])
        if row is None:
            break
        _, role, text, fault = row
        after = {}
        for s, held in ways.items():
            for (audit, cost), kept in held.items():
                after.setdefault(s, {})[audit + "D", cost + 4] = kept
                if fault in ("blank", "duplicate"):
                    continue
                more = 3 if fault else 0
                if NEXT.get((s, role[:1])):
                    after.setdefault(role[:1], {})[audit + "K", cost + more] = [*kept, (role, text)]
                for state, name in (("u", "user"), ("a", "assistant")):
                    if NEXT.get((s, state)):
                        after.setdefault(state, {})[audit + "R", cost + 3 + more] = [*kept, (name, text)]
        best = {s: min(c for _, c in held) for s, held in after.items()}
        # Two insertions turn any state into any other or lose nothing, so what costs far more is never least.
        ways = {s: {k: v for k, v in held.items() if k[1] <= min(best.values()) + 12} for s, held in after.items()}
    ends = [(cost, audit, kept) for s in ("", "a") for (audit, cost), kept in ways.get(s, {}).items()]
    return min(ends, key=lambda e: e[:2])


def drawn(rng, thread, n):
    texts = ["Yes.", "no", "what?", "", "  ", "Fine!  ", "cut off,", "Yes.", "…"]
    roles = ["user", "assistant", "user", "assistant", "system", "tool", "", " "]
    return [(thread, rng.choice([None, *range(n)]), rng.choice(roles), rng.choice(texts)) for _ in range(n)]


@pytest.fixture(scope="module")
def threads():
    rng = random.Random(8)
    out = {t: drawn(rng, t, rng.randint(1, 7)) for t in range(150)}
    for t in range(150, 170):  # nearly right ones
        out[t] = [(t, 0, "system", "Be kind.")] * (t % 2) + [(t, i + 1, ("user", "assistant")[i % 2], f"Text {i}.") for i in range(rng.randint(1, 7))]
    out[None] = [(None, 1, "user", "Hi."), (None, 2, "assistant", "Hello")]
    return out


@pytest.mark.parametrize("block,run", [(repair.BLOCK, repair.JOINED), (2, 2)])
def test_repair_is_the_least_of_all_edits(spark, threads, monkeypatch, block, run):
    monkeypatch.setattr(repair, "BLOCK", block)
    monkeypatch.setattr(repair, "JOINED", run)
    rows = [(*r, 1, "clash") for rows in threads.values() for r in rows]
    found, mended = repair.repair(spark.createDataFrame(rows, SCHEMA).repartition(3))
    left = {}
    for r in mended.orderBy("place").collect():
        left.setdefault(r["thread"], []).append((r["role"], r["text"]))
    digests = {r["thread"]: r["sha256"] for r in repair.conversation_digests(mended).collect()}
    got = found.collect()
    assert {r["thread"] for r in got} == set(threads) and len(got) == len(threads)
    for r in got:
        order = marked(threads[r["thread"]])
        cost, audit, kept = searched(order)
        assert (r["cost"], r["audit"]) == (cost, audit), order
        assert left.get(r["thread"], []) == kept
        told = "\n".join(f"{role}:{text}" for role, text in kept)
        assert digests.get(r["thread"], hashlib.sha256(b"").hexdigest()) == hashlib.sha256(told.encode()).hexdigest()
        assert [r[f] for f in ("blank", "duplicate", "truncated")] == [sum(o[3] == f for o in order) for f in ("blank", "duplicate", "truncated")]
        initials = [o[1][:1] for o in order]
        assert r["illegal"] == sum(a + b not in ("su", "ua", "au") for a, b in itertools.pairwise(initials))
        at = {o[0] for o in order} - {None}
        assert r["gaps"] == (max(at) - min(at) + 1 - len(at) if at else 0)


def test_a_very_long_thread_is_mended_in_blocks(spark):
    n = 3000
    rows = [(1, i, ("user", "assistant")[i % 2], f"Text {i}.") for i in range(n) if i % 100 != 50]
    long = spark.createDataFrame([(*r, 0, "") for r in rows], SCHEMA)
    found, mended = repair.repair(long)
    row = found.first()
    assert row["cost"] == 3 * 30 and len(row["audit"]) == n and row["gaps"] == 30 and row["illegal"] == 30
    assert row["audit"] == "".join("I" if i % 100 == 50 else "K" for i in range(n))
    assert mended.count() == n


def test_nothing_and_nulls(spark):
    empty = spark.createDataFrame([], SCHEMA)
    found, mended = repair.repair(empty)
    assert found.collect() == [] and mended.collect() == [] and repair.conversation_digests(mended).collect() == []
    found, mended = repair.repair(spark.createDataFrame([(1, None, None, None, 0, ""), (2, None, None, "Text.", 0, ""), (2, 5, "assistant", "x" * 200_000 + ".", 0, "")], SCHEMA))
    assert sorted((r["thread"], r["gaps"], r["blank"], r["cost"], r["audit"]) for r in found.collect()) == [(1, 0, 1, 4, "D"), (2, 0, 0, 3, "RK")]
    assert sorted((r["place"], r["role"], len(r["text"])) for r in mended.collect()) == [(0, "user", 5), (1, "assistant", 200_001)]


def test_the_query_answers_for_conversations_without_any_message_left(spark, tmp_path):
    import zlib

    gone = next(i for i in range(1000) if zlib.crc32(f"{i}:0".encode()) % 20 == 0)
    rows = [(gone, 0, "user", "Hi."), (None, None, None, None)]
    spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").write.parquet(f"{tmp_path}/conversations.parquet")
    got = {r["conv_id"]: r for r in queries.op12_repair(spark, str(tmp_path)).collect()}
    assert set(got) == {gone, None}
    empty = got[gone]
    assert (empty["cost"], empty["audit"], empty["repaired_sha256"]) == (0, "", hashlib.sha256(b"").hexdigest())
