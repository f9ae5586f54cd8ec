"""Conversation structure repair: the cheapest edits that give a conversation a legal order of roles.

Every way to edit a conversation is a path in a graph without cycles: from a place between two
messages and a state of the role grammar, one edit leads to the next. A path's weight is one
integer. Its high digits are the cost. Its low digits spell the edits, first edit first, one
digit each in a fixed width, padded with zeros at the end, so that among equal costs the smaller
integer is the alphabetically smaller audit. The smallest weight therefore decides everything.

Digits are counted from a node's own place: putting an edit in front moves them one place down,
which keeps their order. So the smallest weight of a node does not depend on how many edits came
before it, and one integer a node is enough.

A long conversation is cut into blocks. For a block each pair of states before and after it has
a smallest weight; blocks are joined like factors of a matrix product, neighbours first. Paths
of equal cost through the same messages between the same states never spell each other's
beginning, as the longer one would insert, and so cost, more; so the smallest part is always
part of the smallest whole.
"""

from __future__ import annotations

import functools
import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..operators.ranking import full_rank
from ..session import staged

#: What an edit costs; an undeleted message that was cut off costs something besides.
COSTS = {"D": 4, "I": 3, "K": 0, "R": 3}
CUT_OFF = 3
#: Bits of a digit, and the digit of each edit in alphabetical order; 0 is no edit.
BITS = 3
DIGITS = {"D": 1, "I": 2, "K": 3, "R": 4}
LETTERS = " DIKR"
#: States of the grammar ``(s?(ua)+)?`` of role initials, and where an initial leads.
START, SYSTEM, USER, ASSISTANT = range(4)
STATES = range(4)
STEPS = {"s": {START: SYSTEM}, "u": {START: USER, SYSTEM: USER, ASSISTANT: USER}, "a": {USER: ASSISTANT}}
ENDS = (START, ASSISTANT)
NAMES = {"u": "user", "a": "assistant"}
#: Messages of a block, and blocks that are joined at once.
BLOCK = 128
JOINED = 64

Weight = tuple[int, int, int]  # cost, digits, number of digits


def _before(letter: str, cost: int, rest: Weight) -> Weight:
    return cost + rest[0], DIGITS[letter] << BITS * rest[2] | rest[1], rest[2] + 1


def _least(weights: list[Weight]) -> Weight | None:
    """The smallest of some weights as integers: cost, then digits padded with zeros at the end to one width."""
    width = max((n for _, _, n in weights), default=0)
    return min(weights, key=lambda w: w[0] << BITS * (width + 1) | w[1] << BITS * (width - w[2]), default=None)


def _join(first: Weight, then: Weight) -> Weight:
    return first[0] + then[0], first[1] << BITS * then[2] | then[1], first[2] + then[2]


def _inserted(rest: dict[int, Weight | None]) -> dict[int, Weight | None]:
    """Best weights of the states before a gap, from those after it; two insertions in one gap are never cheapest."""
    out = {}
    for s in STATES:
        ways = [rest[s]] + [_before("I", COSTS["I"], rest[STEPS[r][s]]) for r in NAMES if s in STEPS[r] and rest[STEPS[r][s]]]
        out[s] = _least([w for w in ways if w])
    return out


@functools.lru_cache(maxsize=65_536)
def block_weights(codes: str) -> tuple[tuple[Weight | None, ...], ...]:
    """``[state before][state after]`` the smallest weight of edits to the messages, a gap before each of them.

    ``codes``  two characters a message: its role's initial, and ``x`` if it has to go, ``c`` if it was cut off
    """
    out = []
    for end in STATES:
        rest: dict[int, Weight | None] = {s: (0, 0, 0) if s == end else None for s in STATES}
        for i in range(len(codes) - 2, -1, -2):
            initial, fault = codes[i], codes[i + 1]
            more = CUT_OFF if fault == "c" else 0
            now = {}
            for s in STATES:
                ways = [_before("D", COSTS["D"], rest[s])] if rest[s] else []
                if fault != "x":
                    to = STEPS.get(initial, {}).get(s)
                    if to is not None and rest[to]:
                        ways.append(_before("K", COSTS["K"] + more, rest[to]))
                    ways += [_before("R", COSTS["R"] + more, rest[STEPS[r][s]]) for r in NAMES if s in STEPS[r] and rest[STEPS[r][s]]]
                now[s] = _least(ways)
            rest = _inserted(now)
        out.append(rest)
    return tuple(tuple(out[end][s] for end in STATES) for s in STATES)


def joined(blocks: list[tuple]) -> tuple:
    """The weights of consecutive blocks as one, halves joined first."""
    if len(blocks) == 1:
        return blocks[0]
    a, b = joined(blocks[:len(blocks) // 2]), joined(blocks[len(blocks) // 2:])
    return tuple(tuple(_least([_join(a[s][m], b[m][e]) for m in STATES if a[s][m] and b[m][e]]) for e in STATES) for s in STATES)


def decided(block: tuple) -> tuple[int, str]:
    """Cost and audit of a whole conversation, with the gap at its end."""
    last = _inserted({s: (0, 0, 0) if s in ENDS else None for s in STATES})
    cost, digits, n = _least([_join(block[START][e], last[e]) for e in STATES if block[START][e] and last[e]])
    return cost, "".join(LETTERS[digits >> BITS * (n - 1 - i) & (1 << BITS) - 1] for i in range(n))


def _packed(block: tuple) -> list:
    return [None if w is None else (w[0], w[1].to_bytes(w[2] * BITS // 8 + 1, "big"), w[2]) for row in block for w in row]


def _unpacked(cells: list) -> tuple:
    flat = [None if c is None else (c["cost"], int.from_bytes(c["digits"], "big"), c["n"]) for c in cells]
    return tuple(tuple(flat[s * len(STATES):(s + 1) * len(STATES)]) for s in STATES)


_CELLS = pa.list_(pa.struct([("cost", pa.int64()), ("digits", pa.binary()), ("n", pa.int64())]))
_CELLS_SQL = "array<struct<cost:bigint,digits:binary,n:bigint>>"


def _weigh(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        cells = [_packed(block_weights(c)) for c in batch.column("codes").to_pylist()]
        yield pa.RecordBatch.from_arrays([batch.column("_thread"), batch.column("block"), pa.array(cells, _CELLS)], ["_thread", "block", "cells"])


def _combine(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        cells = [_packed(joined([_unpacked(b["cells"]) for b in run])) for run in batch.column("run").to_pylist()]
        yield pa.RecordBatch.from_arrays([batch.column("_thread"), batch.column("block"), pa.array(cells, _CELLS)], ["_thread", "block", "cells"])


def _decide(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        found = [decided(_unpacked(c)) for c in batch.column("cells").to_pylist()]
        yield pa.RecordBatch.from_arrays(
            [batch.column("_thread"), pa.array([c for c, _ in found], pa.int64()), pa.array([a for _, a in found], pa.string())],
            ["_thread", "cost", "audit"],
        )


def _spelled(batches: Iterator[pa.RecordBatch], rows: int = 10_000) -> Iterator[pa.RecordBatch]:
    """Each edit that leaves a message: ``_thread, place, ord, role``; an inserted one has no ``ord``, a kept one no ``role``."""

    def out(held: list) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [pa.array(c, t) for c, t in zip(zip(*held, strict=True), (pa.string(), pa.int64(), pa.int64(), pa.string()), strict=True)],
            ["_thread", "place", "ord", "role"],
        )

    held: list[tuple] = []
    for batch in batches:
        for thread, audit, system in zip(*(batch.column(c).to_pylist() for c in ("_thread", "audit", "system")), strict=True):
            at = place = 0
            for letter in audit:
                at += letter != "I"
                if letter == "D":
                    continue
                turn = place - bool(system)
                held.append((thread, place, None if letter == "I" else at, None if letter == "K" else NAMES["ua"[turn % 2]]))
                place += 1
                if len(held) == rows:
                    yield out(held)
                    held = []
    if held:
        yield out(held)


def faults(messages: DataFrame, thread: str = "thread", position: str = "position", role: str = "role", text: str = "text") -> DataFrame:
    """Every message with ``ord``, its place in the thread from 1, and ``fault``: ``blank``, ``duplicate``, ``truncated`` or NULL.

    The first that holds counts: a text without a character other than white space, a role and text that
    an earlier message of the thread has, a last such character that ends no sentence. Messages are ordered by
    position, NULLs first, then by role and text. NULL roles and texts are read as a space. Columns
    ``_thread, position, role, text, initial``: the thread as a text that is never NULL.
    """
    name = F.coalesce(F.concat(F.lit("+"), F.col(thread).cast("string")), F.lit(""))
    rows = messages.select(
        name.alias("_thread"), F.col(position).cast("bigint").alias("position"),
        *[F.coalesce(F.col(c).cast("string"), F.lit(" ")).alias(n) for c, n in ((role, "role"), (text, "text"))],
    )
    order = [F.asc_nulls_first("position"), F.asc("role"), F.asc("text")]
    rows = staged(full_rank(rows, ["_thread"], order), "messages")
    said = F.sha2(F.concat_ws(":", F.octet_length("role").cast("string"), "role", "text").cast("binary"), 256)
    first = rows.groupBy("_thread", said.alias("said")).agg(F.min("ord").alias("ord"))
    marked = rows.join(first.select("_thread", "ord", F.lit(True).alias("new")), ["_thread", "ord"], "left")
    seen = r"[^\x20\x09-\x0D]"
    fault = (
        F.when(~F.col("text").rlike(seen), "blank").when(F.col("new").isNull(), "duplicate")
        .when(F.col("text").rlike(r"[^\x20\x09-\x0D.!?][\x20\x09-\x0D]*\z"), "truncated")
    )
    return marked.select("_thread", "ord", "position", "role", "text", F.substring("role", 1, 1).alias("initial"), fault.alias("fault"))


def repair(
    messages: DataFrame, thread: str = "thread", position: str = "position", role: str = "role", text: str = "text",
) -> tuple[DataFrame, DataFrame]:
    """One row a thread with what is wrong and what mends it, and the mended messages.

    The lexicon's records hold no messages, so this is general: ``messages`` has a thread, a bigint
    position in it, a role and a text; other columns are ignored, whatever their names.

    First table: ``thread, gaps, blank, duplicate, truncated, illegal, cost, audit``. ``gaps`` counts the
    positions that are missing between the first and the last, ``illegal`` the neighbours whose role
    initials are not su, ua or au; see ``faults`` for the rest. ``audit`` has a letter for each edit, in order:
    Keep, Rerole to user or assistant, Delete, Insert an empty message of user or assistant. Blank and
    duplicate messages must be deleted, truncated ones cost more unless they are. The initials left are those
    of ``(s?(ua)+)?``; of the cheapest audits it is the first in ASCII order.

    Second table: ``thread, place, role, text``, the messages that are left, ``place`` from 0.

    Messages are read whole. A NULL thread is a thread; a NULL position comes first; ties go by role and
    text; repeated rows are duplicates. A role that is neither user, system nor assistant by its initial cannot
    be kept. An empty table gives two empty ones. A thread of any length is cut into blocks of bounded size;
    only its audit, one letter a message, comes together in one row.
    """
    rows = staged(faults(messages, thread, position, role, text), "faults")
    code = F.concat(
        F.when(F.col("initial").isin(*STEPS), F.col("initial")).otherwise("-"),
        F.when(F.col("fault").isin("blank", "duplicate"), "x").when(F.col("fault") == "truncated", "c").otherwise("."),
    )
    blocks = rows.select("_thread", F.floor((F.col("ord") - 1) / BLOCK).cast("bigint").alias("block"), F.struct("ord", code.alias("code")).alias("m"))
    blocks = blocks.groupBy("_thread", "block").agg(F.sort_array(F.collect_list("m")).alias("m"))
    codes = blocks.select("_thread", "block", F.array_join(F.transform("m", lambda m: m["code"]), "").alias("codes"))
    weights = staged(codes.mapInArrow(_weigh, f"_thread string, block bigint, cells {_CELLS_SQL}"), "block-weights")
    last = weights.agg(F.max("block")).first()[0] or 0
    while last:
        last //= JOINED
        runs = weights.select("_thread", F.floor(F.col("block") / JOINED).cast("bigint").alias("to"), F.struct("block", "cells").alias("b"))
        runs = runs.groupBy("_thread", "to").agg(F.sort_array(F.collect_list("b")).alias("run")).withColumnRenamed("to", "block")
        weights = staged(runs.mapInArrow(_combine, f"_thread string, block bigint, cells {_CELLS_SQL}"), "block-weights")
    audits = staged(weights.mapInArrow(_decide, "_thread string, cost bigint, audit string"), "audits")

    # Neighbours are looked at inside blocks; the last message of each meets the first of the next by its number.
    inside = Window.partitionBy("_thread", "block").orderBy("ord")
    near = rows.select("_thread", "ord", "initial", F.floor((F.col("ord") - 1) / BLOCK).alias("block"))
    near = near.withColumn("before", F.lag("initial").over(inside))
    heads = near.where((F.col("ord") > 1) & (F.col("ord") % BLOCK == 1)).select("_thread", "ord", "initial")
    tails = near.where(F.col("ord") % BLOCK == 0).select("_thread", (F.col("ord") + 1).alias("ord"), F.col("initial").alias("before"))
    pairs = near.where("before IS NOT NULL").select("_thread", "initial", "before").unionByName(heads.join(tails, ["_thread", "ord"]).drop("ord"))
    illegal = pairs.where(~F.concat("before", "initial").isin("su", "ua", "au")).groupBy("_thread").agg(F.count("*").alias("illegal"))
    positions = rows.where("position IS NOT NULL").select("_thread", "position").distinct().groupBy("_thread").agg(
        (F.max("position") - F.min("position") + 1 - F.count("*")).alias("gaps"),
    )
    counts = rows.groupBy("_thread").agg(*[F.count_if(F.col("fault") == f).alias(f) for f in ("blank", "duplicate", "truncated")])
    named = messages.select(F.col(thread).alias("thread")).distinct()
    named = named.withColumn("_thread", F.coalesce(F.concat(F.lit("+"), F.col("thread").cast("string")), F.lit("")))
    found = named.join(counts, "_thread").join(positions, "_thread", "left").join(illegal, "_thread", "left").join(audits, "_thread")
    found = found.select(
        "thread", F.coalesce("gaps", F.lit(0)).alias("gaps"), "blank", "duplicate", "truncated",
        F.coalesce("illegal", F.lit(0)).alias("illegal"), "cost", "audit",
    )

    # Whether the first message that is left is a kept one of the system.
    first = audits.select("_thread", (F.length(F.regexp_extract("audit", r"\A(D*)K", 1)) + 1).cast("bigint").alias("ord"), "audit").where(F.col("audit").rlike(r"\AD*K"))
    system = rows.where("initial = 's'").select("_thread", "ord").join(first.select("_thread", "ord"), ["_thread", "ord"]).select("_thread", F.lit(True).alias("system"))
    spelled = audits.join(system, "_thread", "left").select("_thread", "audit", F.coalesce("system", F.lit(False)).alias("system"))
    edits = staged(spelled.mapInArrow(_spelled, "_thread string, place bigint, ord bigint, role string"), "edits")
    kept = edits.where("ord IS NOT NULL").withColumnRenamed("role", "to").join(rows.select("_thread", "ord", "role", "text"), ["_thread", "ord"])
    mended = kept.select("_thread", "place", F.coalesce("to", "role").alias("role"), "text").unionByName(
        edits.where("ord IS NULL").select("_thread", "place", "role", F.lit("").alias("text"))
    )
    return found, mended.join(named, "_thread").select("thread", "place", "role", "text")


def conversation_digests(mended: DataFrame) -> DataFrame:
    """``thread, sha256`` of each mended conversation: its ``role:text`` in order, joined by line feeds.

    A thread's messages are sorted where they meet and hashed one after the other, so that none is
    ever held whole.
    """

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def out(done: list, kind: pa.DataType) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array([t for t, _ in done], kind), pa.array([d for _, d in done], pa.string())], ["thread", "sha256"])

        now, digest, kind, done = None, None, None, []
        for batch in batches:
            kind = batch.schema.field("thread").type
            for thread, role, text in zip(*(batch.column(c).to_pylist() for c in ("thread", "role", "text")), strict=True):
                if digest is None or thread != now:
                    if digest is not None:
                        done.append((now, digest.hexdigest()))
                    now, digest = thread, hashlib.sha256()
                else:
                    digest.update(b"\n")
                digest.update(f"{role}:{text}".encode())
            if len(done) > 10_000:
                yield out(done, kind)
                done = []
        if digest is not None:
            yield out([*done, (now, digest.hexdigest())], kind)

    ordered = mended.repartition("thread").sortWithinPartitions("thread", "place").select("thread", "role", "text")
    return ordered.mapInArrow(hashed, f"thread {ordered.schema['thread'].dataType.simpleString()}, sha256 string")
