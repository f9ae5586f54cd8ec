"""Quotation linking: which earlier message a quoted passage comes from, and the reply order it implies.

A message's lines carry as many quote marks as the passage is levels deep. Passages are
normalised and cut into sentences, whose hashes survive another wrapping of the lines; each is
joined to the latest earlier message of the thread that says it in its own words. A message
answers the one its outermost linked passages come from, or else the message before it.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..operators.ranking import full_rank
from ..session import staged

MARKS = re.compile(r"[ \t]*((?:>[ \t]?)+)")
ATTRIBUTION = re.compile(r"(?:wrote|writes|schrieb|écrit|escribió)\b.*:\s*$", re.IGNORECASE)
SENTENCE = re.compile(r"(?<=[.!?…])\s+")
EDGE = re.compile(r"^\W+|\W+$")
#: Positions looked at together; a thread of any length is many small groups.
SPAN = 256


def parse(text: str) -> tuple[str, list[tuple[int, str]]]:
    """The message's own text, and its quoted passages with their levels, in order."""
    own: list[str] = []
    quoted: list[tuple[int, list[str]]] = []
    before = 0
    for line in text.split("\n"):
        m = MARKS.match(line)
        level = m[1].count(">") if m else 0
        if not level:
            own.append(line)
        elif level == before:
            quoted[-1][1].append(line[m.end():])
        else:
            if not before:
                while own and not own[-1].strip():
                    own.pop()
                if own and ATTRIBUTION.search(own[-1]):
                    own.pop()
            quoted.append((level, [line[m.end():]]))
        before = level
    return "\n".join(own).strip(), [(level, "\n".join(lines)) for level, lines in quoted]


def sentences(passage: str) -> list[int]:
    """Signed 64-bit hashes of the normalised sentences of a passage."""
    out = []
    for one in SENTENCE.split(" ".join(passage.lower().split())):
        one = EDGE.sub("", one)
        if one:
            h = xxhash.xxh3_64_intdigest(one)
            out.append(h - (1 << 64) if h >> 63 else h)
    return out


def latest_before(asks: DataFrame, marks: DataFrame, group: list[str], position: str, name: str) -> DataFrame:
    """``asks`` with the largest position of ``marks`` in the same group before its own, or NULL.

    Positions are looked at in spans; a span that has none before takes the largest of the spans
    before it. So a group of any size is spread over many small ones.
    """
    span = F.floor(F.col(position) / SPAN).cast("bigint")
    said = marks.select(*group, position).distinct().withColumn("_span", span)
    spans = said.groupBy(*group, "_span").agg(F.max(position).alias("_end"))
    both = said.select(*group, position, "_span", F.lit(True).alias("_mark")).union(
        asks.select(*group, position).distinct().select(*group, position, span, F.lit(False))
    )
    both = both.groupBy(*group, "_span", position).agg(F.max("_mark").alias("_mark"), F.min("_mark").alias("_only"))
    inside = Window.partitionBy(*group, "_span").orderBy(position).rowsBetween(Window.unboundedPreceding, -1)
    near = both.select(
        *group, "_span", position, "_only", F.max(F.when(F.col("_mark"), F.col(position))).over(inside).alias("_near"),
    ).where("NOT _only")
    heads = near.where("_near IS NULL").select(*group, "_span").distinct().withColumn("_end", F.lit(None).cast("bigint"))
    earlier = Window.partitionBy(*group).orderBy("_span").rowsBetween(Window.unboundedPreceding, -1)
    carried = spans.select(*group, "_span", "_end").union(heads).groupBy(*group, "_span").agg(F.max("_end").alias("_end"))
    carried = carried.select(*group, "_span", F.max("_end").over(earlier).alias("_carried"))
    found = near.join(carried, [*group, "_span"], "left").select(*group, position, F.coalesce("_near", "_carried").alias(name))
    return asks.join(found, [*group, position], "left")


def _parsed(messages: DataFrame, thread: str, position: str, text: str) -> DataFrame:
    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            own, said, quoted = [], [], []
            for t in batch.column("text").to_pylist():
                mine, passages = parse(t or "")
                own.append(None if t is None else mine)
                said.append(sentences(mine))
                quoted.append([
                    {"passage": i, "level": level, "part": k, "hash": h}
                    for i, (level, p) in enumerate(passages) for k, h in enumerate(sentences(p))
                ])
            kind = pa.list_(pa.struct([("passage", pa.int32()), ("level", pa.int32()), ("part", pa.int32()), ("hash", pa.int64())]))
            yield pa.RecordBatch.from_arrays(
                [batch.column("row"), pa.array(own, pa.string()), pa.array(said, pa.list_(pa.int64())), pa.array(quoted, kind)],
                ["row", "own", "said", "quoted"],
            )

    rest = F.struct(F.col(thread).alias("thread"), F.col(position).cast("bigint").alias("position"), F.struct(*messages.columns).alias("given"))
    picked = messages.select(rest.alias("row"), F.col(text).alias("text"))
    kind = picked.schema["row"].dataType.simpleString()
    parsed = picked.mapInArrow(
        read, f"row {kind}, own string, said array<bigint>, quoted array<struct<passage:int,level:int,part:int,hash:bigint>>",
    )
    return staged(parsed.select("row.thread", "row.position", "row.given", "own", "said", "quoted"), "messages")


def _links(parsed: DataFrame) -> DataFrame:
    known = parsed.where("thread IS NOT NULL AND position IS NOT NULL")
    asks = known.select("thread", "position", F.explode("quoted").alias("q")).select("thread", "position", "q.*").distinct()
    marks = known.select("thread", "position", F.explode("said").alias("hash"))
    marks = marks.join(asks.select("thread", "hash").distinct(), ["thread", "hash"], "left_semi")
    parts = latest_before(asks, marks, ["thread", "hash"], "position", "original")
    votes = parts.groupBy("thread", "position", "passage", "level", "original").agg(F.count("*").alias("n"), F.min("hash").alias("h"))
    best = F.max(F.struct(F.col("original").isNotNull().alias("any"), "n", "original"))
    return votes.groupBy("thread", "position", "passage", "level").agg(
        F.sum("n").cast("int").alias("parts"), F.bit_xor("h").alias("hash"), best.alias("b"),
    ).select(
        "thread", "position", "passage", "level", "hash", "parts",
        F.when(F.col("b.any"), F.col("b.n")).otherwise(0).cast("int").alias("linked_parts"), F.col("b.original").alias("original"),
    )


def link_quotes(messages: DataFrame, thread: str = "thread", position: str = "position", text: str = "text") -> DataFrame:
    """``thread, position, passage, level, hash, parts, linked_parts, original`` for each quoted passage.

    ``original`` is the position of the message that most of the passage's sentences come from
    (each counts for the latest earlier message saying it; ties to the later message), or NULL.
    See ``conversations`` for the rules.
    """
    return _links(_parsed(messages, thread, position, text))


def conversations(messages: DataFrame, thread: str = "thread", position: str = "position", text: str = "text") -> DataFrame:
    """Every message without its quotes, with ``reply_to, root, depth, ord``: its place in reply order.

    The lexicon's records hold no messages, so this is general: ``messages`` has a thread, a
    bigint position in it that grows with time, and a text; other columns come back unchanged, but
    for those four names, which are replaced.

    A line's quote level is the number of its leading ``>``; a run of lines of one level is a
    passage. Its sentences are compared without regard to case, spacing, line ends and the
    marks at their edges. Lines such as "… wrote:" directly before a quote go with it. ``reply_to`` is
    the original of the passage of the lowest level that has one (more sentences first, then the
    later message), or the message before, or NULL for a thread's first. ``root`` and ``depth``
    follow ``reply_to`` up; ``ord`` numbers the messages of a root from 1, by depth and position,
    so that each comes after the one it answers. A NULL or empty text quotes nothing and stays as
    it is. Messages of one thread and position count as one place and share its number. A NULL
    thread or position has no reply, depth 0 and no number. An empty table gives none.
    """
    parsed = _parsed(messages, thread, position, text)
    nodes = parsed.select("thread", "position").where("thread IS NOT NULL AND position IS NOT NULL").distinct()
    quoted = _links(parsed).where("original IS NOT NULL").groupBy("thread", "position").agg(
        F.max(F.struct((-F.col("level")).alias("l"), "linked_parts", "original"))["original"].alias("quoted"),
    )
    before = latest_before(nodes, nodes, ["thread"], "position", "before")
    tree = before.join(quoted, ["thread", "position"], "left").select(
        "thread", "position", F.coalesce("quoted", "before").alias("reply_to"),
    )
    tree = staged(tree, "replies")
    # Pointers double in length each round until all are at their root; those that are there rest.
    step = staged(tree.select(
        "thread", "position", F.coalesce("reply_to", "position").alias("up"),
        F.when(F.col("reply_to").isNull(), 0).otherwise(1).alias("depth"), F.col("reply_to").isNotNull().alias("moved"),
    ), "pointers")
    while not step.where("moved").isEmpty():
        above = step.select("thread", F.col("position").alias("up"), F.col("up").alias("up2"), F.col("depth").alias("more"))
        moved = step.where("moved").join(above, ["thread", "up"]).select(
            "thread", "position", F.col("up2").alias("up"), (F.col("depth") + F.col("more")).alias("depth"), (F.col("more") > 0).alias("moved"),
        )
        step = staged(step.where("NOT moved").unionByName(moved), "pointers")
    placed = tree.join(step.drop("moved"), ["thread", "position"]).select(
        "thread", "position", "reply_to", F.col("up").alias("root"), "depth",
    )
    ordered = full_rank(placed, ["thread", "root"], [F.col("depth"), F.col("position")])
    added = ["reply_to", "root", "depth", "ord"]
    return parsed.join(ordered, ["thread", "position"], "left").select(
        *[F.col("own").alias(c) if c == text else F.col(f"given.{c}") for c in messages.columns if c not in added],
        "reply_to", "root", F.coalesce("depth", F.lit(0)).alias("depth"), "ord",
    )
