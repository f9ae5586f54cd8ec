"""A Merkle manifest of a source lock: which entry belongs to which digest, and a proof for each.

The entries of a source are its leaves, numbered in the order of their keys. Every node of the
tree above them is labelled with the nested interval of leaf numbers that it covers: a node of
level ``l`` covers up to ``8 ** l`` leaves, and its parent's interval holds its own. Runs of
consecutive nodes become parents by one aggregation a level. Then ancestors are attached to
nodes from the top down, by joins that meet an interval with the one that contains it, bucketed
by level so that they are equi-joins; what is left of a parent's interval without the node's
own are its siblings. The subroots of the sources are the leaves of one more such tree.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.ranking import full_rank
from ..operators.skew import salted_join
from ..session import staged

#: Consecutive nodes that have one parent.
FANOUT = 8
#: Parts of the records of a lock that a leaf is made of.
ENTRY = ("path", "byte_count", "sha256")
STEPS = "array<struct<before:string, after:string>>"


def _sha(c: Column) -> Column:
    return F.sha2(c.cast("binary"), 256)


def leaf_digest(*fields: Column | str) -> Column:
    """The digest of an entry: its fields one after the other, each ``-`` if NULL, else byte count, ``:`` and value."""
    texts = [(F.col(f) if isinstance(f, str) else f).cast("string") for f in fields]
    return _sha(F.concat(*[
        F.when(t.isNull(), "-").otherwise(F.concat(F.octet_length(t).cast("string"), F.lit(":"), t)) for t in texts
    ]))


def folded(leaf: Column | str, steps: Column | str) -> Column:
    """The root that a leaf gives with the siblings of a proof."""
    leaf, steps = (F.col(c) if isinstance(c, str) else c for c in (leaf, steps))
    return F.aggregate(steps, leaf, lambda now, s: _sha(F.concat(s["before"], now, s["after"])))


def proof_digest(steps: Column | str) -> Column:
    """The digest of a proof's siblings, from the leaf's level up, each level from left to right."""
    steps = F.col(steps) if isinstance(steps, str) else steps
    return _sha(F.array_join(F.transform(steps, lambda s: F.concat(s["before"], s["after"])), ""))


def climb(leaves: DataFrame, part: str, order: Sequence[str], digest: str, *keep: str) -> list[DataFrame]:
    """The runs of nodes of each level, from the leaves up; the last table has one row a part, its top.

    ``part``    a string that is never NULL; each has a tree of its own
    ``order``   the order of a part's leaves; rows that are equal in it must have equal digests
    ``keep``    further columns of the leaves, given with ``order`` in the leaves' ``given``

    A run has the interval ``low, high`` of the leaves it covers, its ``children`` with theirs, and
    its ``digest``. A part that has one node left keeps it as it is up to the highest level: its
    runs are ``whole`` there.
    """
    named = leaves.select(
        F.col(part).alias("part"), *[F.col(c).alias(f"_o{i}") for i, c in enumerate(order)], F.col(digest).alias("digest"),
        F.struct(*order, *keep).alias("given"),
    )
    ranked = full_rank(named, ["part"], [F.asc_nulls_first(f"_o{i}") for i in range(len(order))], "high")
    nodes = staged(ranked.select("part", (F.col("high") - 1).alias("low"), "high", "digest", "given"), "leaves")
    sizes = staged(nodes.groupBy("part").agg(F.count("*").alias("n")), "sizes")
    most = sizes.agg(F.max("n")).first()[0] or 0
    runs: list[DataFrame] = []
    covers = 1
    while not runs or covers < most:
        covers *= FANOUT
        child = F.struct("low", "high", "digest", *([] if runs else ["given"]))
        level = nodes.groupBy("part", *(["n"] if runs else []), F.floor(F.col("low") / covers).cast("bigint").alias("bucket")).agg(
            F.sort_array(F.collect_list(child)).alias("children")
        )
        level = level if runs else salted_join(level, sizes, ["part"])
        digests = F.transform("children", lambda c: c["digest"])
        runs.append(staged(level.select(
            "part", "n", "bucket", F.get("children", F.lit(0))["low"].alias("low"), F.element_at("children", -1)["high"].alias("high"),
            "children", (F.col("n") <= covers // FANOUT).alias("whole"),
            F.when(F.col("n") <= covers // FANOUT, digests[0]).otherwise(_sha(F.array_join(digests, ""))).alias("digest"),
        ), "runs"))
        nodes = runs[-1].select("part", "n", "low", "high", "digest")
    return runs


def descend(runs: list[DataFrame], tops: DataFrame) -> DataFrame:
    """``part, given, digest, steps`` and what ``tops`` holds, for every leaf of ``climb``'s runs.

    ``tops``  ``part, steps`` and further columns: what comes above the top of each part

    ``steps`` are the levels of a proof from the leaf's own up; at each of them ``before`` and
    ``after`` are the digests of the node's siblings to its left and right, one after the other.
    """
    rest = [c for c in tops.columns if c not in ("part", "steps")]
    above = runs[-1].join(tops, "part")
    for i in range(len(runs) - 2, -1, -1):
        held = _attached(above, rest).withColumn("bucket", F.floor(F.col("node.low") / FANOUT ** (i + 1)).cast("bigint"))
        inside = (F.col("node.low") <= F.col("low")) & (F.col("high") <= F.col("node.high"))
        above = runs[i].join(held, ["part", "bucket"]).where(inside).drop("node")
    return _attached(above, rest).select("part", "node.given", "node.digest", "steps", *rest)


def _attached(runs: DataFrame, rest: Sequence[str]) -> DataFrame:
    """The nodes of runs, each with its siblings, which are its parent's interval without its own, put before those above."""
    nodes = runs.select("part", "children", "whole", "steps", *rest, F.explode("children").alias("node"))
    digests = lambda keep: F.array_join(F.transform(F.filter("children", keep), lambda c: c["digest"]), "")
    step = F.struct(
        digests(lambda c: c["high"] <= F.col("node.low")).alias("before"), digests(lambda c: c["low"] >= F.col("node.high")).alias("after"),
    )
    return nodes.select("part", "node", F.when(F.col("whole"), F.col("steps")).otherwise(F.concat(F.array(step), "steps")).alias("steps"), *rest)


def prove(
    entries: DataFrame, fields: Sequence[str] = ENTRY, key: str = "path", source: str = "source", found: Sequence[Column | str] | None = None,
) -> DataFrame:
    """``key, source, leaf, subroot, root, steps, proof_sha256, folded_root, verified`` for every entry.

    ``entries``  the files of a source lock: their source, path and whatever else is recorded of them
    ``fields``   the columns that make an entry's leaf, in this order
    ``found``    expressions for the values found now in place of ``fields``; without it the recorded ones

    A source's leaves ascend by key; as long as it has several nodes, every eight consecutive ones,
    or what is left of them, become one. The last one is the source's ``subroot``. Subroots, in
    the byte order of their sources with NULL first, become the ``root`` likewise. ``steps`` holds
    the siblings from leaf to root, and ``proof_sha256`` is their digest. ``folded_root`` is what
    the found values give with those siblings, and ``verified`` whether that is the root.

    A NULL field is ``-``, told apart from an empty text; texts of any length are read whole. A NULL
    key comes first and a NULL source is a source. Repeated rows are leaves of their own, ordered
    by their digests where keys tie. An empty table gives no rows; further columns are ignored.
    Keys keep their type. Nothing but numbers of leaves reaches the driver.
    """
    leaf = leaf_digest(*fields)
    shown = leaf if found is None else leaf_digest(*found)
    # Sources in byte order, NULL first, as a string that is never NULL.
    part = F.when(F.col(source).isNull(), "").otherwise(F.concat(F.lit("+"), F.col(source).cast("string")))
    rows = entries.select(
        F.col(key).alias("key"), F.col(source).alias("source"), part.alias("part"), leaf.alias("leaf"),
        F.nullif(shown, leaf).alias("shown"),
    )
    rows = staged(rows.withColumn("tie", F.coalesce("shown", F.lit(""))), "entries")
    lower = climb(rows, "part", ["key", "leaf", "tie"], "leaf", "source")
    subroots = lower[-1].select(F.lit("").alias("all"), F.col("part").alias("of"), F.col("digest").alias("subroot"))
    upper = climb(subroots, "all", ["of"], "subroot")
    roots = upper[-1].select("part", F.expr(f"cast(array() as {STEPS})").alias("steps"), F.col("digest").alias("root"))
    tops = descend(upper, roots).select(F.col("given.of").alias("part"), F.col("digest").alias("subroot"), "root", "steps")
    shown = F.coalesce(F.nullif("given.tie", F.lit("")), "digest")
    out = descend(lower, staged(tops, "subroots")).select(
        F.col("given.key").alias(key), F.col("given.source").alias(source), F.col("digest").alias("leaf"), "subroot", "root", "steps",
        proof_digest("steps").alias("proof_sha256"), folded(shown, F.col("steps")).alias("folded_root"),
    )
    return out.withColumn("verified", F.col("folded_root") == F.col("root"))
