"""Near copies of glosses: a set-similarity join on word shingles with grouped prefixes.

Two sets of sizes ``n`` and ``m`` that are similar enough share a token among their first
tokens in any order that all sets keep. Texts with one and the same set are one unit. Units of
one size with the same first tokens form a group, and only groups are posted under their
tokens; a pair of groups that survives the size and position filters is expanded to its
members, whose pairs are checked by a longer run of first tokens and then by their whole sets.

Links serve to find what belongs together, so pairs that other links already join are not
spelled out: first every group meets the smallest group of each of its lists, and members meet
their group's first; the components of those links are found; only then members of different
components in a list meet each other. Every link between two components is found, however long
a list is; a list inside one component costs nothing more.

Tokens that many texts share come last in the order. They are counted over all texts; the
order decides the cost, never the result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import staged
from .components import components
from .memory import bare, by_size

WORDS = 5
PERCENT = 80
#: Tokens at the end of the order, at most; each occurs ``COMMON_HERE`` times in some run of ``COUNTED`` tokens.
COMMON = 1 << 19
COMMON_HERE = 3
COUNTED = 3_000_000
#: Characters worked on together, about, which bounds the arrays made for them.
BATCH_CHARS = 1_000_000
#: First tokens kept for the pair filter, as a multiple of those posted; 16 bits of each are kept.
FILTER_RUN = 2


def _mix(h: np.ndarray) -> np.ndarray:
    h = h ^ (h >> np.uint64(30))
    h = h * np.uint64(0xBF58476D1CE4E5B9)
    h = h ^ (h >> np.uint64(27))
    h = h * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def shingle_sets(texts: list[str | None], words: int) -> list[np.ndarray]:
    """Sorted distinct 64-bit tokens of each text: one per run of ``words`` words, or one for a shorter text."""
    lower = pc.ascii_lower(pa.array((t or "" for t in texts), pa.large_string()))
    split = pc.split_pattern_regex(pc.ascii_trim(lower, " \t\n\v\f\r"), "[ \t\n\v\f\r]+")
    coded = split.values.dictionary_encode()
    names = (w.encode() for w in coded.dictionary.to_numpy(zero_copy_only=False))
    each = np.fromiter(map(xxhash.xxh3_64_intdigest, names), np.uint64, len(coded.dictionary))
    flat = each[coded.indices.to_numpy()] if len(each) else np.zeros(0, np.uint64)
    token = np.full(max(0, len(flat) - words + 1), words, np.uint64)
    for i in range(words):
        token = _mix(token ^ flat[i:len(flat) - words + 1 + i])
    out = []
    offsets = split.offsets.to_numpy()
    empty = pc.equal(pc.binary_length(lower), 0).to_numpy(zero_copy_only=False)
    blank = pc.equal(pc.binary_length(pc.ascii_trim(lower, " \t\n\v\f\r")), 0).to_numpy(zero_copy_only=False)
    for a, b, none in zip(offsets[:-1], offsets[1:], empty | blank, strict=True):
        if none:
            out.append(np.zeros(0, np.uint64))
        elif b - a >= words:
            out.append(np.unique(token[a:b - words + 1]))
        else:
            h = np.full(1, b - a, np.uint64)
            for w in flat[a:b]:
                h = _mix(h ^ w)
            out.append(h)
    return out


def _ceil(a: int, b: int) -> int:
    return -(-a // b)


def _common_tokens(texts: DataFrame, words: int) -> tuple[np.ndarray, np.ndarray]:
    """Tokens that many texts share, sorted, with their places in the order of frequency."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, n = np.empty(COUNTED, np.uint64), 0
        for part in by_size(batches, BATCH_CHARS):
            tokens = np.concatenate(shingle_sets(part.column("gloss").to_pylist(), words))
            while len(tokens):
                some, tokens = tokens[:COUNTED - n], tokens[COUNTED - n:]
                held[n:n + len(some)] = some
                n += len(some)
                if n == COUNTED:
                    yield counted_once(held)
                    n = 0
        if n:
            yield counted_once(held[:n])

    def counted_once(held: np.ndarray) -> pa.RecordBatch:
        held.sort()  # in place, and only the common ones are copied
        again = held[COMMON_HERE - 1:]
        again = again[again == held[:1 - COMMON_HERE]]
        tokens = np.concatenate([again[:1], again[1:][again[1:] != again[:-1]]])
        n = np.searchsorted(held, tokens, "right") - np.searchsorted(held, tokens)
        return pa.RecordBatch.from_arrays([pa.array(tokens.view(np.int64)), pa.array(n)], ["token", "n"])

    counted = texts.mapInArrow(bare(count), "token bigint, n bigint").groupBy("token").agg(F.sum("n").alias("n"))
    most = counted.orderBy(F.desc("n"), "token").limit(COMMON).toArrow()
    tokens = most.column("token").to_numpy().view(np.uint64)
    place = np.arange(len(tokens), 0, -1, np.int64)
    order = np.argsort(tokens)
    return tokens[order], place[order]


def _similar(percent: int) -> Column:
    """Whether the sizes and places of a shared token leave room for enough shared ones."""
    n, m, i, j = F.col("n"), F.col("m"), F.col("i"), F.col("j")
    sizes = (F.least(n, m) * 100 >= F.greatest(n, m) * percent)
    room = (1 + F.least(n - 1 - i, m - 1 - j)) * (100 + percent) >= (n + m) * percent
    return sizes & room


def _may_hold(low: str, high: str, at: str, low2: str, high2: str, at2: str, percent: int) -> Column:
    """Whether two lots of members, known by their sizes and first places, can hold a pair that passes ``_similar``."""
    sizes = (F.col(high) * 100 >= F.col(low2) * percent) & (F.col(high2) * 100 >= F.col(low) * percent)
    room = 1 + F.least(F.col(high) - 1 - F.col(at), F.col(high2) - 1 - F.col(at2))
    return sizes & (room * (100 + percent) >= (F.col(low) + F.col(low2)) * percent)


def near_copies(
    glosses: DataFrame, key: str = "key", gloss: str = "gloss", words: int = WORDS, percent: int = PERCENT,
) -> DataFrame:
    """``key, n_shingles, component`` for every gloss: near copies share the component's smallest key.

    ``words``, ``percent``  two glosses link when their sets of word runs of this length have a
                            Jaccard similarity of at least this percentage (more than 50)

    Words are what white space of ASCII separates, with A-Z in lower case. A gloss of fewer words
    is one shingle, the whole of it; a NULL or blank gloss has none and links with nothing. Texts
    with equal sets are linked. Keys are bigint; rows of one key are one record, whose texts are
    linked. A row with a NULL key links with nothing and its component is
    NULL. Every row of the table comes back, an empty table gives none, further columns are
    ignored. Sets are kept as 64-bit hashes of their shingles.
    """
    texts = glosses.select(F.col(key).cast("bigint").alias("key"), F.col(gloss).alias("gloss"))
    common, places = _common_tokens(texts, words)
    base = np.log(100 / percent) + 1e-6

    def describe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in by_size(batches, BATCH_CHARS):
            rows: list[tuple] = []
            for tokens in shingle_sets(batch.column("gloss").to_pylist(), words):
                n = len(tokens)
                if not n:
                    rows.append((0, b"", b"", [], b"", 0, 0, 0))
                    continue
                weight = np.zeros(n, np.int64)
                if len(common):
                    at = np.minimum(np.searchsorted(common, tokens), len(common) - 1)
                    weight = np.where(common[at] == tokens, places[at], 0)
                order = np.lexsort((tokens, weight))
                posted = n - _ceil(percent * n, 100) + 1
                run = order[:min(n, FILTER_RUN * posted)]
                first = tokens[order[:posted]]
                rows.append((
                    n, xxhash.xxh3_128_digest(tokens.tobytes()), xxhash.xxh3_128_digest(first.tobytes()), first.view(np.int64),
                    tokens[run].astype(np.uint16).tobytes(), int(weight[run[-1]]), int(tokens[run[-1]] >> np.uint64(1)),
                    int(np.log(n) / base),
                ))
            columns = list(zip(*rows, strict=True))
            kinds = [pa.int64(), pa.binary(), pa.binary(), pa.list_(pa.int64()), pa.binary(), pa.int64(), pa.int64(), pa.int64()]
            yield pa.RecordBatch.from_arrays(
                [batch.column("key"), *(pa.array(c, t) for c, t in zip(columns, kinds, strict=True))],
                ["key", "n", "digest", "first_digest", "first", "run", "last_weight", "last_token", "bucket"],
            )

    sets = staged(texts.mapInArrow(
        bare(describe), "key bigint, n bigint, digest binary, first_digest binary, first array<bigint>, run binary,"
        " last_weight bigint, last_token bigint, bucket bigint",
    ), "shingle-sets")
    linkable = sets.where("n > 0 AND key IS NOT NULL")
    same = staged(linkable.groupBy("digest").agg(F.min("key").alias("unit")), "units")
    # One row per unit without its tokens, which stay where they were written.
    units = staged(
        linkable.select("key", "n", "digest", "first_digest").join(
            same.select("digest", F.col("unit").alias("key")), ["digest", "key"], "left_semi"
        ), "unit-keys",
    )
    groups = staged(units.groupBy("n", "first_digest").agg(F.min("key").alias("group"), F.count("*").alias("members")), "groups")
    members = staged(units.join(groups, ["n", "first_digest"]).select("group", "key", "n", "members"), "members")

    heads = linkable.select("key", "n", "first_digest", "first", "bucket").join(
        groups.select("n", "first_digest", F.col("group").alias("key")), ["n", "first_digest", "key"], "left_semi",
    )
    posts = heads.select(F.col("key").alias("group"), "n", "bucket", F.posexplode("first").alias("i", "token"))
    # Most tokens are posted once and cannot pair anything; only the others go on.
    often = posts.groupBy("token").agg(F.count("*").alias("c")).where("c > 1")
    posts = staged(posts.join(often.select("token"), "token", "left_semi"), "posts")
    posted = posts.select(
        "group", "n", "i", "token",
        F.explode(F.array(F.struct("bucket", F.lit(False).alias("guest")), F.struct((F.col("bucket") - 1).alias("bucket"), F.lit(True).alias("guest")))).alias("at"),
    ).select("group", "n", "i", "token", "at.bucket", "at.guest")
    shared = posted.groupBy("token", "bucket").agg(
        F.min(F.struct("group", F.col("n").alias("m"), F.col("i").alias("j"))).alias("lead"), F.max("group").alias("last"),
        F.min("guest").alias("guests"),
    ).where("lead.group < last AND NOT guests").drop("last", "guests")
    lists = staged(posted.join(shared, ["token", "bucket"]), "lists")

    stars = lists.select("group", "n", "i", F.col("lead.group").alias("b"), "lead.m", "lead.j").where(
        (F.col("group") != F.col("b")) & _similar(percent)
    ).select(F.col("b").alias("a"), F.col("group").alias("b"))
    stars = stars.union(members.where("key <> group").select("group", "key"))
    stars = staged(stars.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), "star-pairs")
    links = staged(_linked(stars, linkable, texts, words, percent), "star-links")
    joined = staged(components(links), "star-components")

    # Members of every list, and of every group, with the component they are in by now.
    placed = members.join(joined.withColumnRenamed("node", "key"), "key", "left").select(
        "group", "key", "n", "members", F.coalesce("component", "key").alias("component"),
    )
    in_lists = lists.select("token", "bucket", "group", "i", "guest").join(placed.drop("members"), "group")
    in_groups = placed.where("members > 1").select(
        "group", F.col("group").alias("token"), F.lit(-2).cast("bigint").alias("bucket"), F.lit(0).alias("i"),
        F.lit(False).alias("guest"), "key", "n", "component",
    )
    held = in_lists.unionByName(in_groups).drop("group")
    mixed = held.groupBy("token", "bucket").agg(F.min("component").alias("x"), F.max("component").alias("y")).where("x < y")
    held = staged(held.join(mixed.select("token", "bucket"), ["token", "bucket"], "left_semi"), "mixed-lists")
    # What a component has at most in a list: a first test of components, then of a member with a component.
    kinds = held.groupBy("token", "bucket", "component").agg(
        F.min("n").alias("low"), F.max("n").alias("high"), F.min("i").alias("at"),
    )
    x_kinds = kinds.toDF("token", "bucket", "x", "x_low", "x_high", "x_at")
    y_kinds = kinds.toDF("token", "bucket", "y", "y_low", "y_high", "y_at")
    apart = x_kinds.join(y_kinds, ["token", "bucket"]).where(
        (F.col("x") < F.col("y")) & _may_hold("x_low", "x_high", "x_at", "y_low", "y_high", "y_at", percent)
    )
    left = held.select("token", "bucket", F.col("component").alias("x"), F.col("key").alias("a"), "n", "i", F.col("guest").alias("g"))
    right = held.select(
        "token", "bucket", F.col("component").alias("y"), F.col("key").alias("b"), F.col("n").alias("m"), F.col("i").alias("j"), "guest",
    )
    near = apart.join(left, ["token", "bucket", "x"]).where(_may_hold("n", "n", "i", "y_low", "y_high", "y_at", percent))
    pairs = near.select("token", "bucket", "y", "a", "n", "i", "g").join(right, ["token", "bucket", "y"]).where(
        _similar(percent) & ~(F.col("g") & F.col("guest"))
    ).select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
    pairs = staged(pairs.join(stars, ["a", "b"], "left_anti"), "further-pairs")
    more = _linked(pairs, linkable, texts, words, percent)
    by_row = staged(sets.select("key", "n", "digest").join(same, "digest", "left").select("key", "n", "unit"), "rows-with-units")
    several = by_row.groupBy("key").agg(F.min("unit").alias("a"), F.max("unit").alias("b")).where("a < b").select("key", "a")
    records = by_row.where("unit IS NOT NULL").join(several, "key").select("a", F.col("unit").alias("b"))
    found = components(links.unionByName(more).unionByName(records)).withColumnRenamed("node", "unit")
    return by_row.join(found, "unit", "left").select(
        "key", F.col("n").alias("n_shingles"), F.when(F.col("key").isNotNull(), F.coalesce("component", "unit", "key")).alias("component"),
    )


def _linked(pairs: DataFrame, sets: DataFrame, texts: DataFrame, words: int, percent: int) -> DataFrame:
    """The pairs ``a, b`` of keys whose sets are similar enough."""

    def may(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            x, y = (batch.column(c).to_pylist() for c in "xy")
            for p, q in zip(x, y, strict=True):
                n, m = p["n"], q["n"]
                need = _ceil(percent * (n + m), 100 + percent)
                mine, other = (np.frombuffer(s["run"], np.uint16) for s in (p, q))
                both = len(np.intersect1d(mine, other)) + (len(mine) - len(np.unique(mine)))
                first = (p["last_weight"], p["last_token"]) <= (q["last_weight"], q["last_token"])
                keep.append(both >= (len(mine) - (n - need) if first else len(other) - (m - need)))
            yield pa.RecordBatch.from_arrays(
                [batch.column("a").filter(pa.array(keep, pa.bool_())), batch.column("b").filter(pa.array(keep, pa.bool_()))], ["a", "b"],
            )

    sides = sets.select("key", F.struct("n", "run", "last_weight", "last_token").alias("s"))
    seen = pairs.join(sides.toDF("a", "x"), "a").join(sides.toDF("b", "y"), "b").select("a", "b", "x", "y")
    likely = staged(seen.mapInArrow(bare(may), "a bigint, b bigint").distinct(), "likely-pairs")
    keys = likely.select(F.col("a").alias("key")).union(likely.select("b")).distinct()

    def tokens_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in by_size(batches, BATCH_CHARS):
            whole = [s.tobytes() for s in shingle_sets(batch.column("gloss").to_pylist(), words)]
            yield pa.RecordBatch.from_arrays([batch.column("key"), pa.array(whole, pa.binary())], ["key", "s"])

    whole = staged(texts.join(keys, "key", "left_semi").mapInArrow(bare(tokens_of), "key bigint, s binary"), "whole-sets")

    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            for p, q in zip(batch.column("x"), batch.column("y"), strict=True):
                mine, other = (np.frombuffer(s.as_py(), np.uint64) for s in (p, q))
                both = len(np.intersect1d(mine, other, assume_unique=True))
                keep.append(100 * both >= percent * (len(mine) + len(other) - both) > 0)
            yield pa.RecordBatch.from_arrays(
                [batch.column("a").filter(pa.array(keep, pa.bool_())), batch.column("b").filter(pa.array(keep, pa.bool_()))], ["a", "b"],
            )

    checked = likely.join(whole.toDF("a", "x"), "a").join(whole.toDF("b", "y"), "b").select("a", "b", "x", "y")
    return checked.mapInArrow(bare(verify), "a bigint, b bigint").distinct()
