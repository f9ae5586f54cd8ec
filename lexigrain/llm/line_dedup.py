"""Repeated passages across glosses: pairwise alignment of their lines.

The seeds are passages: the shortest runs of lines with at least ``min_words`` words that start
or end at each line. All glosses with one passage are a class that meets through its
representative, the first of them by key: a gloss is paired with the representatives of its
passages, so a passage in a third of all glosses makes as many pairs as it has copies. Nothing
is lost by that: every line of a block that two glosses share lies in a passage inside the
block (the last run from the front that still has enough words reaches the line, or the run
that ends at the line starts in the block), and the passage's representative holds it too.

Each pair is aligned by patience diff on line hashes: lines that occur once in both, in the
longest common order, are the anchors; what lies between them is aligned in the same way. A
block that was moved out of that order is aligned on its own, outward from a shared passage.
Aligned blocks of at least ``min_words`` words are deleted from the later gloss. So a line goes
if, and only if, it lies in a run of lines with enough words that some earlier gloss has too.
"""

from __future__ import annotations

from bisect import bisect_left
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import staged
from .memory import bare

MIN_WORDS = 8
#: A key with more than this fraction (one over it) of a join's rows is cut into parts, but not below so many rows.
HEAVY = 1024
HEAVY_ROWS = 64


def line_hash(line: str) -> int:
    """A signed 64-bit hash of a line's words, whatever their case and spacing."""
    h = xxhash.xxh3_64_intdigest(" ".join(line.lower().split()))
    return h - (1 << 64) if h >> 63 else h


def passages(hashes: list[int], words: list[int], least: int) -> list[tuple[int, int, int]]:
    """``(hash, start, end)`` of the shortest runs of lines with enough words from and to each line; blank lines are left out before."""
    spans, end, held = [], 0, 0
    for i, n in enumerate(words):
        while end < len(words) and held < least:
            held += words[end]
            end += 1
        if held < least:
            break
        spans.append((i, end))
        held -= n
    start, held = 0, 0
    for i, n in enumerate(words):
        held += n
        while start < i and held - words[start] >= least:
            held -= words[start]
            start += 1
        if held >= least:
            spans.append((start, i + 1))
    out = []
    for i, end in sorted(set(spans)):
        h = xxhash.xxh3_64_intdigest(np.array(hashes[i:end], np.int64).tobytes())
        out.append((h - (1 << 64) if h >> 63 else h, i, end))
    return out


def _increasing(seconds: list[int]) -> list[int]:
    """Places of a longest increasing part, by patience sorting."""
    tops: list[int] = []
    at: list[int] = []
    before = [-1] * len(seconds)
    for i, s in enumerate(seconds):
        pile = bisect_left(tops, s)
        if pile:
            before[i] = at[pile - 1]
        if pile == len(tops):
            tops.append(s)
            at.append(i)
        else:
            tops[pile], at[pile] = s, i
    out, i = [], at[-1] if at else -1
    while i >= 0:
        out.append(i)
        i = before[i]
    return out[::-1]


def patience(a: list[int], b: list[int]) -> list[tuple[int, int]]:
    """Aligned places ``(i, j)`` with ``a[i] == b[j]``, increasing in both.

    Anchors are values that occur once on each side; where none does, the first place of each
    shared value takes their part.
    """
    out: list[tuple[int, int]] = []
    todo = [(0, len(a), 0, len(b))]
    while todo:
        i, i_end, j, j_end = todo.pop()
        while i < i_end and j < j_end and a[i] == b[j]:
            out.append((i, j))
            i, j = i + 1, j + 1
        while i < i_end and j < j_end and a[i_end - 1] == b[j_end - 1]:
            i_end, j_end = i_end - 1, j_end - 1
            out.append((i_end, j_end))
        if i == i_end or j == j_end:
            continue
        mine, other = Counter(a[i:i_end]), Counter(b[j:j_end])
        shared = mine.keys() & other.keys()
        if not shared:
            continue
        once = {v for v in shared if mine[v] == 1 and other[v] == 1} or shared
        first: dict[int, int] = {}
        for p in range(j, j_end):
            if b[p] in once:
                first.setdefault(b[p], p)
        pairs, used = [], set()
        for p in range(i, i_end):
            if a[p] in once and a[p] not in used:
                used.add(a[p])
                pairs.append((p, first[a[p]]))
        anchors = [pairs[p] for p in _increasing([q for _, q in pairs])]
        for (p, q), (p_next, q_next) in zip([(i - 1, j - 1), *anchors], [*anchors, (i_end, j_end)], strict=True):
            if p >= i:
                out.append((p, q))
            if p_next - p > 1 and q_next - q > 1:
                todo.append((p + 1, p_next, q + 1, q_next))
    return sorted(out)


def common_lines(a: list[int], b: list[int], a_words: list[int], words: list[int], least: int) -> list[int]:
    """Places in ``b`` of aligned blocks, consecutive in both, with enough words.

    What the order of the whole leaves out, because it was moved or repeated, is aligned on its
    own: a passage of both is the anchor, and the block grows from there while lines agree.
    """
    gone = [False] * len(b)
    block: list[int] = []
    last = None
    for i, j in [*patience(a, b), (None, None)]:
        if last is None or i is None or (i, j) != (last[0] + 1, last[1] + 1):
            if sum(words[x] for x in block) >= least:
                for x in block:
                    gone[x] = True
            block = []
        block.append(j)
        last = (i, j)
    if not all(gone):
        place = {h: (start, end) for h, start, end in reversed(passages(a, a_words, least))}
        for h, start, end in passages(b, words, least):
            if h not in place or all(gone[start:end]):
                continue
            (i, i_end), j, j_end = place[h], start, end
            while i and j and not gone[j - 1] and a[i - 1] == b[j - 1]:
                i, j = i - 1, j - 1
            while i_end < len(a) and j_end < len(b) and not gone[j_end] and a[i_end] == b[j_end]:
                i_end, j_end = i_end + 1, j_end + 1
            gone[j:j_end] = [True] * (j_end - j)
    return [j for j, x in enumerate(gone) if x]


def heavy_join(large: DataFrame, small: DataFrame, on: str, counts: DataFrame, total: int, spread: str) -> DataFrame:
    """``large`` joined with ``small`` on a key that may hold a large share of the rows of ``large``.

    ``counts``  ``on, n``: rows of ``large`` by key
    ``total``   rows of ``large``
    ``spread``  column of ``large`` that deals a heavy key's rows to its parts

    A key with more than a ``HEAVY``-th of all rows is cut into parts of that size, so there are at
    most ``HEAVY`` such keys, the bound of what is broadcast, and at most twice as many parts.
    """
    size = max(total / HEAVY, HEAVY_ROWS)
    parts = F.broadcast(counts.where(F.col("n") > size).select(on, F.ceil(F.col("n") / size).alias("_parts")))
    dealt = large.join(parts, on, "left").withColumn("_part", F.coalesce(F.pmod(F.xxhash64(spread), "_parts"), F.lit(0)))
    each = F.sequence(F.lit(0).cast("bigint"), F.coalesce("_parts", F.lit(1)) - 1)
    copied = small.join(parts, on, "left").withColumn("_part", F.explode(each))
    return dealt.drop("_parts").join(copied.drop("_parts"), [on, "_part"]).drop("_part")


def repeated_lines(glosses: DataFrame, key: str = "key", gloss: str = "gloss", min_words: int = MIN_WORDS) -> DataFrame:
    """``key, lines``: the numbers, from 0, of the lines of each gloss that repeat passages of earlier ones.

    See ``remove_repeated_lines`` for the rules. Only glosses with such lines come back.
    """
    def describe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, 512):
                part = batch.slice(start, 512)
                lines, words, seeds = [], [], []
                for text in part.column("gloss"):
                    split = text.as_py().split("\n")
                    h, n = [line_hash(x) for x in split], [len(x.split()) for x in split]
                    kept = [i for i, k in enumerate(n) if k]
                    lines.append(np.array([h[i] for i in kept] + kept, np.int64).tobytes())
                    words.append([n[i] for i in kept])
                    seeds.append(list({p[0] for p in passages([h[i] for i in kept], words[-1], min_words)}))
                yield pa.RecordBatch.from_arrays(
                    [part.column("key"), pa.array(lines, pa.binary()), pa.array(words, pa.list_(pa.int32())),
                     pa.array(seeds, pa.list_(pa.int64()))], ["key", "lines", "words", "seeds"],
                )

    picked = glosses.select(F.col(key).cast("bigint").alias("key"), F.col(gloss).alias("gloss")).where("key IS NOT NULL AND gloss IS NOT NULL")
    held = staged(picked.mapInArrow(bare(describe), "key bigint, lines binary, words array<int>, seeds array<bigint>"), "lines")
    occurs = held.select("key", F.explode("seeds").alias("seed"))
    classes = occurs.groupBy("seed").agg(F.min("key").alias("first"), F.max("key").alias("last"), F.count("*").alias("n"))
    classes = staged(classes.where("first < last").drop("last"), "passage-classes")
    total = classes.agg(F.sum("n")).first()[0] or 0
    met = heavy_join(occurs, classes.select("seed", "first"), "seed", classes.select("seed", "n"), total, "key")
    pairs = staged(met.where("key > first").select("first", "key").distinct(), "overlaps")
    members = staged(pairs.groupBy("first").agg(F.count("*").alias("n")), "members")
    total = members.agg(F.sum("n")).first()[0] or 0

    def align(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = []
            for x, y, a_words, words in zip(*(batch.column(c) for c in ("x", "lines", "u", "words")), strict=True):
                a, b = (np.frombuffer(s.as_py(), np.int64) for s in (x, y))
                half = len(b) // 2
                places = common_lines(a[:len(a) // 2].tolist(), b[:half].tolist(), a_words.as_py(), words.as_py(), min_words)
                found.append(b[half:][places].tolist())
            yield pa.RecordBatch.from_arrays([batch.column("key"), pa.array(found, pa.list_(pa.int64()))], ["key", "found"])

    # A later gloss's lines go to its representatives, so those of a representative travel once a part and not once a copy.
    earlier = held.join(members.select(F.col("first").alias("key")), "key", "left_semi")
    earlier = earlier.select(F.col("key").alias("first"), F.col("lines").alias("x"), F.col("words").alias("u"))
    later = pairs.join(held.select("key", "lines", "words"), "key")
    both = heavy_join(later, earlier, "first", members, total, "key").select("key", "x", "u", "lines", "words")
    aligned = both.mapInArrow(bare(align), "key bigint, found array<bigint>")
    each = aligned.select("key", F.explode("found").alias("line")).distinct()
    return each.groupBy("key").agg(F.sort_array(F.collect_list("line")).alias("lines"))


def remove_repeated_lines(glosses: DataFrame, key: str = "key", gloss: str = "gloss", min_words: int = MIN_WORDS) -> DataFrame:
    """Every row of ``glosses`` with its gloss less the passages of earlier ones, and ``removed``, their number of lines.

    ``key``        bigint; the order of keys says which gloss is the earlier one
    ``min_words``  words in a block of lines below which it stays

    Lines are compared without regard to case and spacing, and blank lines belong to no block; a
    blank line goes only if the text becomes empty. A passage's first gloss keeps it. A gloss that
    has nothing new becomes empty. Rows of one key are one record: they do not shorten each other,
    and their texts lose the lines of the same numbers, so keys should be unique. Rows with a NULL
    key or gloss come back as they are and shorten nothing. Repeats inside one gloss stay. An
    empty table stays empty. All other columns come back unchanged, but for one named ``removed``,
    which is replaced.
    """
    gone = repeated_lines(glosses, key, gloss, min_words)

    def mask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for lines in batch.column("lines").to_pylist():
                drop = np.zeros(lines[-1] + 1, bool)
                drop[lines] = True
                out.append(drop)
            yield pa.RecordBatch.from_arrays([batch.column("key"), pa.array(out, pa.list_(pa.bool_()))], ["__key", "__drop"])

    drop = gone.mapInArrow(bare(mask), "__key bigint, __drop array<boolean>")
    joined = glosses.drop("removed").join(drop, F.col(key).cast("bigint") == F.col("__key"), "left")
    kept = F.filter(F.split(F.col(gloss), "\n", -1), lambda _, i: ~F.coalesce(F.get("__drop", i), F.lit(False)))
    text = F.concat_ws("\n", kept)
    text = F.when(F.trim(F.translate(text, "\n\t\r", "   ")) == "", F.lit("")).otherwise(text)
    whole = F.when(F.col("__drop").isNull(), F.col(gloss)).otherwise(text)
    columns = [whole.alias(c) if c == gloss else F.col(c) for c in glosses.columns if c != "removed"]
    return joined.select(*columns, F.coalesce(F.size(F.filter("__drop", lambda x: x)), F.lit(0)).alias("removed"))
