"""Example words of a key: greedy choice per group, fallback, best overall."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import variants as V
from ..functions.text import clean_text, ruby_segments
from .ranking import top_n

# Selection limits.
MAX_GROUPS = 3
MAX_PER_GROUP = 2
MAX_GLOBAL = 6

WORD_MEMBERS = ("reading", "readingFurigana", "mainDefinition", "frequencyRank", "wordId", "readingIndex")
WORD_COLUMNS = ("surface", "gloss", "rank", "ruby", "word_id", "reading_index")
ITEM = ["word_id", "reading_index"]


def clean_examples(words: DataFrame, *keep: str, rank_cutoff: int | None = None) -> DataFrame:
    """Typed columns of the usable words in ``w`` (VARIANT), next to the columns to keep.

    A word needs a surface, a gloss, a rank (within the cutoff, if there is one), well-formed ruby and an
    id. Types and the rank are tested before any text is cleaned. Each step builds its
    row once and generates it only when usable; a plain filter would be pushed down and
    compute the columns it tests a second time.
    """
    raw = words.select(*keep, V.members("w", *WORD_MEMBERS).alias("m"))
    typed = F.struct(
        V.only_string("m.reading").alias("surface"),
        V.only_string("m.mainDefinition").alias("gloss"),
        V.only_int("m.frequencyRank").alias("rank"),
        V.only_string("m.readingFurigana").alias("ruby"),
        V.only_int("m.wordId").alias("word_id"),
        F.coalesce(V.only_int("m.readingIndex"), F.lit(0).cast("bigint")).alias("reading_index"),
    )
    def ranks(r):
        return (r["rank"] >= 1) & (F.lit(True) if rank_cutoff is None else r["rank"] <= rank_cutoff)

    ranked = F.filter(F.array(typed), lambda r: ranks(r) & r["word_id"].isNotNull())
    clean = F.struct(
        clean_text("surface").alias("surface"), clean_text("gloss").alias("gloss"), "rank",
        ruby_segments("ruby").alias("ruby"), "word_id", "reading_index",
    )
    whole = F.filter(
        F.array(clean), lambda r: r["surface"].isNotNull() & r["gloss"].isNotNull() & r["ruby"].isNotNull()
    )
    return raw.select(*keep, F.inline(ranked)).select(*keep, F.inline(whole))


def payload_words(
    payloads: DataFrame, key: str = "key", usable: Column | None = None, rank_cutoff: int | None = None,
) -> DataFrame:
    """Every clean word of payload rows ``(key, v)``, of those that are ``usable``.

    ``grp`` is the position of the reading group, -1 for the key's top words;
    ``label`` is the group's clean reading (NULL when unusable). Top words travel as
    one more group, so that a payload is read once.
    """
    top = F.struct(
        F.lit(-1).alias("grp"), F.lit(None).cast("variant").alias("reading"), V.field("v", "$.topWords").alias("words")
    )

    def group(g, i):
        return F.struct(
            i.alias("grp"), V.field(g, "$.reading").alias("reading"), V.field(g, "$.words").alias("words")
        )

    groups = F.concat(F.array(top), F.transform(V.elements("v", "$.wordsByReading"), group))
    if usable is not None:
        groups = F.when(usable, groups)
    words = payloads.select(key, F.inline(groups)).select(
        key, "grp", clean_text(V.only_string("reading")).alias("label"),
        F.posexplode(V.elements("words", "$")).alias("pos", "w"),
    )
    return clean_examples(words, key, "grp", "label", "pos", rank_cutoff=rank_cutoff)


def greedy_groups(
    words: DataFrame,
    key: list[str],
    group: list[str],
    item: list[str],
    rank: str = "rank",
    pos: str = "pos",
    payload: tuple[str, ...] = (),
    max_groups: int = MAX_GROUPS,
    per_group: int = MAX_PER_GROUP,
) -> DataFrame:
    """Per key, up to ``max_groups`` groups with up to ``per_group`` unseen items each.

    Groups go by their best rank; an item counts as seen once it is taken. Result
    rows: key, ``ord`` of the group, its columns, ``place`` in it and the item.

    Everything is bounded before it is gathered, without changing the result. At
    most ``seen = per_group * (max_groups - 1)`` items are taken before the last
    group is chosen, so ``seen + per_group`` items of a group decide its share. A
    group is passed over only when all its items are among the taken ones; groups
    with equal item sets are passed over together after the first, and the taken
    items have ``2 ** seen - 1`` subsets.
    """
    seen = per_group * (max_groups - 1)
    reach = max_groups * 2**seen
    first = words.groupBy(*key, *group, *item).agg(F.min(F.struct(rank, pos, *payload)).alias("_w"))
    short = top_n(first, [*key, *group], [F.asc("_w")], seen + per_group, "_n")
    entry = F.struct(F.col("_w").alias("w"), F.struct(*item).alias("item"))
    lists = (
        short.groupBy(*key, *group)
        .agg(F.sort_array(F.collect_list(entry)).alias("ws"))
        .withColumn("best", F.col("ws")[0]["w"][rank])
        .withColumn("_set", F.sort_array(F.transform("ws", lambda x: x["item"])))
    )
    order = [F.asc("best"), *map(F.asc, group)]
    lists = top_n(lists, [*key, "_set"], order, max_groups, "_n").drop("_n", "_set")
    lists = top_n(lists, key, order, reach, "_n").drop("_n")
    gathered = lists.groupBy(*key).agg(
        F.sort_array(F.collect_list(F.struct("best", F.struct(*group).alias("g"), "ws"))).alias("gs")
    )
    chosen = F.expr(f"""
        aggregate(
          gs,
          named_struct('seen', slice(transform(flatten(gs.ws), x -> x.item), 1, 0), 'out', slice(gs, 1, 0)),
          (acc, g) -> if(
            size(acc.out) >= {max_groups}, acc,
            aggregate(
              array(slice(filter(g.ws, x -> not array_contains(acc.seen, x.item)), 1, {per_group})),
              acc,
              (a, ws) -> if(size(ws) = 0, a, named_struct(
                'seen', a.seen || transform(ws, x -> x.item),
                'out', a.out || array(named_struct('best', g.best, 'g', g.g, 'ws', ws)))))),
          acc -> acc.out)
    """)
    rows = gathered.select(*key, F.posexplode(chosen).alias("ord", "r"))
    rows = rows.select(*key, "ord", "r.g.*", F.posexplode("r.ws").alias("place", "x"))
    return rows.select(
        *key, (F.col("ord") + 1).cast("bigint").alias("ord"), *group,
        (F.col("place") + 1).cast("bigint").alias("place"), "x.item.*", "x.w.*",
    )


def fallback_items(
    top: DataFrame, chosen: DataFrame, key: list[str], item: list[str],
    rank: str = "rank", pos: str = "pos", payload: tuple[str, ...] = (), limit: int = MAX_GROUPS,
) -> DataFrame:
    """Best distinct items of the keys the greedy choice left empty."""
    first = top.groupBy(*key, *item).agg(F.min(F.struct(rank, pos, *payload)).alias("_w"))
    best = top_n(first, key, [F.asc("_w")], limit, "place")
    left = best.join(chosen.select(*key).distinct(), key, "left_anti")
    return left.select(*key, F.col("place").cast("bigint").alias("place"), *item, "_w.*")


def best_per_item(
    words: DataFrame, key: list[str], item: list[str], order: tuple[str, ...], payload: tuple[str, ...] = ()
) -> DataFrame:
    """One row per item: the least by ``order``."""
    best = words.groupBy(*key, *item).agg(F.min(F.struct(*order, *payload)).alias("_w"))
    return best.select(*key, *item, "_w.*")


def global_top(words: DataFrame, key: str = "key", limit: int = MAX_GLOBAL) -> DataFrame:
    """The best distinct words of a key over all of its groups."""
    best = best_per_item(words, [key], ITEM, ("rank", "surface", "gloss", "grp", "pos"), ("ruby",))
    order = ["rank", *ITEM, "surface", "gloss"]
    return top_n(best, [key], [F.asc(c) for c in order], limit)


def minus_shown(words: DataFrame, shown: DataFrame, key: list[str], item: list[str]) -> DataFrame:
    """Words that are not among those shown elsewhere for the same key."""
    return words.join(shown.select(*key, *item), [*key, *item], "left_anti")


def select_examples(words: DataFrame, key: str = "key") -> DataFrame:
    """Example groups of payload words: greedy over reading groups, else top words.

    Columns: key, ``ord, label, place`` and the word; the fallback has label ''.
    """
    grouped = words.where((F.col("grp") >= 0) & F.col("label").isNotNull())
    kept = ("surface", "gloss", "ruby")
    chosen = greedy_groups(grouped, [key], ["grp", "label"], ITEM, payload=kept)
    spare = fallback_items(words.where("grp = -1"), chosen, [key], ITEM, payload=kept)
    columns = [key, "ord", "label", "place", *WORD_COLUMNS]
    spare = spare.withColumn("ord", F.lit(1).cast("bigint")).withColumn("label", F.lit(""))
    return chosen.select(*columns).unionByName(spare.select(*columns))


def _first_items(xs: str, n: int) -> str:
    """The first ``n`` entries of a sorted array that are not of the same item."""
    return f"""aggregate({xs}, slice({xs}, 1, 0), (acc, x) -> if(
        size(acc) >= {n} or exists(acc, y -> y.word_id = x.word_id and y.reading_index = x.reading_index), acc, acc || array(x)))"""


_BY_RANK = (
    "rank:bigint,pos:int,surface:string,gloss:string,ruby:array<struct<base:string,reading:string>>,word_id:bigint,"
    "reading_index:bigint,grp:int,label:string"
)
_WORD = "named_struct('surface', x.surface, 'gloss', x.gloss, 'rank', x.rank, 'ruby', x.ruby, 'word_id', x.word_id, 'reading_index', x.reading_index)"


def examples_in_row(words: DataFrame, key: str = "key") -> DataFrame:
    """``key, picked, global_words``: ``select_examples`` and ``global_top`` for words of payload rows.

    All words of a key come from one payload, so they are gathered once, as many as that row
    holds, and both choices are made inside the row. ``picked`` is an array of (label, words).
    """
    seen = MAX_PER_GROUP * (MAX_GROUPS - 1)
    by_rank = F.struct("rank", "pos", "surface", "gloss", "ruby", *ITEM, "grp", "label")
    by_item = F.struct("rank", *ITEM, "surface", "gloss", "grp", "pos", "ruby")
    rows = words.groupBy(key).agg(F.sort_array(F.collect_list(by_rank)).alias("ws"), F.sort_array(F.collect_list(by_item)).alias("best"))
    rows = rows.withColumn("gs", F.expr(f"""
        sort_array(transform(
          array_distinct(transform(filter(ws, x -> x.grp >= 0 and x.label is not null), x -> named_struct('grp', x.grp, 'label', x.label))),
          g -> aggregate(
            array(filter(ws, x -> x.grp = g.grp and x.label = g.label)),
            cast(null as struct<best:bigint,grp:int,label:string,ws:array<struct<{_BY_RANK}>>>),
            (none, own) -> named_struct('best', own[0].rank, 'grp', g.grp, 'label', g.label, 'ws', {_first_items("own", seen + MAX_PER_GROUP)}))))
    """))
    rows = rows.withColumn("taken", F.expr(f"""
        aggregate(
          gs,
          named_struct('seen', slice(flatten(gs.ws), 1, 0), 'out', slice(gs, 1, 0)),
          (acc, g) -> if(size(acc.out) >= {MAX_GROUPS}, acc, aggregate(
            array(slice(filter(g.ws, x -> not exists(acc.seen, y -> y.word_id = x.word_id and y.reading_index = x.reading_index)), 1, {MAX_PER_GROUP})),
            acc,
            (a, fresh) -> if(size(fresh) = 0, a, named_struct(
              'seen', a.seen || fresh,
              'out', a.out || array(named_struct('best', g.best, 'grp', g.grp, 'label', g.label, 'ws', fresh)))))),
          acc -> acc.out)
    """))
    spare = _first_items("filter(ws, x -> x.grp = -1)", MAX_GROUPS)
    return rows.select(
        key,
        F.expr(f"""if(size(taken) > 0,
            transform(taken, g -> named_struct('label', g.label, 'words', transform(g.ws, x -> {_WORD}))),
            transform(filter(array({spare}), s -> size(s) > 0), s -> named_struct('label', '', 'words', transform(s, x -> {_WORD}))))
        """).alias("picked"),
        F.expr(f"transform({_first_items('best', MAX_GLOBAL)}, x -> {_WORD})").alias("global_words"),
    )
