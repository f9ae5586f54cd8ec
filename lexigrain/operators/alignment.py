"""Reading options and the unique-segmentation join."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import (
    GEMINATE, GEMINATING_LAST, H_FIRST, P_FIRST, PLAIN_FIRST, REPEAT_MARK, VOICED_FIRST,
    HAN_CLASS, SPACE_CLASS, as_col, kana_fold, nfkc_each,
)
from ..functions.weights import rank_weight
from .skew import salted_join

def longest_first(xs) -> Column:
    """Distinct options, longest first, then by value."""
    keyed = F.transform(F.array_distinct(as_col(xs)), lambda x: F.struct((-F.length(x)).alias("l"), x.alias("v")))
    return F.transform(F.sort_array(keyed), lambda s: s["v"])


def _kana_only(x: Column) -> Column:
    return kana_fold(F.regexp_replace(x, r"[^\u3040-\u30ff.]", ""))


def _variants(x: Column) -> Column:
    first, rest = F.substring(x, 1, 1), F.substr(x, F.lit(2))
    last = F.right(x, F.lit(1))
    voiced = F.when(F.translate(first, PLAIN_FIRST, "") == "", F.concat(F.translate(first, PLAIN_FIRST, VOICED_FIRST), rest))
    half = F.when(F.translate(first, H_FIRST, "") == "", F.concat(F.translate(first, H_FIRST, P_FIRST), rest))
    stopped = F.when(
        (F.length(x) >= 2) & (F.translate(last, GEMINATING_LAST, "") == ""),
        F.concat(F.left(x, F.length(x) - 1), F.lit(GEMINATE)),
    )
    return F.array(voiced, half, stopped)


def compositional_options(on, kun, allowed) -> Column:
    """Readings a key may take inside a compound.

    Dictionary stems and their sound variants (voiced, half-voiced, geminated), as
    far as the key's own reading labels allow them.
    """
    on_stems = F.transform(nfkc_each(on), lambda x: F.replace(_kana_only(x), F.lit("."), F.lit("")))
    kun_stems = F.transform(nfkc_each(kun), lambda x: F.substring_index(_kana_only(x), ".", 1))
    stems = F.array_distinct(F.filter(F.concat(on_stems, kun_stems), lambda x: x != ""))
    variants = F.filter(F.flatten(F.transform(stems, _variants)), lambda x: x.isNotNull())
    return longest_first(F.array_intersect(F.concat(stems, variants), as_col(allowed)))


# A character that no literal can be, and so the sign of one.
STOP = "一"

# One token per character: a key with its options, a literal, or a stop.
_TOKENS = f"""
aggregate(
  chars,
  named_struct(
    'prev', cast(null as struct<key:string, alone:array<string>, compound:array<string>>),
    'tokens', cast(array() as array<struct<key:string, alone:array<string>, compound:array<string>>>)),
  (acc, c) -> case
    when c.alone is not null then named_struct(
      'prev', named_struct('key', c.ch, 'alone', c.alone, 'compound', c.compound),
      'tokens', acc.tokens || array(named_struct('key', c.ch, 'alone', c.alone, 'compound', c.compound)))
    when c.ch = '{REPEAT_MARK}' and acc.prev is not null then named_struct(
      'prev', acc.prev, 'tokens', acc.tokens || array(acc.prev))
    else named_struct(
      'prev', cast(null as struct<key:string, alone:array<string>, compound:array<string>>),
      'tokens', acc.tokens || array(named_struct(
        'key', cast(null as string),
        'alone', if(c.literal = '{STOP}', array(), array(c.literal)),
        'compound', cast(null as array<string>))))
  end,
  acc -> acc.tokens)
"""

# A key next to another key takes its compound options.
_STEPS = """
transform(tokens, (t, i) -> named_struct(
  'idx', i, 'key', t.key,
  'options', if(
    t.key is not null and ((i > 0 and get(tokens, i - 1).key is not null) or get(tokens, i + 1).key is not null),
    coalesce(t.compound, array()), t.alone)))
"""

# Partial segmentations that have consumed the same part of the reading are one state:
# one way to get there, and whether there is another. So a row has at most one state
# per character of its reading, and uniqueness is exact.
_STATES = "array<struct<used:int, ways:int, picks:array<struct<idx:int, key:string, reading:string>>>>"
_ALIGN = f"""
filter(
  aggregate(
    steps,
    array(named_struct('used', 0, 'ways', 1, 'picks', cast(array() as array<struct<idx:int, key:string, reading:string>>))),
    (states, t) -> aggregate(
      array(flatten(transform(states, s -> transform(
        filter(t.options, o -> startswith(substr(reading, s.used + 1), o)),
        o -> named_struct(
          'used', s.used + length(o),
          'ways', s.ways,
          'picks', if(t.key is null, s.picks,
                      s.picks || array(named_struct('idx', t.idx, 'key', t.key, 'reading', o)))))))),
      cast(array() as {_STATES}),
      (none, next) -> if(size(next) < 2, next, transform(
        array_distinct(transform(next, s -> s.used)),
        u -> aggregate(
          filter(next, s -> s.used = u),
          named_struct('used', u, 'ways', 0, 'picks', cast(null as array<struct<idx:int, key:string, reading:string>>)),
          (m, s) -> named_struct('used', u, 'ways', least(2, m.ways + s.ways), 'picks', coalesce(m.picks, s.picks))))))),
  s -> s.used = length(reading) and s.ways = 1)
"""


def _parts(longest: str, most: str) -> Column:
    """Parts of ``reading`` as long as options are, where they are fewer than the options of a key may be."""
    starts = F.sequence(F.lit(1), F.length("reading") + 1)
    lengths = F.sequence(F.lit(1), F.greatest(F.col(longest), F.lit(1)))
    parts = F.flatten(F.transform(starts, lambda s: F.transform(lengths, lambda n: F.substring("reading", s, n))))
    return F.when((F.length("reading") + 1) * F.col(longest) < F.col(most), parts)


def _occurring(options: str) -> Column:
    """The distinct options that occur in ``reading``, in their order.

    Options are looked up among the parts of the reading, so that a key may have many; a few are searched for.
    """
    looked_up = F.array_intersect(F.col(options), F.col("_parts"))
    searched = F.filter(options, lambda o: F.contains("reading", o))
    return F.when(F.col("_parts").isNotNull() & (F.size(options) > F.size("_parts")), looked_up).otherwise(searched)


def surface_chars(rows: DataFrame, options: DataFrame) -> DataFrame:
    """Rows with ``chars``: each surface character with the options of its key, if any.

    ``options`` holds ``key, alone, compound``. Rows must be unique by
    (surface, reading, rank); regrouping gathers one surface, at most its length.
    """
    lengths = F.array_max(F.transform(F.concat(*(F.coalesce(c, F.array().cast("array<string>")) for c in ("alone", "compound"))), F.length))
    sizes = F.greatest(F.size("alone"), F.size("compound"))
    facts = options.agg(F.struct(F.max(lengths).alias("longest"), F.max(sizes).alias("most"))).scalar()
    parts = rows.withColumn("_facts", facts).select("surface", "reading", "rank", _parts("_facts.longest", "_facts.most").alias("_parts"))
    chars = parts.select("*", F.posexplode(F.split("surface", "")).alias("pos", "ch"))
    met = salted_join(chars, options.withColumnRenamed("key", "ch"), ["ch"], "left")
    # Options that do not occur in the reading can never be consumed and need not travel; nor need characters without any.
    # They are left out in a step of their own: rows that are sorted to be grouped must not hold all options of a key.
    alone, compound = (_occurring(c).alias(c) for c in ("alone", "compound"))
    known = F.when(F.col("alone").isNotNull() | F.col("compound").isNotNull(), F.struct("pos", alone, compound))
    slim = met.select("surface", "reading", "rank", known.alias("known"))
    # Literals of a whole surface at once: a Han character, such as STOP, stands for what none can be made of.
    literals = F.split(F.regexp_replace(kana_fold("surface"), f"[{HAN_CLASS}{SPACE_CLASS}]", STOP), "")
    gathered = F.collect_list("known")

    def place(ch, pos):
        return F.struct(ch.alias("ch"), F.get(F.filter(gathered, lambda k: k["pos"] == pos), 0).alias("own"))

    def char(c, literal):
        return F.struct(
            c["ch"].alias("ch"), c["own"]["alone"].alias("alone"), c["own"]["compound"].alias("compound"), literal.alias("literal"),
        )

    # Put together where rows are grouped: in a step after it, a filter on what follows would do it again.
    chars = F.zip_with(F.transform(F.split("surface", ""), place), literals, char)
    return slim.groupBy("surface", "reading", "rank").agg(chars.alias("chars"))


def surface_tokens(chars: DataFrame) -> DataFrame:
    """Add ``steps``: per character its index, key and usable options."""
    return chars.withColumn("tokens", F.expr(_TOKENS)).withColumn("steps", F.expr(_STEPS)).drop("tokens")


def align(rows: DataFrame, options: DataFrame, max_rank: int | None = None) -> DataFrame:
    """Attribute each row's reading to the keys of its surface.

    ``relevant`` tells whether the surface holds a known key. ``alignment`` is the
    array of (idx, key, reading) when exactly one complete segmentation consumes
    the whole reading, else NULL. ``weight`` comes from the rank; past ``max_rank`` it is 0.
    """
    steps = surface_tokens(surface_chars(rows, options))
    relevant = F.exists("steps", lambda t: t["key"].isNotNull())
    tried = steps.withColumn("relevant", relevant).withColumn(
        "full", F.when(F.col("relevant"), F.expr(_ALIGN))
    )
    return tried.select(
        "surface", "reading", "rank", "relevant",
        rank_weight("rank", max_rank).alias("weight"),
        F.when(F.size("full") == 1, F.col("full")[0]["picks"]).alias("alignment"),
    )


def assignments(aligned: DataFrame) -> DataFrame:
    """Distinct (key, reading) of every aligned row, with the row's rank and weight."""
    pairs = F.array_distinct(F.transform("alignment", lambda a: F.struct(a["key"].alias("key"), a["reading"].alias("reading"))))
    return (
        aligned.where(F.col("alignment").isNotNull() & (F.col("weight") > 0))
        .select("rank", "weight", F.explode(pairs).alias("p"))
        .select("rank", "weight", "p.key", "p.reading")
    )
