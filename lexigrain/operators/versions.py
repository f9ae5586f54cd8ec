"""Content fingerprint, publish decision and version numbers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import date_to_revision

# Fixed value: the form of a revision.
REVISION = r"\A([0-9]{4})\.([0-9]{2})\.([0-9]{2})(?:\.([0-9]+))?\z"

_LANE_BITS = 32
_LANES = 8


def canonical(*columns: str) -> Column:
    """A row as JSON with sorted field names; NULLs are written out."""
    return F.to_json(F.struct(*sorted(columns)), {"ignoreNullFields": "false"})


def _lane_sums(digest: str) -> list[Column]:
    width = _LANE_BITS // 4
    return [
        F.sum(F.conv(F.substring(digest, 1 + i * width, width), 16, 10).cast("decimal(18,0)")).alias(f"l{i}") for i in range(_LANES)
    ]


def _lane_print() -> Column:
    """The digest of lane sums and a number of rows, in columns ``l0 …`` and ``rows``."""
    modulus = F.lit(2**_LANE_BITS).cast("decimal(18,0)")
    text = [
        F.lpad(F.lower(F.hex((F.coalesce(F.col(f"l{i}"), F.lit(0)) % modulus).cast("bigint"))), _LANE_BITS // 4, "0")
        for i in range(_LANES)
    ]
    return F.sha2(F.concat_ws(":", F.col("rows").cast("string"), *text), 256)


def fingerprint(df: DataFrame, columns: list[str]) -> DataFrame:
    """One digest of a whole table, independent of row order and partitioning.

    Row digests are cut into lanes that are added modulo 2**32 (an additive multiset
    hash), and the sums and the row count are hashed once more. Sums combine in
    every task, so nothing is gathered or sorted. Leave dates and revisions out of
    ``columns``.
    """
    rows = df.select(F.sha2(canonical(*columns), 256).alias("d"))
    sums = rows.agg(F.count("*").alias("rows"), *_lane_sums("d"))
    return sums.select("rows", _lane_print().alias("fingerprint"))


def part_prints(df: DataFrame, domain: str, part: Column, columns: list[str] | None = None) -> DataFrame:
    """``domain, part, rows, fingerprint``: the digest of each part of a table.

    ``domain``  names the table, so that equal rows of two tables differ
    ``part``    what cuts it, such as a day or a bucket of its key; NULL is a part
    """
    rows = df.select(part.cast("string").alias("part"), F.sha2(F.concat(F.lit(f"{domain}:"), canonical(*(columns or df.columns))), 256).alias("d"))
    sums = rows.groupBy("part").agg(F.count("*").alias("rows"), *_lane_sums("d"))
    return sums.select(F.lit(domain).alias("domain"), "part", "rows", _lane_print().alias("fingerprint"))


def refreshed(known: DataFrame, now: DataFrame, changed: DataFrame) -> DataFrame:
    """Prints of the parts read again, and the known ones of all others.

    ``now``      prints of the changed parts only
    ``changed``  ``domain, part`` of every part that was read again, also of those that are gone
    """
    keys = changed.select(F.col("domain").alias("_d"), F.col("part").alias("_p")).distinct()
    same = (F.col("domain") == F.col("_d")) & F.col("part").eqNullSafe(F.col("_p"))
    return known.join(keys, same, "left_anti").unionByName(now)


def combined(parts: DataFrame) -> DataFrame:
    """One row ``rows, fingerprint`` over the parts of all domains, by way of one digest a domain.

    The parts' digests, each with its part's name, add up in lanes like rows; what is hashed at the
    end are the domains in order, few by nature.
    """
    named = parts.select("domain", F.col("rows").alias("_rows"), F.sha2(canonical("part", "rows", "fingerprint"), 256).alias("d"))
    sums = named.groupBy("domain").agg(F.sum("_rows").cast("bigint").alias("_rows"), F.count("*").alias("rows"), *_lane_sums("d"))
    domains = sums.select("_rows", F.struct("domain", _lane_print().alias("fingerprint")).alias("s"))
    lines = F.transform(F.sort_array(F.collect_list("s")), lambda s: F.concat_ws("=", s["domain"], s["fingerprint"]))
    return domains.agg(F.coalesce(F.sum("_rows"), F.lit(0)).alias("rows"), F.sha2(F.array_join(lines, "\n"), 256).alias("fingerprint"))


def decide_revision(current: DataFrame) -> DataFrame:
    """Add ``revision`` to rows ``fingerprint, day, previous_fingerprint, previous_revision``.

    NULL when nothing changed; the day's revision otherwise, with the next suffix
    when that day already has one.
    """
    base = date_to_revision("day")
    previous = F.col("previous_revision")
    suffix = F.regexp_extract(previous, r"\A[0-9]{4}\.[0-9]{2}\.[0-9]{2}\.([0-9]+)\z", 1)
    same_day = (previous == base) | F.startswith(previous, F.concat(base, F.lit(".")))
    bumped = F.concat(base, F.lit("."), (F.coalesce(suffix.try_cast("bigint"), F.lit(0)) + 1).cast("string"))
    revision = (
        F.when(F.col("fingerprint") == F.col("previous_fingerprint"), F.lit(None).cast("string"))
        .when(F.coalesce(same_day, F.lit(False)), bumped)
        .otherwise(base)
    )
    return current.withColumn("revision", revision)


def revision_key(c) -> Column:
    """(year, month, day, suffix) of a revision; NULL when it is malformed or its suffix passes 64 bits."""
    c = F.col(c) if isinstance(c, str) else c
    y, m, d, n = (F.regexp_extract(c, REVISION, i) for i in range(1, 5))
    suffix = F.when(n == "", F.lit(0).cast("bigint")).otherwise(n.try_cast("bigint"))
    key = F.struct(y.try_cast("int").alias("y"), m.try_cast("int").alias("m"), d.try_cast("int").alias("d"), suffix.alias("n"))
    return F.when(c.rlike(REVISION) & suffix.isNotNull(), key)


def next_version(ledger: DataFrame, days: DataFrame) -> DataFrame:
    """Next revision for each ``day``; ``late`` when the ledger has a later day.

    ``ledger`` holds ``revision``. Exposed days are one small row each; a day's
    suffixes meet by equality, and lateness needs only the latest day.
    """
    keys = ledger.select(revision_key("revision").alias("k")).where("k is not null")
    per_day = keys.groupBy("k.y", "k.m", "k.d").agg(F.max("k.n").alias("last"))
    named = per_day.select(F.format_string("%04d.%02d.%02d", "y", "m", "d").alias("base"), "last")
    latest = named.agg(F.max("base")).scalar()
    both = days.select("day", date_to_revision("day").alias("base")).join(named, "base", "left")
    late = F.coalesce(latest > F.col("base"), F.lit(False))
    nxt = F.when(F.col("last").isNull(), F.col("base")).otherwise(
        F.concat(F.col("base"), F.lit("."), (F.col("last") + 1).cast("string"))
    )
    return both.select("day", F.when(~late, nxt).alias("revision"), late.alias("late"))


def monotonic(candidates: DataFrame, ledger: DataFrame) -> DataFrame:
    """For each candidate ``revision``: is it above, or below, all exposed ones."""
    top = ledger.select(revision_key("revision").alias("k")).agg(F.max("k")).scalar()
    both = candidates.withColumn("top", top).withColumn("k", revision_key("revision"))
    return both.select(
        "revision",
        F.coalesce(F.col("k") > F.col("top"), F.col("top").isNull() & F.col("k").isNotNull()).alias("fresh"),
        F.coalesce(F.col("top") > F.col("k"), F.lit(False)).alias("newer_exposed"),
    )
