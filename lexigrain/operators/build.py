"""The build: from sources to a published revision, closed against every failed gate."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ..functions import markup as M
from ..functions import variants as V
from ..session import staged
from ..sources import payloads as P
from ..sources import sinks
from . import alignment as A
from . import banks as B
from . import distribution as D
from . import families as FM
from . import gates as G
from . import publish as PB
from . import ranklist as R
from . import readings as RD
from . import records as RC
from . import scores as S
from . import snapshot as SN
from . import versions as VS

#: Parts that each table is cut into for its fingerprint.
PRINT_PARTS = 64
FILES = "path string, byte_count bigint, sha256 string"


@dataclass(frozen=True)
class Sources:
    """What a build reads.

    ``payloads``    ``key, v``: one JSON object per key; with ``path, byte_count, sha256`` where they were
                    read from files
    ``ranks``       raw ranked list ``Word, Form, Rank``
    ``fallback``    typed entries of the XML dictionary
    ``markup``      ``key, svg``
    ``rank_files``  ``path, byte_count, sha256`` of the files behind ``ranks``: what a failed coverage quarantines
    ``facts``       ``name, value``: what else ships, such as licences and the form of the package
    ``current``     from consumed ``path, sha256`` to what these files are now, asked right before the publish
    """

    payloads: DataFrame
    ranks: DataFrame
    fallback: DataFrame
    markup: DataFrame
    rank_files: DataFrame | None = None
    facts: DataFrame | None = None
    current: Callable[[DataFrame], DataFrame] | None = None


@dataclass(frozen=True)
class Limits:
    """What the gates demand; a figure that is None is not asked for."""

    floors: dict | None = None
    min_strokes: int | None = None
    top_rank: int | None = None
    rank_cutoff: int | None = None
    row_limits: dict | None = None
    max_rows: int | None = None
    max_rank: int | None = None


class Counts(dict):
    """Rows of each stage, observed while it is written."""

    def observed(self, df: DataFrame, name: str, **more: Column) -> tuple[DataFrame, Observation]:
        seen = Observation(name)
        return df.observe(seen, F.count(F.lit(1)).alias("rows"), *[c.alias(n) for n, c in more.items()]), seen

    def staged(self, df: DataFrame, name: str, **more: Column) -> DataFrame:
        watched, seen = self.observed(df, name, **more)
        out = staged(watched, name)
        self.update({name: seen.get["rows"], **{n: seen.get[n] for n in more}})
        return out


def reading_options(groups: DataFrame, records: DataFrame) -> DataFrame:
    """``key, alone, compound``: the readings a record's payload lists, and those it takes in compounds."""
    own = groups.groupBy("key").agg(A.longest_first(F.collect_list("reading")).alias("alone"))
    both = own.join(records.select("key", "on", "kun"), "key")
    return both.select("key", "alone", A.compositional_options("on", "kun", "alone").alias("compound"))


def content_prints(banks: dict[str, tuple[DataFrame, str]], facts: DataFrame | None = None) -> DataFrame:
    """``domain, part, rows, fingerprint`` over all that ships: banks, each with its key, and package facts.

    Whatever changes with the day alone, such as revisions and dates, must not be in them.
    """
    out = None
    for name, (bank, key) in banks.items():
        # Maps have no order of their own.
        plain = bank.select(*[F.sort_array(F.map_entries(c)).alias(c) if t.startswith("map<") else F.col(c) for c, t in bank.dtypes])
        prints = VS.part_prints(plain, name, F.pmod(F.xxhash64(key), F.lit(PRINT_PARTS)))
        out = prints if out is None else out.unionByName(prints)
    if facts is not None:
        out = out.unionByName(VS.part_prints(facts, "facts", F.col("name"), ["name", "value"]))
    return out


def build(
    spark: SparkSession, sources: Sources, target: str, day: str, limits: Limits = Limits(), ledger: str | None = None,
) -> DataFrame:
    """Build the banks and publish them at ``target``; returns ``stage, rows``.

    ``ledger``  where the consequences of failed gates are kept, if anywhere

    Stages: payloads, records, merged, ranked, aligned, scored, markup, families, terms, keys, meta,
    assets, written. Every gate is asked before the first write, so a violation raises and leaves no
    output. When the content's fingerprint is that of the published revision, nothing is written. Banks and
    manifest go to a folder beside it, over what an interrupted run left there; the pointer that readers
    follow is moved last, if the sources are still what was read.

    A rank list that fails its coverage is quarantined with its digest, and is refused until it has
    another one; too few stroke sets void the day's negative marks. The rows of each stage are observed
    while it is written.
    """
    counts = Counts()

    def gate(violations: DataFrame, what: str, consequence: DataFrame | None = None) -> None:
        try:
            G.require_none(violations, what)
        except G.GateError:
            if ledger is not None and consequence is not None:
                PB.append_entries(consequence, ledger)
            raise

    none = F.lit(None).cast("string")
    rank_files = None if sources.rank_files is None else staged(sources.rank_files.select("path", "byte_count", "sha256"), "rank-files")
    if ledger is not None and rank_files is not None:
        held = rank_files.select("path", "sha256").exceptAll(PB.usable(rank_files, PB.read_ledger(spark, ledger)).select("path", "sha256"))
        gate(held, "rank list is quarantined")

    docs = counts.staged(sources.payloads, "payloads")
    gate(P.rejected(docs), "payload is no strict JSON")
    gate(G.identity(docs.select("key", V.string_field("v", "$.character").alias("character"))), "payload answers with another key")

    records = counts.staged(RC.normalized(docs, limits.rank_cutoff), "records")
    if limits.top_rank is not None:
        gate(G.top_rank_quality(records, limits.top_rank), "frequent record is incomplete")

    checked = R.row_reasons(R.collapsed(sources.ranks), limits=limits.row_limits)
    valid = R.require_valid(checked, limits.max_rows)
    free = counts.staged(R.conflict_free(valid), "ranked")
    groups = staged(RC.reading_inventory(docs), "inventory")
    aligned = counts.staged(
        A.align(free, reading_options(groups, records), limits.max_rank), "all-aligned", aligned=F.count_if(F.col("alignment").isNotNull()),
    )
    scores = counts.staged(S.reading_scores(aligned, groups), "scored")
    stats = S.alignment_stats(aligned, scores)
    if limits.floors is not None:
        parsed = R.parse_stats(valid).drop("rows")
        both = stats.withColumn("_p", parsed.select(F.struct(*parsed.columns)).scalar()).select(*stats.columns, "_p.*")
        held = None if rank_files is None else rank_files.select(
            F.lit(PB.QUARANTINE).alias("kind"), "path", "sha256", F.lit(day).alias("dt"), F.lit("coverage").alias("reason"),
        )
        gate(G.coverage_checks(both, limits.floors, limits.max_rows).where("not ok"), "coverage", held)

    features = sources.markup.select(
        "key", M.stroke_count("svg").alias("strokes"), M.strokes("svg").alias("stroke_paths"),
        M.components("svg", "key").alias("components"), M.first_marker("svg", "key").alias("component"),
        M.rebuilt("svg").alias("asset"),
    ).where("strokes IS NOT NULL")
    features = counts.staged(features, "markup")
    if limits.min_strokes is not None:
        voided = spark.range(1).select(
            F.lit(PB.VOID).alias("kind"), none.alias("path"), none.alias("sha256"), F.lit(day).alias("dt"), F.lit("too few stroke sets").alias("reason"),
        )
        gate(G.minimum_count(features, limits.min_strokes), "too few stroke sets", voided)
    gate(sources.markup.select("key", F.explode(M.unsafe_hits(M.rebuilt("svg"))).alias("hit")), "unsafe markup")
    merged = RC.merge_priority(RC.with_scores(records, scores), RC.fallback_records(sources.fallback))
    merged = counts.staged(merged, "merged", primary=F.count_if(F.col("origin") == "primary"))
    ranks = merged.where("frequency_rank IS NOT NULL").select("key", F.col("frequency_rank").alias("rank"))
    members = FM.family_members(features.select("key", "component"), ranks)
    members = counts.staged(members, "families", components=F.count_if(F.col("ord") == 1))

    shares = D.labels(D.distribution(scores.withColumnRenamed("ord", "pos"), ["key"]), ["key"])
    places = members.select(F.col("member").alias("key"), "component", "ord", "size")
    cards = B.cards(merged, shares, places, features)
    terms = counts.staged(B.term_rows(cards, F.to_json(F.struct(*[c for c in cards.columns if c != "key"]))), "terms")
    keys = counts.staged(B.key_rows(merged), "keys")
    meta = counts.staged(B.meta_rows(merged), "meta")
    assets = counts.staged(features.select("key", "asset", F.sha2(F.col("asset").cast("binary"), 256).alias("sha256")), "assets")
    gate(G.term_shape(terms), "term bank")
    gate(G.meta_shape(meta), "meta bank")

    banks = {"terms": (terms, "expression"), "keys": (keys, "character"), "meta": (meta, "term"),
             "families": (members, "component"), "assets": (assets, "key")}
    printed = banks | {"assets": (assets.select("key", "sha256"), "key")}
    prints = staged(content_prints(printed, sources.facts), "prints")
    state = PB.previous_state(spark, target).select(F.struct("revision", "fingerprint")).scalar()
    known = VS.combined(prints).select("fingerprint", F.lit(day).alias("day"), state.alias("s")).select(
        "fingerprint", "day", F.col("s.revision").alias("previous_revision"), F.col("s.fingerprint").alias("previous_fingerprint"),
    )
    decided = VS.decide_revision(known).select("revision", "fingerprint").first()
    counts["written"] = 0
    if decided["revision"] is not None:
        folder = f"{target}/{decided['revision']}"
        for name, (bank, key) in banks.items():
            sinks.write_bank(bank, f"{folder}/{name}", key)
            counts["written"] += 1
        sinks.write_bank(prints, f"{folder}/prints", "domain")
        found = spark.createDataFrame([(
            counts["merged"], counts["primary"], counts["merged"] - counts["primary"], counts["markup"], counts["components"], counts["assets"],
        )], "total long, primary long, fallback long, strokes long, families long, assets long")
        revision = spark.createDataFrame([tuple(decided)], "revision string, fingerprint string")
        facts = B.manifest(found, revision, stats.select("aligned_rows", "relevant_rows", "keys_with_scores"))
        facts.coalesce(1).write.mode("overwrite").text(f"{folder}/manifest")
        if sources.current is not None:
            consumed = [docs.select("path", "sha256")] if "sha256" in docs.columns else []
            consumed += [rank_files.select("path", "sha256")] if rank_files is not None else []
            for read in consumed:
                gate(SN.changed_since(read, sources.current(read)), "source changed while it was read")
        PB.point_to(spark, target, decided["revision"], decided["fingerprint"], decided["revision"])

    order = ("payloads", "records", "merged", "ranked", "aligned", "scored", "markup", "families", "terms", "keys", "meta", "assets", "written")
    return spark.createDataFrame([(name, counts[name]) for name in order], "stage string, rows long")
