"""Data-quality gates. A gate is a table of violations; ``require_none`` makes it fail."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import as_col
from ..functions.variants import field

# Production floors and limits of the coverage gate.
FLOORS = {
    "rows": 400_000, "relevant_rows": 250_000, "aligned_rows": 180_000, "keys_with_scores": 3_500,
    "weight_coverage": 0.85,
}
TOP_RANK = 1_000
META_TYPES = ("freq", "pitch", "ipa")
COVERAGE_TOLERANCE = 1e-12


class GateError(ValueError):
    """A gate found violations."""


def require_none(violations: DataFrame, what: str) -> None:
    """Fail before anything is written when there is a violation."""
    first = violations.limit(1).collect()
    if first:
        raise GateError(f"{what}: {first[0].asDict()}")


def identity(payloads: DataFrame, key: str = "key", own: str = "character") -> DataFrame:
    """Payloads whose own key is not the requested one."""
    return payloads.where(~F.col(key).eqNullSafe(F.col(own)))


def top_rank_quality(records: DataFrame, limit: int = TOP_RANK) -> DataFrame:
    """Frequent records that lack a keyword, a reading or an example."""
    whole = (
        (F.coalesce("keyword", F.lit("")) != "")
        & ((F.size("on") > 0) | (F.size("kun") > 0))
        & (F.size("examples") > 0)
    )
    return records.where((F.col("frequency_rank") <= limit) & ~whole)


def coverage_checks(
    stats: DataFrame, floors: dict = FLOORS, max_rows: int | None = None, max_keys_per_row: int | None = None,
) -> DataFrame:
    """Every check on a one-row statistics table, as rows ``check_name, ok``.

    Columns are those of the parse statistics and of the alignment statistics. A
    missing value or one that is not finite fails its check. Limits on the rows of the
    list and on the keys of a row are checked only when they are given.
    """
    c = F.col

    def finite(x):
        return x.isNotNull() & ~F.isnan(x.cast("double")) & (F.abs(x.cast("double")) < float("inf"))

    checks = {f"floor {name}": finite(c(name)) & (c(name) >= low) for name, low in floors.items()}
    counts = ("source_rows", "exact_duplicate_rows", "conflicting_pairs", "excluded_conflicting_rows")
    pairs, excluded = c("conflicting_pairs"), c("excluded_conflicting_rows")
    aligned, found = c("aligned_rows"), c("reading_assignments")
    small, large = c("aligned_weight"), c("relevant_weight")
    ratio = F.when(large != 0, small / large)
    checks |= {
        "counts are not negative": F.least(*counts) >= 0,
        "source rows add up": c("source_rows") == c("rows") + c("exact_duplicate_rows") + excluded,
        "conflicts have two rows or more": excluded >= 2 * pairs,
        "conflicts and exclusions agree": (pairs == 0) == (excluded == 0),
        "rows are nested": (aligned >= 0) & (aligned <= c("relevant_rows"))
        & (c("relevant_rows") <= c("rows")),
        "ambiguous rows add up": c("ambiguous_rows") == c("relevant_rows") - aligned,
        "assignments cover rows": found >= aligned,
        "keys, groups, assignments nested": (c("keys_with_scores") > 0)
        & (c("keys_with_scores") <= c("groups_with_scores")) & (c("groups_with_scores") <= found),
        "coverage at most one": finite(c("weight_coverage")) & (c("weight_coverage") <= 1.0),
        "weights are nested": finite(small) & finite(large) & (small > 0) & (small <= large)
        & (large <= c("relevant_rows")) & (small <= aligned),
        "coverage is the weight ratio": F.abs(c("weight_coverage") - ratio)
        <= F.greatest(F.lit(COVERAGE_TOLERANCE), F.abs(ratio) * COVERAGE_TOLERANCE),
    }
    if max_rows is not None:
        checks["source rows within limit"] = c("source_rows") <= max_rows
    if max_keys_per_row is not None:
        checks["assignments within limit"] = found <= aligned * max_keys_per_row
    rows = [F.struct(F.lit(n).alias("check_name"), F.coalesce(ok, F.lit(False)).alias("ok")) for n, ok in checks.items()]
    return stats.select(F.explode(F.array(*rows)).alias("r")).select("r.*")


def minimum_count(df: DataFrame, minimum: int) -> DataFrame:
    """One row when the table has fewer rows than it must; empty otherwise."""
    return df.agg(F.count("*").alias("found")).withColumn("minimum", F.lit(minimum)).where("found < minimum")


def canonical_path(path) -> Column:
    """Relative, without backslash, and without empty, ``.`` or ``..`` parts."""
    path = as_col(path)
    bad = F.arrays_overlap(F.split(path, "/"), F.array(F.lit(""), F.lit("."), F.lit("..")))
    return F.coalesce(~bad & ~F.contains(path, F.lit("\\")), F.lit(False))


def term_shape(terms: DataFrame) -> DataFrame:
    """Term rows without a key, with a foreign sequence, or with a key of two rows."""
    faults = terms.select(
        "expression",
        F.when(F.coalesce("expression", F.lit("")) == "", "empty key")
        .when(F.length("expression") != 1, "key is not one character")
        .when(~F.col("sequence").eqNullSafe(F.ascii("expression").cast("bigint")), "sequence is not the code point")
        .when(F.col("score").isNull() | F.col("glossary").isNull(), "missing column")
        .alias("fault"),
    ).where("fault is not null")
    repeated = terms.groupBy("expression").agg(F.count("*").alias("n")).where("n > 1").select(
        "expression", F.lit("more than one row").alias("fault")
    )
    return faults.unionByName(repeated)


def meta_shape(meta: DataFrame) -> DataFrame:
    """Meta rows with an empty term, a foreign type or no positive value."""
    fault = (
        F.when(F.coalesce("term", F.lit("")) == "", "empty term")
        .when(~F.coalesce(F.col("type").isin(*META_TYPES), F.lit(False)), "unknown type")
        .when(~F.coalesce(F.col("value") > 0, F.lit(False)), "value is not positive")
    )
    return meta.withColumn("fault", fault).where("fault is not null")


def missing_fields(docs: DataFrame, doc: str, required: list[str]) -> DataFrame:
    """Required fields absent from JSON documents (``doc`` is a VARIANT), one row each."""
    absent = [F.when(field(doc, f"$.{name}").isNull(), F.lit(name)) for name in required]
    listed = F.filter(F.array(*absent), lambda x: x.isNotNull())
    return docs.withColumn("missing", F.explode(listed)).drop(doc)


def inventory_policy(files: DataFrame, policy: DataFrame, nested: str | None = None) -> DataFrame:
    """Violations of a name policy, as ``path, fault``.

    ``policy`` holds ``path, rule`` with rule ``required`` or ``forbidden``; names in
    folders must match ``nested``.
    """
    required = policy.where("rule = 'required'").select("path")
    forbidden = policy.where("rule = 'forbidden'").select("path")
    faults = [
        required.join(files, "path", "left_anti").select("path", F.lit("missing").alias("fault")),
        files.join(forbidden, "path", "left_semi").select("path", F.lit("forbidden").alias("fault")),
    ]
    if nested is not None:
        inside = F.contains("path", F.lit("/")) & ~F.col("path").rlike(nested)
        faults.append(files.where(inside).select("path", F.lit("unexpected folder").alias("fault")))
    out = faults[0]
    for f in faults[1:]:
        out = out.unionByName(f)
    return out


def licence_missing(files: DataFrame, assets: str, licence: str) -> DataFrame:
    """One row when assets ship without their licence file."""
    found = files.agg(
        F.count_if(F.col("path").rlike(assets)).alias("assets"),
        F.count_if(F.col("path") == licence).alias("licences"),
    )
    return found.where("assets > 0 and licences = 0")
