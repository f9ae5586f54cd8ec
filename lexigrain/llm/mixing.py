"""Mixing glosses to target weights when it is not known which domain each of them belongs to.

A classifier fitted on a labelled table gives every gloss a posterior over the domains. A gloss
of ``t`` tokens that is used ``r`` times then adds ``r * t * p`` expected tokens to a domain of
posterior ``p``. Rates ``r >= 0`` are fitted so that these totals meet the targets in the least
squares sense, by projected gradient steps from rate 1: each step is one aggregation over the
table, a few numbers per domain reach the driver, and the rates stay where the rows are.
Residuals are measured in the metric of the domains' Gram matrix, which makes full steps safe.
Everything here runs on DataFrame operations and Spark's own estimators.
"""

from __future__ import annotations

from collections.abc import Mapping

import numpy as np
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import CountVectorizerModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import staged

MARKS = ".,;:!?#%&*$|()[]{}<>\"'"
#: Labelled glosses used to fit the classifier, at most, for each domain; chosen by a hash of the key.
LABELLED = 4000
#: Weight of the absolute size of the classifier's coefficients: only words that tell domains apart get one.
PENALTY = 2e-3
#: Domains that a labelled table may name, at most; a posterior has a number for each.
DOMAINS = 1000
STEPS = 60
#: Steps whose arithmetic is kept as one expression before the rates are written down.
HELD_STEPS = 6
TOLERANCE = 1e-6
#: Rates are rounded to this many digits before copies are drawn.
DIGITS = 2


def words(gloss: str) -> Column:
    """The gloss's tokens: what white space separates, in lower case."""
    plain = F.lower(F.coalesce(gloss, F.lit("")))
    for space in "\t\n\x0b\f\r":
        plain = F.replace(plain, F.lit(space), F.lit(" "))
    return F.filter(F.split(plain, " "), lambda w: w != "")


def traits(gloss: str, tokens: str) -> Column:
    """What the classifier sees: distinct words without the marks around them, and how much of the text is marks, capitals and digits."""
    size = F.greatest(F.length(gloss), F.lit(1))
    # Small letters and white space, most of a text, count for none of the levels.
    rest = F.regexp_replace(gloss, r"[a-z\s]+", "")
    level = lambda name, pattern: F.concat(
        F.lit(f"#{name}"), F.floor(F.lit(10) * F.regexp_count(rest, F.lit(pattern)) / size).cast("string"),
    )
    extra = F.array(level("marks", r"[^\p{L}\p{N}\s]"), level("capitals", r"\p{Lu}"), level("digits", r"\p{N}"))
    bare = F.transform(F.array_distinct(tokens), lambda w: F.btrim(w, F.lit(MARKS)))
    return F.concat(bare, F.coalesce(F.filter(extra, lambda x: x.isNotNull()), F.array()))


def posteriors(
    glosses: DataFrame, labelled: DataFrame, key: str = "key", gloss: str = "gloss", domain: str = "domain", labels: int = LABELLED,
) -> tuple[DataFrame, list[str]]:
    """``key, n_tokens, posterior`` for every gloss, and the domains in the posterior's order: those of labelled glosses.

    ``labelled``  some of the keys with their domain, a string
    ``labels``    how many labelled keys of each domain the classifier sees at most
    """
    known = labelled.select(F.col(key).alias("key"), F.col(domain).cast("string").alias("domain")).where(
        "key IS NOT NULL AND domain IS NOT NULL"
    ).distinct()
    counts = {r["domain"]: r["n"] for r in known.groupBy("domain").agg(F.count("*").alias("n")).collect()}
    domains = sorted(counts)
    if len(domains) > DOMAINS:
        raise ValueError(f"{len(domains)} domains, not {DOMAINS} at most")
    texts = glosses.select(F.col(key).alias("key"), F.col(gloss).alias("gloss"))

    def described(df: DataFrame, *keep: str) -> DataFrame:
        cut = df.select("gloss", words("gloss").alias("words"), *keep)
        return cut.select(F.size("words").cast("bigint").alias("n_tokens"), traits("gloss", "words").alias("traits"), *keep)

    tokens = described(texts, "key")
    share = F.element_at(F.create_map(*[x for d in ["", *domains] for x in (F.lit(d), F.lit(min(1.0, labels / counts.get(d, labels))))]), F.col("domain"))
    chosen = known.where(F.pmod(F.xxhash64("key", F.lit(7)), F.lit(1 << 20)) < share * (1 << 20))
    # At most about ``labels`` keys of each domain, so the texts need not move to meet them.
    seen = texts.join(F.broadcast(chosen), "key")
    sample = staged(described(seen, "domain").select("traits", "domain"), "labelled")
    found = {r["domain"]: r["n"] for r in sample.groupBy("domain").agg(F.count("*").alias("n")).collect()}
    domains = sorted(found)
    if not domains:
        return tokens.select("key", "n_tokens", F.lit(None).cast("array<double>").alias("posterior")), domains
    if len(domains) == 1:
        return tokens.select("key", "n_tokens", F.array(F.lit(1.0)).alias("posterior")), domains
    label = F.array_position(F.array(*map(F.lit, domains)), F.col("domain")) - 1
    # A trait of a smaller share of the sample than the penalty gets no weight, whatever it says: none of it is kept.
    least = max(2, PENALTY * sum(found.values()))
    held = sample.select(F.explode(F.array_distinct("traits")).alias("trait")).groupBy("trait").agg(F.count("*").alias("n"))
    vocabulary = [r["trait"] for r in held.where(F.col("n") >= least).orderBy("trait").collect()] or ["#"]
    vector = CountVectorizerModel.from_vocabulary(vocabulary, inputCol="traits", outputCol="features").setBinary(True).setMinTF(0.0)
    model = LogisticRegression(maxIter=60, regParam=PENALTY, elasticNetParam=1.0, standardization=False).fit(
        vector.transform(sample.select("traits", label.cast("double").alias("label")))
    )
    scored = model.transform(vector.transform(tokens))
    return scored.select("key", "n_tokens", vector_to_array("probability").alias("posterior")), domains


def mix(
    glosses: DataFrame, labelled: DataFrame, targets: Mapping[str, float], key: str = "key", gloss: str = "gloss",
    domain: str = "domain", relative: bool = False, labels: int = LABELLED,
) -> DataFrame:
    """``key, n_tokens, posterior, rate, copies`` for every gloss.

    ``targets``   expected tokens wanted of each labelled domain; one not named wants none
    ``relative``  targets are multiples of what each domain has at rate 1
    ``labels``    bound on the labelled glosses of a domain that fit the classifier

    ``posterior`` is a map from domain to probability. Glosses with the same posterior get the
    same rate, whatever their length. ``copies`` is the rate, rounded to hundredths, made whole by
    a hash of the key, so its expectation is the rate and it never changes between runs. A NULL
    or empty gloss has no tokens and no say, but gets a posterior and a rate like others; a NULL
    key is a key. Repeated rows are fitted and returned as often as they occur. Targets that no
    nonnegative rates can meet are approached as near as they can. Without a labelled gloss nothing
    is known: the posterior is NULL, every rate 1 and every gloss used once. An empty table gives
    no rows; a gloss of any length is read whole; further columns are ignored. A key labelled with
    two domains counts for both. A labelled table of more than ``DOMAINS`` domains is refused.
    """
    scored, domains = posteriors(glosses, labelled, key, gloss, domain, labels)
    if not domains:
        return scored.select(
            "key", "n_tokens", F.lit(None).cast("map<string,double>").alias("posterior"), F.lit(1.0).alias("rate"), F.lit(1).alias("copies"),
        )
    rows = staged(scored.withColumn("rate", F.lit(1.0)), "posteriors")
    size = range(len(domains))
    p = [F.col("posterior")[i] for i in size]
    sums = rows.agg(*[F.sum(F.col("n_tokens") * p[i] * p[j]).alias(f"{i}_{j}") for i in size for j in size],
                    *[F.sum(F.col("n_tokens") * p[i]).alias(f"b_{i}") for i in size]).first()
    if sums["b_0"] is None:
        return _whole(rows, domains)
    natural = np.array([sums[f"b_{i}"] for i in size])
    wanted = np.array([float(targets.get(d, 0.0)) for d in domains]) * (natural if relative else 1.0)
    inverse = np.linalg.pinv(np.array([[sums[f"{i}_{j}"] for j in size] for i in size]), rcond=1e-9, hermitian=True)
    rate, last, held = F.col("rate"), np.inf, 0
    for _ in range(STEPS):
        now = rows.agg(*[F.sum(F.col("n_tokens") * p[i] * rate) for i in size]).first()
        residual = np.array(now, float) - wanted
        gap = float(residual @ inverse @ residual)
        if gap <= TOLERANCE * max(1.0, float(wanted @ inverse @ wanted)) or last - gap <= TOLERANCE * gap:
            break
        last = gap
        rate = F.greatest(F.lit(0.0), rate - sum((p[i] * F.lit(float(d)) for i, d in enumerate(inverse @ residual)), F.lit(0.0)))
        held += 1
        if held == HELD_STEPS:
            rows, rate, held = staged(rows.withColumn("rate", rate), "rates"), F.col("rate"), 0
    return _whole(rows.withColumn("rate", rate), domains)


def _whole(rows: DataFrame, domains: list[str]) -> DataFrame:
    draw = F.pmod(F.xxhash64("key"), F.lit(1 << 20)) / (1 << 20)
    names = F.array(*map(F.lit, domains))
    return rows.select(
        "key", "n_tokens", F.map_from_arrays(names, "posterior").alias("posterior"), "rate",
        F.floor(F.round("rate", DIGITS) + draw).cast("int").alias("copies"),
    )
