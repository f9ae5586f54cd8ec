"""Secrets in snapshot files: a random forest that removes the false alarms of a pattern.

Every long run of key-like characters is a candidate. Its features are its length, how often
its characters change kind, how much of it a dictionary covers, the file's path and the words
next to it. A random forest trained on labelled findings tells secrets from long words, paths
and numbers. Everything here runs on DataFrame operations and Spark's own estimators.
"""

from __future__ import annotations

from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import staged

#: Runs of key-like characters. A sign of equality only ends one, unless nothing else in its run is long enough.
CANDIDATE = r"[A-Za-z0-9+/_.-]{16,}={0,2}|(?<![A-Za-z0-9+/_=.-])(?![A-Za-z0-9+/_=.-]*[A-Za-z0-9+/_.-]{16})[A-Za-z0-9+/_=.-]{16,}"
#: All up to the last character between the fields of a text without white space.
FIELDS = r"(?s)^.*[,;&?{}|]"
#: Words that announce a secret, and path parts that speak against one.
NAMES = r"(?i)(?:key|token|secret|passw|pwd|auth|cred|bearer|private|api|access|sign)"
HARMLESS = r"(?i)(?:^|[/._-])(?:tests?|spec|fixtures?|examples?|samples?|mocks?|docs?)(?:$|[/._-])"
#: What assigns a value to the name of a secret, in any case and quoting, right before the value.
ASSIGNED = (
    r"(?i)(?:(?:key|token|secret|passw(?:or)?d|passphrase|pwd|auth|credentials?|signature)(?:[_-]?[a-z0-9]{1,12})?[\"'`]?\s*(?:=>|:=|=|:)"
    r"|authorization[\"'`]?\s*[=:]\s*[\"'`]?\s*(?:bearer|basic|token)|\bbearer)\s*[\"'`]?$"
)
#: Values that name their own kind: keys of clouds, of code hosts and of payment services, signed tokens.
ISSUED = (
    r"^(?:(?:AKIA|ASIA)[0-9A-Z]{16}|AIza[0-9A-Za-z_-]{35}|gh[pousr]_[0-9A-Za-z]{36,}|github_pat_[0-9A-Za-z_]{22,}|glpat-[0-9A-Za-z_-]{20,}"
    r"|xox[abprs]-[0-9A-Za-z-]{10,}|[rs]k_(?:live|test)_[0-9A-Za-z]{16,}|eyJ[0-9A-Za-z_-]{10,}[.]eyJ[0-9A-Za-z_-]{10,}[.][0-9A-Za-z_-]+)$"
)
#: Changes between letters and digits, or from lower to upper case; by chance at least two in five places are such.
TURN = r"(?<=[0-9])(?=[A-Za-z])|(?<=[A-Za-z])(?=[0-9])|(?<=[a-z])(?=[A-Z])"
#: Turns a character from which a value is taken for random: a third of what chance makes, many times what words do.
RANDOM_TURNS = 0.125
TREES = 20
DEPTH = 6
#: Labelled findings used for training, at most, of either label; chosen by a hash.
LABELLED = 20_000
FEATURES = [
    "length", "digits", "uppers", "symbols", "distinct", "changes", "hex", "covered", "slashes", "dots", "path_depth",
    "path_harmless", "named", "assigned", "quoted", "before_known", "after_known",
]


def _share(text: str, pattern: str) -> Column:
    return F.regexp_count(text, F.lit(pattern)) / F.length(text)


def places(files: DataFrame, path: str = "path", content: str = "content") -> DataFrame:
    """``path, at, part, candidate, lead, before, after``: every candidate of every file and what stands next to it.

    ``at`` is the number of the white-space separated word, ``part`` that of the candidate in it, both from 0.
    ``lead`` is the text before the candidate: of the first one of a word the two words before and what the word
    begins with, of the others what lies between, with the candidate before; either way only from the last
    separator of fields on, so a name far ahead on the line announces nothing. All of it is linear in the content.
    """
    rows = files.select(F.col(path).cast("string").alias("path"), F.split(F.coalesce(content, F.lit("")), r"\s+").alias("w"))
    long = F.filter(F.sequence(F.lit(0), F.size("w") - 1), lambda i: F.length(F.col("w")[i]) >= 16)
    words = F.transform(long, lambda i: F.struct(
        i.alias("at"), F.col("w")[i].alias("word"),
        *[F.coalesce(F.get("w", i + d), F.lit("")).alias(n) for d, n in ((-2, "before2"), (-1, "before"), (1, "after"))],
    ))
    rows = rows.select("path", F.explode(words).alias("o")).select("path", "o.*").where(F.col("word").rlike(CANDIDATE))
    rows = rows.withColumn("c", F.regexp_extract_all("word", F.lit(CANDIDATE), F.lit(0))).withColumn("gaps", F.split("word", CANDIDATE))
    gap, none = lambda i: F.get("gaps", i), F.lit("")
    first, last = (lambda i: i == 0), (lambda i: i == F.size("c") - 1)
    begun = F.concat_ws(" ", "before2", "before", F.col("gaps")[0])
    found = F.transform("c", lambda x, i: F.struct(
        i.alias("part"), x.alias("candidate"),
        F.when(first(i), begun).otherwise(F.concat(F.get("c", i - 1), gap(i))).alias("lead"), gap(i).alias("gap"),
        F.when(first(i), F.col("before")).otherwise(gap(i)).alias("before"),
        F.when(last(i), F.col("after")).otherwise(F.coalesce(gap(i + 1), none)).alias("after"),
    ))
    found = rows.select("path", "at", F.explode(found).alias("o")).select("path", "at", "o.*")
    cut = (F.col("part") > 0) | F.col("gap").rlike("[,;&?{}|]")
    return found.withColumn("lead", F.when(cut, F.regexp_replace("lead", FIELDS, "")).otherwise(F.col("lead"))).drop("gap")


def told(candidate: str = "candidate", lead: str = "lead") -> Column:
    """Whether a candidate is a secret as far as its shape and its lead tell, else NULL.

    True for a value of an issuer's own form, and for a random one that is assigned to the name of a secret,
    in any quoting, case or length. False for a value that is neither random nor assigned to such a name.
    A random value without a name may be a checksum and a named one of plain words a reference: both are NULL.
    """
    value = F.regexp_replace(candidate, "^.*[^=]=(?=[^=])", "")
    before = F.concat(F.col(lead), F.substring(candidate, F.lit(1), F.length(candidate) - F.length(value)))
    named = before.rlike(ASSIGNED)
    random = F.regexp_count(value, F.lit(TURN)) >= F.greatest(F.lit(2), RANDOM_TURNS * F.length(value))
    return F.when(value.rlike(ISSUED) | named & random, True).when(~named & ~random, False)


def common_words(docs: DataFrame, share: float, text: str = "text") -> DataFrame:
    """``word, n``: words, in lower case, that at least a share of the distinct texts hold, and two of them.

    Texts that hold the same new words in the same order are one, so what is copied counts once.
    """
    held = F.array_join(F.array_distinct(F.split(F.lower(text), r"[^\p{L}]+")), " ")
    texts = docs.where(F.col(text).isNotNull()).select(held.alias("held")).distinct()
    # The empty word, which every text gets, counts the texts.
    words = texts.select(F.explode(F.array_union(F.array(F.lit("")), F.split("held", " "))).alias("word"))
    counts = staged(words.groupBy("word").agg(F.count("*").alias("n")), "word-counts")
    total = counts.where("word = ''").first()
    return counts.where((F.col("word") != "") & (F.col("n") >= max(2, share * (total["n"] if total else 0))))


def candidates(files: DataFrame, dictionary: DataFrame, path: str = "path", content: str = "content", word: str = "word") -> DataFrame:
    """``path, at, part, candidate`` and the features of every candidate of every file.

    ``files``       path and content of snapshot files
    ``dictionary``  a table of words, in lower case, such as the ranked list's surfaces

    ``at`` and ``part`` say where a candidate stands, as in ``places``.
    """
    found = places(files, path, content)
    kinds = r"(?<=[a-z])(?=[A-Z0-9])|(?<=[A-Z])(?=[0-9])|(?<=[0-9])(?=[A-Za-z])|(?<=[A-Za-z0-9])(?=[+/_=.-])"
    clean = lambda c: F.regexp_replace(F.lower(c), r"[^\p{L}]", "")
    found = staged(found.select(
        "path", "at", "part", "candidate",
        F.length("candidate").cast("double").alias("length"),
        _share("candidate", "[0-9]").alias("digits"), _share("candidate", "[A-Z]").alias("uppers"),
        _share("candidate", "[+/_=.-]").alias("symbols"),
        F.size(F.array_distinct(F.split("candidate", ""))).cast("double").alias("distinct"),
        (F.regexp_count("candidate", F.lit(kinds)) / F.length("candidate")).alias("changes"),
        F.col("candidate").rlike("^[0-9a-fA-F]+$").cast("double").alias("hex"),
        F.regexp_count("candidate", F.lit("/")).cast("double").alias("slashes"),
        F.regexp_count("candidate", F.lit("[.]")).cast("double").alias("dots"),
        F.coalesce(F.regexp_count("path", F.lit("/")), F.lit(0)).cast("double").alias("path_depth"),
        F.coalesce(F.col("path").rlike(HARMLESS), F.lit(False)).cast("double").alias("path_harmless"),
        F.col("lead").rlike(NAMES).cast("double").alias("named"), F.col("lead").rlike("[=:]").cast("double").alias("assigned"),
        F.col("lead").rlike("[\"'`]$").cast("double").alias("quoted"),
        clean("before").alias("w_before"), clean("after").alias("w_after"),
        F.regexp_extract_all(F.lower("candidate"), F.lit("[a-z]{3,}"), F.lit(0)).alias("runs"),
    ).withColumn("id", F.monotonically_increasing_id()), "candidates")

    # The words of a candidate and of its surroundings meet the dictionary in one equi-join.
    asks = found.select("id", F.explode(F.concat(
        F.transform("runs", lambda r: F.struct(F.lit("run").alias("kind"), r.alias("word"))),
        F.array(F.struct(F.lit("before").alias("kind"), F.col("w_before").alias("word")), F.struct(F.lit("after").alias("kind"), F.col("w_after").alias("word"))),
    )).alias("a")).select("id", "a.*").where("word <> ''")
    words = dictionary.select(F.col(word).alias("word")).where("word IS NOT NULL").distinct()
    known = asks.join(words, "word").groupBy("id").agg(
        F.sum(F.when(F.col("kind") == "run", F.length("word")).otherwise(0)).alias("letters"),
        *[F.max(F.when(F.col("kind") == k, 1.0).otherwise(0.0)).alias(f"{k}_known") for k in ("before", "after")],
    )
    return found.join(known, "id", "left").select(
        "path", "at", "part", "candidate", *[c for c in FEATURES if c not in ("covered", "before_known", "after_known")],
        F.coalesce(F.col("letters") / F.col("length"), F.lit(0.0)).alias("covered"),
        *[F.coalesce(c, F.lit(0.0)).alias(c) for c in ("before_known", "after_known")],
    )


def scan(
    files: DataFrame, dictionary: DataFrame, labelled: DataFrame, path: str = "path", content: str = "content", word: str = "word",
    secret: str = "secret", least: float = 0.5, labels: int = LABELLED,
) -> DataFrame:
    """``path, at, part, candidate, score``: the candidates that the forest takes for secrets.

    ``labelled``  findings with a path, ``at``, ``part`` and a boolean ``secret``; without the column
                  ``part`` they are the first of their words; those that are no candidates of
                  ``files`` or whose ``secret`` is NULL are ignored
    ``least``     score from which a candidate stays
    ``labels``    bound on the labelled findings of either label that train the forest

    Contents are read whole; NULL or empty ones hold nothing. A word of any length gives all
    its runs of key-like characters. Repeated files are reported as often as they
    occur; a NULL path is reported as NULL and never labelled. Without labelled findings of both kinds
    nothing can be told apart and every candidate stays, with a NULL score. Empty tables give no
    rows; further columns are ignored.
    """
    found = staged(candidates(files, dictionary, path, content, word), "features")
    marks = labelled.select(
        F.col(path).cast("string").alias("path"), F.col("at").cast("int").alias("at"),
        (F.col("part") if "part" in labelled.columns else F.lit(0)).cast("int").alias("part"),
        F.col(secret).cast("boolean").cast("double").alias("label"),
    ).where("label IS NOT NULL").distinct()
    known = staged(found.join(marks, ["path", "at", "part"]), "known-findings")
    counts = {r["label"]: r["n"] for r in known.groupBy("label").agg(F.count("*").alias("n")).collect()}
    if len(counts) < 2:
        return found.select("path", "at", "part", "candidate", F.lit(None).cast("double").alias("score"))
    share = F.when(F.col("label") == 1.0, min(1.0, labels / counts[1.0])).otherwise(min(1.0, labels / counts[0.0]))
    chosen = known.where(F.pmod(F.xxhash64("path", "at", "part", F.lit(5)), F.lit(1 << 20)) < share * (1 << 20))
    vectors = VectorAssembler(inputCols=FEATURES, outputCol="features")
    sample = staged(chosen.select("label", *FEATURES), "findings")
    forest = RandomForestClassifier(numTrees=TREES, maxDepth=DEPTH, seed=11).fit(vectors.transform(sample))
    scored = forest.transform(vectors.transform(found)).withColumn("score", vector_to_array("probability")[1])
    return scored.where(F.col("score") >= least).select("path", "at", "part", "candidate", "score")
