"""Publishing a revision as a whole, and the ledger of what failed gates led to.

A revision is written beside the published one, in a folder that no reader looks at. One small
pointer file names the published folder; it is replaced by a rename, so a reader follows either
the old revision or the new one. A folder that was never pointed to is what an interrupted run
left behind; the next run of that revision writes over it.
"""

from __future__ import annotations

import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import variants as V
from .versions import revision_key

STATE = "revision string, fingerprint string, folder string"
#: A consequence: a source (``path`` with the digest it had) or a day's negative marks that no longer count.
LEDGER = "kind string, path string, sha256 string, dt string, reason string, at timestamp"
QUARANTINE, VOID = "quarantine", "void"


def _renamed(spark: SparkSession, source: str, target: str) -> None:
    jvm, gateway = spark._jvm, spark.sparkContext._gateway
    path = jvm.org.apache.hadoop.fs.Path
    kinds = getattr(jvm.org.apache.hadoop.fs, "Options$Rename")
    options = gateway.new_array(kinds, 1)
    options[0] = kinds.OVERWRITE
    files = jvm.org.apache.hadoop.fs.FileContext.getFileContext(path(target).toUri(), spark._jsc.hadoopConfiguration())
    files.rename(path(source), path(target), options)


def point_to(spark: SparkSession, target: str, revision: str, fingerprint: str, folder: str) -> None:
    """Make ``folder`` the published one; a run that is lost before the rename has published nothing."""
    beside = f"{target}/_pointers/{uuid.uuid4().hex}"
    row = spark.createDataFrame([(revision, fingerprint, folder)], STATE)
    row.select(F.to_json(F.struct("revision", "fingerprint", "folder")).alias("value")).coalesce(1).write.text(beside)
    jvm = spark._jvm
    files = jvm.org.apache.hadoop.fs.Path(beside).getFileSystem(spark._jsc.hadoopConfiguration())
    written = [s.getPath().toString() for s in files.listStatus(jvm.org.apache.hadoop.fs.Path(beside)) if s.getPath().getName().startswith("part-")]
    _renamed(spark, written[0], f"{target}/current.json")


def previous_state(spark: SparkSession, target: str) -> DataFrame:
    """``revision, fingerprint, folder`` of the published revision, in one row; NULLs when the pointer is missing or corrupt."""
    none = spark.createDataFrame([(None, None, None)], STATE)
    try:
        lines = spark.read.text(f"{target}/current.json", wholetext=True)
    except AnalysisException:
        return none
    names = ("revision", "fingerprint", "folder")
    state = lines.select(F.try_parse_json("value").alias("v")).select(*[V.string_field("v", f"$.{n}").alias(n) for n in names])
    whole = revision_key("revision").isNotNull() & F.col("fingerprint").rlike(r"\A[0-9a-f]{64}\z") & F.col("folder").isNotNull()
    return state.where(whole).union(none).orderBy(F.desc_nulls_last("revision")).limit(1)


def published(spark: SparkSession, target: str, name: str) -> DataFrame:
    """A bank of the published revision; fails when nothing is published."""
    folder = previous_state(spark, target).first()["folder"]
    if folder is None:
        raise FileNotFoundError(f"nothing is published at {target}")
    return spark.read.parquet(f"{target}/{folder}/{name}")


def append_entries(entries: DataFrame, ledger: str) -> None:
    """Append consequences ``kind, path, sha256, dt, reason`` to the ledger, each call a folder of its own."""
    entries.withColumn("at", F.current_timestamp()).selectExpr(*[c.split()[0] for c in LEDGER.split(", ")]).write.parquet(
        f"{ledger}/entry={uuid.uuid4().hex}"
    )


def read_ledger(spark: SparkSession, ledger: str) -> DataFrame:
    """All consequences so far; none where the ledger was never written."""
    try:
        return spark.read.schema(LEDGER).parquet(f"{ledger}/entry=*")
    except AnalysisException:
        return spark.createDataFrame([], LEDGER)


def usable(files: DataFrame, ledger: DataFrame) -> DataFrame:
    """Sources that are not quarantined with the very digest they have now; a new digest brings a source back."""
    held = ledger.where(F.col("kind") == QUARANTINE).select("path", "sha256").distinct()
    return files.join(held, ["path", "sha256"], "left_anti")


def live_marks(marks: DataFrame, ledger: DataFrame) -> DataFrame:
    """Negative marks ``key, dt, at`` that were set after their day was last voided."""
    voided = ledger.where(F.col("kind") == VOID).groupBy("dt").agg(F.max("at").alias("_voided"))
    return marks.join(voided, "dt", "left").where(F.col("_voided").isNull() | (F.col("at") > F.col("_voided"))).drop("_voided")
