"""Strict source locks: read without any leniency, and compared three ways."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import variants as V
from .gates import canonical_path

# The form of a lock and of its file records.
LOCK_NAME = "SOURCE-LOCK.json"
SCHEMA_VERSION = 1
MEMBERS = ("byteCount", "path", "sha256")
DIGEST = r"\A[0-9a-f]{64}\z"


def _record_fault(f: Column, max_member: int | None) -> Column:
    names = F.sort_array(F.map_keys(F.try_variant_get(f, "$", "map<string,variant>")))
    path, size, digest = V.string_field(f, "$.path"), V.int_field(f, "$.byteCount"), V.string_field(f, "$.sha256")
    sized = (size >= 0) if max_member is None else size.between(0, max_member)
    sure = lambda test: F.coalesce(test, F.lit(False))
    return (
        F.when(~sure(names == F.array(*map(F.lit, MEMBERS))), "members")
        .when(~sure(canonical_path(path) & (path != LOCK_NAME)), "path")
        .when(~sure(sized), "size").when(~sure(digest.rlike(DIGEST)), "digest")
    )


def strict(
    locks: DataFrame, text: str = "lock", max_members: int | None = None, max_member: int | None = None, max_total: int | None = None,
) -> DataFrame:
    """``locks`` with ``fault``, NULL for a valid one, and ``files``, its records in the order of their paths.

    Faults, the first that holds: ``unparsable`` (no strict JSON, which a repeated member is not either),
    ``schema`` (another version or none), ``inventory`` (no array of files, or too many), ``members``, ``path``,
    ``size``, ``digest`` (a file record without exactly its three members, or one that is not of its form),
    ``duplicate`` (a path twice), ``total``. A lock with a fault has NULL files, never none. Limits hold
    only where they are given.
    """
    parsed = locks.withColumn("_v", F.try_parse_json(text))
    parsed = parsed.withColumn("_files", F.try_variant_get("_v", "$.files", "array<variant>"))
    records = F.transform("_files", lambda f: F.struct(
        V.string_field(f, "$.path").alias("path"), V.int_field(f, "$.byteCount").alias("byte_count"), V.string_field(f, "$.sha256").alias("sha256"),
    ))
    bad = F.get(F.filter(F.transform("_files", lambda f: _record_fault(f, max_member)), lambda x: x.isNotNull()), F.lit(0))
    parsed = parsed.withColumn("_records", records).withColumn("_bad", bad)
    paths = F.transform("_records", lambda r: r["path"])
    total = F.aggregate("_records", F.lit(0).cast("bigint"), lambda n, r: n + r["byte_count"])
    fault = F.when(F.col("_v").isNull(), "unparsable").when(~V.int_field("_v", "$.schemaVersion").eqNullSafe(F.lit(SCHEMA_VERSION)), "schema")
    many = F.lit(False) if max_members is None else F.size("_files") > max_members
    fault = fault.when(F.col("_files").isNull() | many, "inventory").when(F.col("_bad").isNotNull(), F.col("_bad"))
    fault = fault.when(F.size(F.array_distinct(paths)) < F.size("_records"), "duplicate")
    if max_total is not None:
        fault = fault.when(total > max_total, "total")
    judged = parsed.withColumn("fault", fault)
    files = F.when(F.col("fault").isNull(), F.sort_array("_records"))
    return judged.withColumn("files", files).drop("_v", "_files", "_records", "_bad")


def verify_nested(snapshots: DataFrame, files: DataFrame, name: str = "name", outer: str = "outer", inner: str = "inner") -> DataFrame:
    """``name, path, status`` of every declared or found file, or one row without a path for a snapshot whose locks do not hold.

    ``snapshots``  name, the text of the lock beside the snapshot and that of the one inside it
    ``files``      ``name, path, byte_count, sha256`` of what each snapshot holds

    Both locks must be valid, see ``strict``, and list the same files. Then each path is ``ok``, ``missing``,
    ``undeclared``, of another ``size`` or ``digest``, or a ``duplicate``; one that is not canonical says so.
    A missing lock is an unparsable one. Files of a snapshot without a row in ``snapshots`` are undeclared.
    """
    read = strict(snapshots.select(F.col(name).alias("name"), F.col(outer).alias("outer"), F.col(inner).alias("inner")), "outer")
    read = strict(read.withColumnsRenamed({"fault": "outer_fault", "files": "outer_files"}), "inner")
    broken = (
        F.when(F.col("outer_fault").isNotNull(), F.concat(F.lit("outer lock: "), "outer_fault"))
        .when(F.col("fault").isNotNull(), F.concat(F.lit("inner lock: "), "fault"))
        .when(F.col("outer_files") != F.col("files"), "locks differ")
    )
    read = read.select("name", broken.alias("broken"), "files")
    faults = read.where("broken IS NOT NULL").select("name", F.lit(None).cast("string").alias("path"), F.col("broken").alias("status"))
    declared = read.where("broken IS NULL").select("name", F.explode("files").alias("f")).select("name", "f.*")
    actual = files.join(faults.select("name"), "name", "left_anti").groupBy("name", "path").agg(
        F.count("*").alias("n"), F.min("byte_count").alias("bytes"), F.min("sha256").alias("now"),
    )
    status = (
        F.when(~canonical_path("path"), "canonical").when(F.col("n") > 1, "duplicate").when(F.col("n").isNull(), "missing")
        .when(F.col("sha256").isNull(), "undeclared").when(F.col("byte_count") != F.col("bytes"), "size")
        .when(F.col("sha256") != F.col("now"), "digest").otherwise("ok")
    )
    return declared.join(actual, ["name", "path"], "full_outer").select("name", "path", status.alias("status")).unionByName(faults)
