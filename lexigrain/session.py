"""Where intermediate tables live, and how a job cuts its lineage."""

from __future__ import annotations

import contextlib
import re
import tempfile
import uuid
from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession

_local_dirs: dict[str, str] = {}
_scopes: list[list[str]] = []


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can reach.

    The cluster names it in ``spark.checkpoint.dir``. Only a session that says it runs in
    plain local mode gets a temporary folder without that setting; any other fails.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    master = spark.conf.get("spark.master", "")
    if not re.fullmatch(r"local(\[[^\]]*\])?", master):
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
    app = spark.conf.get("spark.app.id", "local")
    if app not in _local_dirs:
        _local_dirs[app] = tempfile.mkdtemp(prefix="lexigrain-")
    return _local_dirs[app]


@contextlib.contextmanager
def job_scope(spark: SparkSession) -> Iterator[None]:
    """Delete, at the end, what the job inside staged or wrote by ``work_path``.

    Results must be written elsewhere, or collected, before the scope ends.
    """
    _scopes.append([])
    try:
        yield
    finally:
        for path in _scopes.pop():
            there = spark._jvm.org.apache.hadoop.fs.Path(path)
            there.getFileSystem(spark._jsc.hadoopConfiguration()).delete(there, True)


def work_path(spark: SparkSession, name: str) -> str:
    """A fresh path in the shared folder; inside a ``job_scope`` it is deleted at its end."""
    path = f"{shared_dir(spark)}/lexigrain/{name}-{uuid.uuid4().hex}"
    if _scopes:
        _scopes[-1].append(path)
    return path


def spread(df: DataFrame) -> DataFrame:
    """Give heavy row-wise work enough partitions.

    A table in fewer files than there are cores, such as one file with one row group, is
    redistributed before its rows are worked on. Larger tables stay as they are.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if len(df.inputFiles()) < cores else df


def evened(df: DataFrame) -> DataFrame:
    """Deal rows out evenly, to several times as many tasks as there are cores.

    For tables whose rows take far longer to work on than to read: parts of equal size in bytes, hardly more than there
    are cores, leave most cores idle while the last of them run.
    """
    return df.repartition(4 * df.sparkSession.sparkContext.defaultParallelism)


def staged(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back.

    Used where one intermediate feeds several branches. The copy survives lost
    executors, and the planner sees its true size, so a join against it is
    broadcast only when the files really are below the broadcast threshold.
    """
    spark = df.sparkSession
    path = work_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
