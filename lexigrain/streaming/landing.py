"""Daily landing, duplicate removal on arrival, and the negative ledger.

All of them run with ``availableNow``: a run takes what has arrived since the last
one, and the checkpoint makes a second run on the same input do nothing.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType


def file_stream(spark: SparkSession, schema: StructType, path: str, max_files: int | None = None) -> DataFrame:
    reader = spark.readStream.schema(schema)
    if max_files is not None:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.parquet(path)


def land(stream: DataFrame, target: str, checkpoint: str, day: str = "dt") -> int:
    """Append new rows to the dated table; returns how many rows this run processed.

    Each batch counts its rows in an accumulator while it writes them, and a repeated batch
    counts anew, so the number is exact for any number of batches.
    """
    rows: dict[int, int] = {}

    def write(batch: DataFrame, batch_id: int) -> None:
        seen = Observation(f"batch-{batch_id}")
        batch.observe(seen, F.count(F.lit(1)).alias("n")).write.mode("overwrite").partitionBy(day).parquet(f"{target}/batch={batch_id}")
        rows[batch_id] = seen.get["n"]

    query = (
        stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    )
    query.awaitTermination()
    return sum(rows.values())


def land_checked(stream: DataFrame, target: str, checkpoint: str, judge: Callable[[DataFrame], DataFrame], day: str = "dt") -> None:
    """Let a batch take the place of the days it holds, once it has been judged whole.

    ``judge``  from the rows of a batch to its violations, with the day they belong to

    A batch is written beside what landed before, judged as it was written, and then its days without
    a violation are accepted by one small append. ``accepted_days`` reads the latest accepted batch of each day,
    so a day that fails, or a run that is lost at any point, leaves the former one readable. A repeated
    batch writes over its own folders.
    """
    run = checkpoint.rstrip("/").rpartition("/")[2]

    def write(batch: DataFrame, batch_id: int) -> None:
        name = f"batch={run}-{batch_id}"
        batch.write.mode("overwrite").partitionBy(day).parquet(f"{target}/data/{name}")
        held = batch.sparkSession.read.schema(batch.schema).parquet(f"{target}/data/{name}")
        days = held.select(day).distinct().join(judge(held).select(day).distinct(), day, "left_anti")
        accepted = days.select(F.col(day).alias("day"), F.current_timestamp().alias("at"), F.lit(batch_id).cast("bigint").alias("number"))
        accepted.coalesce(1).write.mode("overwrite").parquet(f"{target}/accepted/{name}")

    query = stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()


def accepted_days(spark: SparkSession, target: str, schema: StructType, day: str = "dt") -> DataFrame:
    """The rows of each day's latest accepted batch."""
    named = StructType([*schema.fields, StructField("batch", StringType())])
    rows = spark.read.schema(named).parquet(f"{target}/data")
    days = spark.read.schema("day string, at timestamp, number bigint, batch string").parquet(f"{target}/accepted")
    latest = days.groupBy("day").agg(F.max_by("batch", F.struct("at", "number")).alias("batch")).withColumnRenamed("day", day)
    return rows.join(latest, [day, "batch"]).select(*schema.names)


def distinct_stream(
    stream: DataFrame, columns: list[str], event_time: str, delay: str = "1 day", same: list[str] | None = None,
) -> DataFrame:
    """Exact duplicates removed on arrival; state is kept for ``delay`` of event time.

    ``same``  the columns that make a duplicate, if they are not ``columns``

    Rows that are later than that are dropped, as nothing is left to compare them with.

    Without an event time state would grow with every distinct row: use ``append_batches``
    with ``distinct_rows`` and let readers merge with ``merged_distinct``.
    """
    marked = stream.select(*columns, event_time).withWatermark(event_time, delay)
    return marked.dropDuplicatesWithinWatermark(same or columns)


def distinct_rows(batch: DataFrame) -> DataFrame:
    """What a batch contributes to the distinct rows: its own, without any state."""
    return batch.distinct()


def merged_distinct(landed: DataFrame) -> DataFrame:
    """Distinct rows over all batches."""
    return landed.drop("batch").distinct()


def compact(spark: SparkSession, target: str, merged: str, merge) -> None:
    """Rewrite the batches of ``append_batches`` as one batch at ``merged``, merged the way readers do.

    Written beside the batches, so that readers of either see whole results; the caller then
    points the stream and its readers to the new folder.
    """
    merge(spark.read.parquet(target)).write.parquet(f"{merged}/batch=-1")


def append_batches(stream: DataFrame, target: str, checkpoint: str, prepare) -> None:
    """Write ``prepare(batch)`` to one folder per batch.

    A repeated batch overwrites its own folder, so results stay exact. Nothing that
    landed before is rewritten; readers merge. Folders carry the name of their checkpoint,
    so a stream that starts over with a new one does not overwrite what an older one landed.
    """
    run = checkpoint.rstrip("/").rpartition("/")[2]

    def write(batch: DataFrame, batch_id: int) -> None:
        prepare(batch).write.mode("overwrite").parquet(f"{target}/batch={run}-{batch_id}")

    query = (
        stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
        .trigger(availableNow=True).start()
    )
    query.awaitTermination()


def pair_ranges(rows: DataFrame) -> DataFrame:
    """What a batch contributes to each (surface, reading): its lowest and highest rank."""
    return rows.groupBy("surface", "reading").agg(F.min("rank").alias("low"), F.max("rank").alias("high"))


def conflict_free_pairs(ranges: DataFrame) -> DataFrame:
    """Pairs with one rank over all batches; conflicts need the whole history."""
    merged = ranges.groupBy("surface", "reading").agg(F.min("low").alias("rank"), F.max("high").alias("high"))
    return merged.where("rank = high").drop("high")


def latest_marks(marks: DataFrame) -> DataFrame:
    """What a batch contributes per key and day: the latest status."""
    return marks.groupBy("key", "dt").agg(F.max(F.struct("ts", "status")).alias("m")).select("key", "dt", "m.*")


def suppressed(ledger: DataFrame) -> DataFrame:
    """Keys not to be asked for again that day: their latest status is ``absent``."""
    return latest_marks(ledger).where("status = 'absent'").select("key", "dt")
