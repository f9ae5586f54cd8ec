"""Structured Streaming over the events table."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..session import work_path
from ..streaming import landing as L
from .base import query, table


def _arrivals(spark, sf) -> str:
    """The events as files that arrive, by day."""
    path = work_path(spark, "arrivals")
    events = table(spark, sf, "events").withColumn("dt", F.date_format("ts", "yyyy-MM-dd"))
    events.write.partitionBy("event_type").parquet(path)
    return path


def _stream(spark, path):
    """One file a batch, so that every query meets several of them."""
    return L.file_stream(spark, spark.read.parquet(path).schema, path, max_files=1)


@query("stream_landing", """
SELECT event_id, user_id, event_type, value, strftime(ts, '%Y-%m-%d') AS dt FROM events""")
def stream_landing(spark, sf):
    """Two runs over the same arrivals; the second has nothing to do."""
    arrivals, target, checkpoint = _arrivals(spark, sf), work_path(spark, "landed"), work_path(spark, "landing")
    L.land(_stream(spark, arrivals), target, checkpoint)
    if L.land(_stream(spark, arrivals), target, checkpoint) != 0:
        raise RuntimeError("the second run found new input")
    landed = spark.read.parquet(target)
    return landed.select("event_id", "user_id", "event_type", "value", F.date_format(F.col("dt").cast("date"), "yyyy-MM-dd").alias("dt"))


@query("stream_rank_dedupe", """
SELECT DISTINCT event_type AS surface, props AS reading, user_id AS rank FROM events""")
def stream_rank_dedupe(spark, sf):
    arrivals, target = _arrivals(spark, sf), work_path(spark, "distinct")
    rows = _stream(spark, arrivals).select(
        F.col("event_type").alias("surface"), F.col("props").alias("reading"), F.col("user_id").alias("rank")
    )
    L.append_batches(rows, target, work_path(spark, "distinct-state"), L.distinct_rows)
    return L.merged_distinct(spark.read.parquet(target))


@query("stream_conflict_free", """
SELECT CAST(user_id AS VARCHAR) AS surface, props AS reading, min(CAST(floor(value) AS BIGINT)) AS rank FROM events
GROUP BY ALL HAVING min(CAST(floor(value) AS BIGINT)) = max(CAST(floor(value) AS BIGINT))""")
def stream_conflict_free(spark, sf):
    arrivals, target = _arrivals(spark, sf), work_path(spark, "pairs")
    rows = _stream(spark, arrivals).select(
        F.col("user_id").cast("string").alias("surface"), F.col("props").alias("reading"), F.floor("value").alias("rank")
    )
    L.append_batches(rows, target, work_path(spark, "pairs-state"), L.pair_ranges)
    return L.conflict_free_pairs(spark.read.parquet(target))


@query("stream_negative_ledger", """
WITH m AS (SELECT user_id AS key, strftime(ts, '%Y-%m-%d') AS dt,
             max({'ts': ts, 's': CASE WHEN event_type = 'error' THEN 'absent' ELSE 'present' END}) AS m FROM events GROUP BY 1, 2)
SELECT key, dt FROM m WHERE m.s = 'absent'""")
def stream_negative_ledger(spark, sf):
    """Errors mark a user absent for the day; anything later voids the mark."""
    arrivals, target = _arrivals(spark, sf), work_path(spark, "marks")
    status = F.when(F.col("event_type") == "error", "absent").otherwise("present")
    marks = _stream(spark, arrivals).select(F.col("user_id").alias("key"), "dt", "ts", status.alias("status"))
    L.append_batches(marks, target, work_path(spark, "marks-state"), L.latest_marks)
    return L.suppressed(spark.read.parquet(target))


HIGH = 990


def _two_arrivals(spark, events, checkpointed) -> None:
    """Events in two arrivals, each its own run of the stream on one checkpoint."""
    path = work_path(spark, "two-arrivals")
    for part in (events.where("event_id % 3 <> 0"), events.where("event_id % 3 = 0")):
        part.coalesce(1).write.mode("append").parquet(path)
        checkpointed(L.file_stream(spark, events.schema, path))


@query("stream_checked_days", f"""
WITH e AS (SELECT event_id, value, strftime(ts, '%Y-%m-%d') AS dt, CASE WHEN event_id % 3 = 0 THEN 2 ELSE 1 END AS arrival FROM events),
ok AS (SELECT dt, max(arrival) AS arrival FROM (SELECT dt, arrival FROM e GROUP BY ALL HAVING max(value) <= {HIGH}) GROUP BY dt)
SELECT event_id, value, e.dt FROM e JOIN ok USING (dt, arrival)""")
def stream_checked_days(spark, sf):
    """Each arrival has a version of each day; one with a value too high leaves the former version in place."""
    events = table(spark, sf, "events").select("event_id", "value", F.date_format("ts", "yyyy-MM-dd").alias("dt"))
    target, checkpoint = work_path(spark, "checked"), work_path(spark, "checked-state")
    _two_arrivals(spark, events, lambda s: L.land_checked(s, target, checkpoint, lambda rows: rows.where(F.col("value") > HIGH)))
    return L.accepted_days(spark, target, events.schema)


@query("stream_distinct_window", """
WITH e AS (SELECT user_id, event_type, date_trunc('day', ts) AS day, event_id % 3 = 0 AS late FROM events),
mark AS (SELECT max(day) - INTERVAL 10 DAY AS w FROM e WHERE NOT late)
SELECT DISTINCT user_id, event_type, strftime(day, '%Y-%m-%d') AS day FROM e, mark WHERE NOT late OR day > w""")
def stream_distinct_window(spark, sf):
    """Distinct rows of two arrivals; what the second has from ten days or more before the end of the first is late."""
    events = table(spark, sf, "events").select("event_id", "user_id", "event_type", F.date_trunc("day", "ts").alias("day"))
    target, checkpoint = work_path(spark, "window"), work_path(spark, "window-state")
    _two_arrivals(spark, events, lambda s: L.append_batches(
        L.distinct_stream(s, ["user_id", "event_type"], "day", "10 days", ["user_id", "event_type", "day"]), target, checkpoint, lambda b: b,
    ))
    return spark.read.parquet(target).select("user_id", "event_type", F.date_format("day", "yyyy-MM-dd").alias("day"))
