"""Search in blocks: every row of a table meets every block of a stated query set, nothing larger.

The table is cut where it is read into shards of bounded size, one binary row each, so neither
a key nor a partition decides how large a shard becomes. A lane holds up to about ``LANE_SHARDS``
shards and reads the query blocks, bounded too, one after the other. So every row is shuffled
once and the query set once a lane. What a query has found in one shard of a lane is the floor
it starts the next one from; the lanes' answers, ``k`` per query, are merged by a limited window.
Work is queries times rows, as a stated query set asks for.
"""

from __future__ import annotations

import pickle
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import staged

BLOCK_QUERIES = 2048
SHARD_ROWS = 4096
#: Shards of a lane. Fewer lanes shuffle less; a lane's shards are held while its query blocks pass.
LANE_SHARDS = 16


def cut(df: DataFrame, rows: int, build: Callable[[dict[str, list]], object]) -> DataFrame:
    """One row ``blob`` per at most ``rows`` rows of a partition: ``build`` of their columns, pickled."""

    def blobs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in _slices(batches, rows):
            blob = pickle.dumps(build(part.to_pydict()), protocol=5)
            yield pa.RecordBatch.from_arrays([pa.array([blob], pa.binary())], ["blob"])

    return df.mapInArrow(blobs, "blob binary")


def _slices(batches: Iterable[pa.RecordBatch], rows: int) -> Iterator[pa.Table]:
    held: list[pa.RecordBatch] = []
    n = 0
    for batch in batches:
        while batch.num_rows:
            take = batch.slice(0, rows - n)
            held.append(take)
            n += take.num_rows
            batch = batch.slice(take.num_rows)
            if n == rows:
                yield pa.Table.from_batches(held)
                held, n = [], 0
    if n:
        yield pa.Table.from_batches(held)


def search(
    rows: DataFrame, queries: DataFrame, build: Callable, answer: Callable[[object, dict[str, list], list], None],
    k: int, score_type: str, shard_rows: int = SHARD_ROWS, block_queries: int = BLOCK_QUERIES,
) -> DataFrame:
    """``query, rank, key, score``: the ``k`` best rows of each query, ties to the smaller key.

    ``rows`` and ``queries`` have the same columns, the first a bigint ``key``. ``build`` makes a
    shard's index of its columns. ``answer`` takes an index, the columns of a query block (with
    ``uid``, which tells repeated queries apart) and, for each of its queries, the scores and keys
    of the at most ``k`` best rows found so far, best first, which it betters in place.
    """
    queries = staged(queries.withColumn("uid", F.monotonically_increasing_id()), "queries")
    blocks = -(-queries.count() // block_queries)
    shards = -(-rows.count() // shard_rows)
    # A small table still gives every core a lane.
    lanes = max(1, -(-shards // LANE_SHARDS), min(shards, 2 * rows.sparkSession.sparkContext.defaultParallelism))
    lane = F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.lit(lanes))
    every = F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(lanes - 1).cast("bigint")))
    index = cut(rows, shard_rows, build).select(lane.alias("lane"), F.lit(0).alias("turn"), "blob")
    asked = cut(queries.coalesce(max(1, blocks)), block_queries, dict).select(every.alias("lane"), F.lit(1).alias("turn"), "blob")
    dealt = index.unionByName(asked).repartitionById(lanes, F.col("lane").cast("int")).sortWithinPartitions("lane", "turn")
    kind = np.float64 if score_type == "double" else np.int64

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, held = None, []
        for batch in batches:
            for here, turn, blob in zip(batch.column("lane").to_pylist(), batch.column("turn").to_pylist(), batch.column("blob"), strict=True):
                if here != at:
                    at, held = here, []
                if turn == 0:
                    held.append(pickle.loads(blob.as_buffer()))
                    continue
                block = pickle.loads(blob.as_buffer())
                best = [(np.empty(0, kind), np.empty(0, np.int64)) for _ in block["uid"]]
                for one in held:
                    answer(one, block, best)
                times = [len(keys) for _, keys in best]
                if sum(times):
                    columns = [np.repeat(np.array(block[c], np.int64), times) for c in ("uid", "key")]
                    columns += [np.concatenate([keys for _, keys in best]), np.concatenate([score for score, _ in best])]
                    yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["uid", "query", "key", "score"])

    best = dealt.mapInArrow(work, f"uid bigint, query bigint, key bigint, score {score_type}")
    order = Window.partitionBy("uid").orderBy(F.desc("score"), "key")
    ranked = best.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return ranked.select("query", "rank", "key", "score")
