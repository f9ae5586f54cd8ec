"""Approximate nearest neighbours by low-dimensional stable projections.

Vectors are scaled to length 1, where the largest cosine is the smallest distance, and
projected by a Gaussian matrix of ``DIMENSIONS`` columns. For two vectors at distance ``d``
the squared projected distance over ``d**2`` follows a chi-square distribution with
``DIMENSIONS`` degrees of freedom. Each shard keeps its projections in a kd-tree. A query
takes the tree's leaves in the order of their projected distance, verifies their vectors
by the true cosine, and stops when a vector at least as near as the ``k``-th found, in this
or an earlier shard, would have shown up already with probability ``confidence``. No number of candidates is set.
"""

from __future__ import annotations

import math
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .shards import search

DIMENSIONS = 12
LEAF = 32
CONFIDENCE = 0.99
#: Squared projected distance below which rounding decides: copies of one vector are no farther apart.
ROUNDING = 1e-9
SEED = 20177


def usable(vector: str) -> Column:
    """Whether a vector takes part: not NULL, not zero, every component finite."""
    c = F.col(vector)
    bad = F.exists(c, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return c.isNotNull() & ~F.coalesce(bad, F.lit(True)) & F.exists(c, lambda x: x != 0)


def chi_square_cdf(x: float, degrees: int) -> float:
    """P(X <= x) for an even number of degrees of freedom."""
    half, term, total = x / 2, 1.0, 0.0
    for i in range(degrees // 2):
        total += term
        term *= half / (i + 1)
    return 1.0 - math.exp(-half) * total if half < 700 else 1.0


def chi_square_quantile(p: float, degrees: int) -> float:
    low, high = 0.0, 10.0 * degrees + 100
    for _ in range(80):
        middle = (low + high) / 2
        low, high = (middle, high) if chi_square_cdf(middle, degrees) < p else (low, middle)
    return high


def _unit(vectors: list) -> tuple:
    """Vectors of one length as rows of length 1. Scaling by the largest part first keeps tiny and huge ones exact."""
    import numpy as np

    x = np.array(vectors, float)
    x /= np.abs(x).max(axis=1, keepdims=True)
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def _directions(n: int, dimensions: int):
    import numpy as np

    return np.random.default_rng([SEED, n]).standard_normal((n, dimensions))


def _leaves(points, leaf: int) -> list:
    """Row numbers by leaf of a kd-tree: halves at the median of the widest side."""
    import numpy as np

    todo, done = [np.arange(len(points))], []
    while todo:
        rows = todo.pop()
        if len(rows) <= leaf:
            done.append(rows)
            continue
        part = points[rows]
        side = np.argmax(part.max(axis=0) - part.min(axis=0))
        order = np.argpartition(part[:, side], len(rows) // 2)
        todo += [rows[order[len(rows) // 2:]], rows[order[:len(rows) // 2]]]
    return done


def nearest(
    vectors: DataFrame, queries: DataFrame, k: int, key: str = "key", vector: str = "vector",
    dimensions: int = DIMENSIONS, confidence: float = CONFIDENCE,
) -> DataFrame:
    """``query, rank, key, score``: the ``k`` rows of largest cosine found for each query.

    The lexicon's records carry no vectors, so this is general: ``vectors`` and ``queries`` hold
    a bigint key and an array of numbers, for instance an embedding of a record's glosses.

    A query never finds rows of its own key. Scores are cosines in double precision, ties go to
    the smaller key, ranks start at 1; with fewer candidates all are returned. Vectors that are
    NULL, zero, or hold NULL or non-finite parts take no part on either side, nor do rows with a
    NULL key. Vectors of different lengths are not compared. Repeated rows are found as often as
    they occur, repeated queries are answered as often. Empty tables give no rows. Further
    columns are ignored. ``confidence`` bounds from below the chance that any one true
    neighbour is found; ``dimensions`` is even.
    """
    if dimensions % 2:
        raise ValueError("an even number of dimensions is needed")
    limit = chi_square_quantile(confidence, dimensions)

    def build(columns: dict[str, list]) -> list:
        import numpy as np

        out, by_length = [], {}
        for i, v in enumerate(columns["vector"]):
            by_length.setdefault(len(v), []).append(i)
        for n, rows in by_length.items():
            x = _unit([columns["vector"][i] for i in rows])
            p = x @ _directions(n, dimensions)
            leaves = _leaves(p, LEAF)
            order = np.concatenate(leaves)
            ends = np.cumsum([0, *map(len, leaves)])
            low, high = (np.array([f(p[rows_], axis=0) for rows_ in leaves]) for f in (np.min, np.max))
            out.append((n, np.array(columns["key"])[rows][order], x[order], ends, low, high))
        return out

    def answer(index: list, asked: dict[str, list], found_so_far: list) -> None:
        import numpy as np

        for n, keys, x, ends, low, high in index:
            rows = [i for i, v in enumerate(asked["vector"]) if len(v) == n]
            if not rows:
                continue
            q = _unit([asked["vector"][i] for i in rows])
            projected = q @ _directions(n, dimensions)
            for i, one, p in zip(rows, q, projected, strict=True):
                outside = np.maximum(np.maximum(low - p, p - high), 0)
                bounds = (outside * outside).sum(axis=1)
                own, at, (best, best_key) = asked["key"][i], 0, found_so_far[i]
                order = np.argsort(bounds)
                while at < len(order):
                    if len(best) == k and bounds[order[at]] > limit * 2 * max(0.0, 1 - best[-1]) + ROUNDING:
                        break  # any vector as near as the k-th would have been met before
                    step = order[at:at + 4]
                    at += len(step)
                    picked = np.concatenate([np.arange(ends[j], ends[j + 1]) for j in step])
                    # Row by row, so that copies have one score wherever they stand; a matrix product may round them apart.
                    score, found = (x[picked] * one).sum(axis=1), keys[picked]
                    mine = found != own
                    score, found = np.concatenate([best, score[mine]]), np.concatenate([best_key, found[mine]])
                    top = np.lexsort((found, -score))[:k]
                    best, best_key = score[top], found[top]
                found_so_far[i] = best, best_key

    def picked(df: DataFrame) -> DataFrame:
        held = df.select(F.col(key).cast("bigint").alias("key"), F.col(vector).cast("array<double>").alias("vector"))
        return held.where(F.col("key").isNotNull() & usable("vector"))

    return search(picked(vectors), picked(queries), build, answer, k, "double")
