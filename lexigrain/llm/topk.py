"""Exact top-k search over weighted terms with the MaxScore rule.

A record is a list of terms with integer weights, such as its readings with their scores.
Weights of either sign are allowed: a term's postings are split by sign, and a query's weight
meets the postings of its own sign with a gain and the others with a loss, so the sum of the
gains bounds every score. Postings are cut into runs of records with the largest weight of
each list. Within a run the query's gaining terms are ordered by their bound; those whose
bounds together stay below the ``k``-th score so far are not essential: a record met by none
of the essential lists cannot enter. Essential lists are traversed; the records they meet are
probed in the other lists, largest bound first, as long as they can still compete. The
``k``-th score goes on from shard to shard of a lane, and the lanes are merged.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shards import search

RUN = 2048


def top_scores(
    records: DataFrame, queries: DataFrame, k: int, key: str = "key", terms: str = "terms", scores: str = "scores",
) -> DataFrame:
    """``query, rank, key, score``: the ``k`` records of largest inner product for each query.

    ``records``, ``queries``  a bigint key, an array of integer terms, the array of their integer
                              scores (for instance a key's readings by number, with their weights)

    A query never finds records of its own key. Scores are exact integers; a record that shares
    no term has score 0. Ties go to the smaller key, ranks start at 1; with fewer candidates all
    are returned. Rows with a NULL key, NULL arrays, arrays of different lengths or NULL parts
    take no part on either side; empty arrays do. A term given twice counts with the sum of its
    scores. Repeated rows are found, repeated queries answered, as often as they occur. Empty
    tables give no rows. Further columns are ignored. Scores must fit 64 bits.
    """

    def build(columns: dict[str, list]) -> dict:
        import numpy as np

        n = len(columns["key"])
        order = np.argsort(np.array(columns["key"], np.int64), kind="stable")
        lengths = np.array([len(t) for t in columns["terms"]])
        place = np.empty(n, np.int64)
        place[order] = np.arange(n)
        row = np.repeat(place, lengths)
        flat = lambda name: np.array([x for one in columns[name] for x in one], np.int64)
        term, weight = flat("terms"), flat("scores")
        if len(row):  # a term given twice
            both = np.lexsort((term, row))
            row, term, weight = row[both], term[both], weight[both]
            first = np.flatnonzero(np.concatenate([[True], (row[1:] != row[:-1]) | (term[1:] != term[:-1])]))
            row, term, weight = row[first], term[first], np.add.reduceat(weight, first)
        row, term, weight = (a[weight != 0] for a in (row, term, weight))
        runs = []
        for start in range(0, n, RUN):
            held = (row >= start) & (row < start + RUN)
            local, name, value = row[held] - start, term[held], weight[held]
            lists = {}
            grouped = np.lexsort((local, value < 0, name))
            local, name, value = local[grouped], name[grouped], value[grouped]
            cuts = np.flatnonzero((name[1:] != name[:-1]) | ((value[1:] < 0) != (value[:-1] < 0))) + 1
            for a, b in zip([0, *cuts], [*cuts, len(name)], strict=True):
                if b > a:
                    lists[int(name[a]), bool(value[a] < 0)] = (local[a:b], value[a:b], int(np.abs(value[a:b]).max()))
            runs.append((min(RUN, n - start), lists))
        return {"key": np.array(columns["key"], np.int64)[order], "runs": runs}

    def answer(index: dict, asked: dict[str, list], found: list) -> None:
        for i, (own, names, weights) in enumerate(zip(*(asked[c] for c in ("key", "terms", "scores")), strict=True)):
            wanted: dict[int, int] = {}
            for t, w in zip(names, weights, strict=True):
                wanted[t] = wanted.get(t, 0) + w
            found[i] = _one(index, own, wanted, k, *found[i])

    def picked(df: DataFrame) -> DataFrame:
        held = df.select(
            F.col(key).cast("bigint").alias("key"), F.col(terms).cast("array<bigint>").alias("terms"),
            F.col(scores).cast("array<bigint>").alias("scores"),
        )
        whole = [F.col("key").isNotNull(), F.size("terms") == F.size("scores")]
        for c in ("terms", "scores"):
            whole += [F.col(c).isNotNull(), ~F.exists(c, lambda x: x.isNull())]
        for condition in whole:
            held = held.where(condition)
        return held

    return search(picked(records), picked(queries), build, answer, k, "bigint")


def _one(index: dict, own: int, wanted: dict[int, int], k: int, best, best_key) -> tuple:
    """The ``k`` best scores and keys of a shard and of what other shards gave. Within a run a later equal score never wins."""
    import numpy as np

    start = 0
    for n, lists in index["runs"]:
        keys = index["key"][start:start + n]
        start += n
        # A score equal to the k-th one enters with a smaller key, as another shard may have given a larger one.
        floor = int(best[-1]) - int(best_key[-1] > keys[0]) if len(best) == k else None
        gains, losses = [], []
        for t, w in wanted.items():
            if w and (found := lists.get((t, w < 0))):
                gains.append((abs(w) * found[2], w, found))
            if w and (found := lists.get((t, w > 0))):
                losses.append((w, found))
        gains.sort(key=lambda g: g[0])
        rest, split = 0, 0  # bounds of the terms that are not essential
        while floor is not None and split < len(gains) and rest + gains[split][0] <= floor:
            rest += gains[split][0]
            split += 1
        total, met = np.zeros(n, np.int64), np.zeros(n, bool)
        for _, w, (rows, values, _most) in gains[split:]:
            total[rows] += w * values
            met[rows] = True
        if floor is None or floor < 0 or rest > floor:
            met[:] = True  # a record without any gain may still enter
        for bound, w, (rows, values, _most) in reversed(gains[:split]):
            _probe(total, met, w, rows, values)
            rest -= bound
            met &= total + rest > floor
            if not met.any():
                break
        for w, (rows, values, _most) in losses:
            if not met.any():
                break
            _probe(total, met, w, rows, values)
            if floor is not None:
                met &= total > floor
        alive = np.flatnonzero(met & (keys != own))
        if len(alive):
            score, key = np.concatenate([best, total[alive]]), np.concatenate([best_key, keys[alive]])
            top = np.lexsort((key, -score))[:k]
            best, best_key = score[top], key[top]
    return best, best_key


def _probe(total, met, weight: int, rows, values) -> None:
    hit = met[rows]
    total[rows[hit]] += weight * values[hit]
