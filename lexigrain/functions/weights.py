"""Rank to weight."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import as_col

# Fixed value: the rank where the tail damping starts.
TAIL_START = 100_000

WEIGHT_TYPE = "decimal(28,18)"


def rank_weight(rank, max_rank: int | None = None) -> Column:
    """Inverse square root of the rank, damped quadratically past the tail start.

    0 below 1 and for NULL, and past ``max_rank`` where that is given.
    """
    r = as_col(rank).cast("double")
    ratio = F.lit(float(TAIL_START)) / r
    damping = F.when(r > TAIL_START, ratio * ratio).otherwise(1.0)
    known = (r >= 1) if max_rank is None else r.between(1, max_rank)
    return F.when(known, F.lit(1.0) / F.sqrt(r) * damping).otherwise(0.0)


def exact_weight(rank, max_rank: int | None = None) -> Column:
    """The weight as a decimal, so that sums do not depend on the order of rows."""
    return rank_weight(rank, max_rank).cast(WEIGHT_TYPE)
