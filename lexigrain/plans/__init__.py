"""Named queries: operators bound to the given tables, each with its SQL counterpart."""

from .base import ORACLES, QUERIES
from . import documents, examples, lists, markup, records, scoring, snapshots, streams, text  # noqa: F401

__all__ = ["QUERIES", "ORACLES"]
