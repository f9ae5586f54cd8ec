"""What a Python worker keeps between tasks.

Workers are used again for other tasks and operators. What an operator held must not add up with
what the next one needs.
"""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator

import pyarrow as pa
import pyarrow.compute as pc

#: Characters after which a worker gives freed memory back.
RELEASE_CHARS = 8_000_000

_kept: dict[tuple, object] = {}


def kept(name: tuple, make: Callable[[], object]) -> object:
    """The one large table of a worker, kept from task to task until an operator asks for another."""
    if name not in _kept:
        _kept.clear()
        _kept[name] = make()
    return _kept[name]


def forget() -> None:
    _kept.clear()


def release() -> None:
    """Give freed memory back to the system, where its allocators can."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)


def lean(work: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]) -> Callable:
    """``work``, at whose end the worker gives back what it no longer uses."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from work(batches)
        finally:
            release()

    return run


def bare(work: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]) -> Callable:
    """``lean`` work that keeps no table; one that another operator left is dropped before it begins."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if _kept:
            forget()
            release()
        yield from work(batches)

    return lean(run)


def by_size(batches: Iterator[pa.RecordBatch], chars: int) -> Iterator[pa.RecordBatch]:
    """Parts of batches whose column ``gloss`` has little more than ``chars`` characters in all, or one text; freed memory is given back in between."""
    done = 0
    for batch in batches:
        at = size = 0
        for i, n in enumerate(pc.utf8_length(batch.column("gloss")).to_pylist()):
            size += n or 0
            if size > chars or i + 1 == batch.num_rows:
                yield batch.slice(at, i + 1 - at)
                done += size
                at, size = i + 1, 0
                if done > RELEASE_CHARS:
                    release()
                    done = 0
