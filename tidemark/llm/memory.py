"""What a Python worker holds between its tasks."""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator
from functools import cache, wraps

import pyarrow as pa


@cache
def _trim() -> Callable[[int], int] | None:
    return getattr(ctypes.CDLL(None), "malloc_trim", None)


def release() -> None:
    """Gives freed memory back to the system."""
    pa.default_memory_pool().release_unused()
    if trim := _trim():
        trim(0)


def lean(scan: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """The function of a ``mapInArrow`` whose worker, once the task is over, holds only what it still refers to.

    Workers wait for their next task, and what they freed counts against the executor meanwhile.
    """

    @wraps(scan)
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from scan(batches)
        release()

    return run
