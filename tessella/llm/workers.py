"""Python workers outlive their tasks and share an executor's memory with the JVM: what a task has freed goes back to the system."""

from __future__ import annotations

import contextlib
import ctypes
from collections.abc import Callable, Iterator

import pyarrow as pa


def give_back() -> None:
    """Return the free memory that Arrow's pool and the C library still hold."""
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(AttributeError, OSError):  # only glibc can be asked to
        ctypes.CDLL(None).malloc_trim(0)


def lean(task: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]):
    """``task``, a function for mapInArrow, after which its worker gives back what it has freed."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from task(batches)
        finally:
            give_back()
    return run
