"""What a Python worker keeps between tasks, and giving memory back.

Spark reuses its Python workers. A table that pays off over the tasks of one stage
would stay through all later ones, so a worker keeps a single object, and tasks
that keep none give all of it back.
"""

from __future__ import annotations

import ctypes
import gc
from collections.abc import Callable, Hashable, Iterator
from typing import Any

import pyarrow as pa

_kept: dict[Hashable, Any] = {}


def kept(key: Hashable, build: Callable[[], Any]) -> Any:
    """The object of ``key``, built once per worker as long as no other is asked for."""
    if key not in _kept:
        release()
        _kept[key] = build()
    return _kept[key]


def release() -> None:
    """Drop what is kept and return free memory to the system."""
    _kept.clear()
    gc.collect()
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)


def lean(run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]):
    """The function over batches, with memory given back before and after."""

    def run_lean(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        release()
        yield from run(batches)
        release()

    return run_lean
