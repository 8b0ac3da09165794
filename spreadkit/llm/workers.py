"""Memory of Python workers, which Spark keeps alive between tasks.

``held`` keeps one large object (an encoder with its cache) for the tasks of one
operator; the next operator's first task drops it. ``lean`` gives what a task of a
large worker has freed back to the system when the task ends, which neither malloc
nor Arrow does by itself: several operators in one application would else add up.
"""

from __future__ import annotations

import ctypes
import gc
import os
from collections.abc import Callable, Iterator

import pyarrow as pa

# a worker smaller than this keeps what it has: small tasks should stay cheap
KEPT_BYTES = 256 << 20

_held: dict = {}


def held(key: tuple, build: Callable):
    """The object of this key, built once in a worker; drops any other."""
    if key not in _held:
        _held.clear()
        trim()
        _held[key] = build()
    return _held[key]


def resident() -> int:
    """Bytes of memory this process holds (0 where the system does not say)."""
    try:
        with open("/proc/self/statm") as f:
            return int(f.read().split()[1]) * os.sysconf("SC_PAGE_SIZE")
    except OSError:
        return 0


def trim() -> None:
    """Give freed memory back, if there may be much."""
    if 0 < resident() < KEPT_BYTES:
        return
    gc.collect()
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL("libc.so.6").malloc_trim(0)
    except OSError:  # another C library: it has its own ways
        pass


def lean(run: Callable, keep: tuple | None = None) -> Callable:
    """``run`` for mapInArrow, without objects held for other operators (all but
    ``keep``) and with its memory given back at its end."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for key in [k for k in _held if k != keep]:
            del _held[key]
        try:
            yield from run(batches)
        finally:
            trim()

    return task
