"""What a Python worker remembers between tasks: of one operator at a time.

Workers are used again by later stages. What an earlier operator remembered is dropped when another
one starts, so that the bounds of the operators hold for the worker as a whole.
"""

from __future__ import annotations

import ctypes
from collections.abc import Callable

import pyarrow as pa

# Options for jobs with whole texts: batches of about a thousand rows between Spark and Python, fewer
# where they are long. Each batch lies in the executor's native memory several times, which its allocator
# keeps per thread at the most it ever was.
SMALL_BATCHES = {
    "spark.sql.execution.arrow.maxRecordsPerBatch": "1000",
    "spark.sql.execution.arrow.maxBytesPerBatch": str(1 << 19),
}

_HELD: dict[str, Callable[[], None]] = {}


def remember(owner: str, forget: Callable[[], None]) -> None:
    """Say how to drop what ``owner`` remembers, and drop what all others do."""
    for other, drop in _HELD.items():
        if other != owner:
            drop()
    others = [x for x in _HELD if x != owner]
    for other in others:
        del _HELD[other]
    if others:
        give_back()
    _HELD[owner] = forget


def give_back() -> None:
    """Return freed memory to the system, where its allocators can.

    A worker that waits, or goes on with another operator, would otherwise keep the most that any of its
    tasks has used.
    """
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)
