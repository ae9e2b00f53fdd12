"""Memory of Python workers, which live on from task to task."""

from __future__ import annotations

import ctypes
import ctypes.util

import pyarrow as pa


def give_back() -> None:
    """Return freed memory to the system, where the C library can: between groups a worker keeps little."""
    pa.default_memory_pool().release_unused()
    name = ctypes.util.find_library("c")
    trim = getattr(ctypes.CDLL(name), "malloc_trim", None) if name else None
    if trim is not None:
        trim(0)
