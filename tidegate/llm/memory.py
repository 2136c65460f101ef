"""Python workers serve many tasks; what one has freed should go back to the machine."""

from __future__ import annotations

import ctypes

import pyarrow as pa


def release() -> None:
    """Give back memory that the allocators hold but nothing uses."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # of the GNU C library
    if trim is not None:
        trim(0)
