"""Slices of Arrow batches, and memory handed back after them."""

from __future__ import annotations

import ctypes
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Bytes of text that are handled at once inside a batch.
SLICE_BYTES = 4 << 20


def cut(batch: pa.RecordBatch, column: int, limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Slices of a batch with about ``limit`` bytes of text each; a longer text is a slice by itself."""
    if not batch.num_rows:
        return
    sizes = np.array([0 if n is None else n for n in pc.binary_length(batch.column(column)).to_pylist()], np.int64)
    turn = (np.cumsum(sizes) - sizes) // limit
    edges = [0, *(np.flatnonzero(np.diff(turn)) + 1).tolist(), batch.num_rows]
    for a, b in zip(edges, edges[1:]):
        yield batch.slice(a, b - a)


def release() -> None:
    """Hand freed memory back, as a worker lives on beside the next stages' workers."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL("libc.so.6").malloc_trim(0)
    except (OSError, AttributeError):  # another C library
        pass
