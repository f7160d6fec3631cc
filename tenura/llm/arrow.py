"""Text columns as flat byte arrays, in pieces of bounded size."""

from __future__ import annotations

import ctypes
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

SLICE_BYTES = 4 << 20


def raw(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of all values end to end, and where each begins; a null is empty."""
    texts = pc.fill_null(column.cast(pa.large_string()), "")
    offsets = np.frombuffer(texts.buffers()[1], np.int64, count=texts.offset + len(texts) + 1)[texts.offset :]
    data = texts.buffers()[2]
    flat = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return flat[offsets[0] : offsets[-1]], offsets - offsets[0]


def binaries(flat: np.ndarray, counts: np.ndarray) -> pa.Array:
    """Binary values that hold so many numbers of ``flat`` each, end to end."""
    offsets = (np.concatenate([[0], np.cumsum(counts)]) * flat.itemsize).astype(np.int32)
    return pa.Array.from_buffers(pa.binary(), len(counts), [None, pa.py_buffer(offsets), pa.py_buffer(np.ascontiguousarray(flat))])


def numbers(column: pa.Array, kind: str) -> tuple[np.ndarray, np.ndarray]:
    """The numbers in binary values without nulls, end to end, and how many each holds."""
    values = column.cast(pa.large_binary())
    offsets = np.frombuffer(values.buffers()[1], np.int64, count=values.offset + len(values) + 1)[values.offset :]
    data = np.frombuffer(values.buffers()[2] or b"", np.uint8)[offsets[0] : offsets[-1]]
    return data.view(kind), np.diff(offsets) // np.dtype(kind).itemsize


def slices(batches: Iterator[pa.RecordBatch], column: str, limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """The same rows in runs of at most ``limit`` bytes of ``column``; a longer value comes alone."""
    for batch in batches:
        if not batch.num_rows:
            continue
        sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
        ends = np.cumsum(sizes, dtype=np.int64)
        first = 0
        while first < batch.num_rows:
            done = ends[first - 1] if first else 0
            last = max(first + 1, int(np.searchsorted(ends, done + limit, "right")))
            yield batch.slice(first, last - first)
            first = last
    release()


def release() -> None:
    """Give freed memory back to the system: a worker process outlives its task and keeps it otherwise."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)
