"""Helpers of the Python tasks: Arrow columns as bytes, and rows as Arrow batches."""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa


def column(batch: pa.RecordBatch, name: str) -> pa.Array:
    return batch.column(batch.schema.get_field_index(name))


def texts(batch: pa.RecordBatch, name: str = "text") -> list[str]:
    """The values as ``str``; null is empty, bytes that are no UTF-8 become replacement characters."""
    values = column(batch, name).cast(pa.large_binary()).to_pylist()
    return [value.decode("utf-8", "replace") if value else "" for value in values]


def packed(values: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All values as one run of bytes and their offsets in it (one more than values); null is empty."""
    binary = values.cast(pa.large_binary()).fill_null(b"")
    _, offsets, data = binary.buffers()
    offsets = np.frombuffer(offsets, np.int64)[binary.offset : binary.offset + len(binary) + 1]
    data = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


def slices(offsets: np.ndarray, most: int) -> Iterator[tuple[int, int]]:
    """Ranges of values that hold ``most`` bytes at most, or one value."""
    first, n = 0, len(offsets) - 1
    while first < n:
        last = max(first + 1, int(np.searchsorted(offsets, offsets[first] + most, "right")) - 1)
        yield first, last
        first = last


def giving_back(run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """``run``, after which the worker's free memory goes back to the system.

    Workers live on from step to step; what each step's arrays leave behind in the allocators would add up.
    """

    def whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from run(batches)
        pa.default_memory_pool().release_unused()
        trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # the GNU library has it
        if trim:
            trim(0)

    return whole
