"""Runs of word characters in packed UTF-8 texts, as a dictionary of the different words and indices into it.

Bytes decide what belongs to a word, so nothing is done word by word in Python
but for the different words of a portion. Portions end between words: a very
long text is worked off in several.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa

# Bytes worked on at once; a longer word extends its portion.
PORTION = 1 << 21

FOLD = np.arange(256, dtype=np.uint8)
FOLD[ord("A") : ord("Z") + 1] += 32


class Portion(NamedTuple):
    words: pa.Array  # the different words, binary
    index: np.ndarray  # per run its word
    owner: np.ndarray  # per run its text, rising


def gathered(batches: Iterator[pa.RecordBatch], name: str, most: int) -> Iterator[pa.RecordBatch]:
    """Batches put together until their texts hold ``most`` bytes, so that equal words meet."""
    held: list[pa.RecordBatch] = []
    size = 0
    for batch in batches:
        held.append(batch)
        size += batch.column(batch.schema.get_field_index(name)).nbytes
        if size >= most:
            yield from pa.Table.from_batches(held).combine_chunks().to_batches()
            held, size = [], 0
    if held:
        yield from pa.Table.from_batches(held).combine_chunks().to_batches()


def as_utf8(values: pa.Array) -> pa.Array:
    """The texts; bytes that are no UTF-8 become replacement characters."""
    values = values.cast(pa.large_binary())
    try:
        return values.cast(pa.large_string())
    except pa.ArrowInvalid:
        whole = [v if v is None else v.decode("utf-8", "replace") for v in values.to_pylist()]
        return pa.array(whole, pa.large_string())


def word_bytes(*spans: tuple[int, int]) -> np.ndarray:
    """A table of 256 flags with the bytes of the spans (both ends included)."""
    table = np.zeros(256, bool)
    for first, last in spans:
        table[first : last + 1] = True
    return table


def portions(data: np.ndarray, offsets: np.ndarray, inside: np.ndarray, most: int = PORTION) -> Iterator[Portion]:
    """The maximal runs of ``inside`` bytes, A to Z as a to z; no run crosses from one text into the next."""
    first_of = np.zeros(len(data) + 1, bool)
    first_of[offsets] = True
    at = 0
    while at < len(data):
        end = min(at + most, len(data))
        while end < len(data) and inside[end] and inside[end - 1] and not first_of[end]:
            upto = min(end + most, len(data))
            stops = np.flatnonzero(~inside[end:upto] | first_of[end:upto])
            end = end + int(stops[0]) if len(stops) else upto
        held, fresh = inside[at:end], first_of[at:end]
        before = np.zeros(len(held), bool)
        before[1:] = held[:-1]
        starts = np.flatnonzero(held & (~before | fresh))
        if len(starts):
            # Words follow each other without a gap in what is left of the bytes.
            ends = np.append(np.cumsum(held)[starts] - 1, np.count_nonzero(held))
            values = FOLD[data[at:end][held]]
            array = pa.LargeBinaryArray.from_buffers(
                pa.large_binary(), len(starts), [None, pa.py_buffer(ends.astype(np.int64)), pa.py_buffer(values)]
            ).dictionary_encode()
            owner = np.searchsorted(offsets, starts + at, "right") - 1
            yield Portion(array.dictionary, array.indices.to_numpy(), owner)
        at = end
