"""Prefix-free parsing of texts: a rolling hash triggers the cuts, and phrases overlap.

A *window* is a string of ``match`` bytes. Of the rolling hashes of the grams in
it the smallest (the leftmost of equal ones) is the window's *trigger*; it is a
property of the window's bytes, so equal windows have equal triggers at equal
places wherever they stand. Successive windows of one trigger form a *phrase*,
which reaches from the first one's start to the last one's end. No phrase is
longer than twice a window.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np

from tickloom.llm.words import mix, powers, prefix_sums, span_hash

# Bytes parsed together; places in them fit into PLACE_BITS.
PLACE_BITS = 18
PIECE = 1 << PLACE_BITS
_PLACE = np.uint64(PIECE - 1)


class Piece(NamedTuple):
    data: np.ndarray
    offsets: np.ndarray
    texts: np.ndarray  # the texts' numbers
    starts: np.ndarray  # where in its text each part begins


def pieces(data: np.ndarray, offsets: np.ndarray, match: int) -> Iterator[Piece]:
    """Texts in pieces of bounded size; parts of a longer text overlap so that every window is in one part."""
    first, n = 0, len(offsets) - 1
    while first < n:
        size = int(offsets[first + 1] - offsets[first])
        if size > PIECE:
            step = PIECE - match + 1
            for start in range(0, size - match + 1, step):
                at = int(offsets[first]) + start
                part = data[at : min(at + PIECE, int(offsets[first + 1]))]
                yield Piece(part, np.array([0, len(part)]), np.array([first]), np.array([start]))
            first += 1
            continue
        last = max(first + 1, int(np.searchsorted(offsets, offsets[first] + PIECE, "right")) - 1)
        yield Piece(data[offsets[first] : offsets[last]], offsets[first : last + 1] - offsets[first], np.arange(first, last), np.zeros(last - first, np.int64))
        first = last


class Phrases(NamedTuple):
    text: np.ndarray  # the text's number
    start: np.ndarray  # the first window's place in the text
    count: np.ndarray  # windows
    trigger: np.ndarray  # hash of the trigger's gram
    content: np.ndarray  # hash of the phrase, and of where the trigger stands in it


def parse(piece: Piece, match: int, gram: int) -> Phrases:
    data, offsets = piece.data, piece.offsets
    n = len(data)
    windows = n - match + 1
    if windows <= 0:
        none = np.zeros(0, np.int64)
        return Phrases(none, none, none, none.astype(np.uint64), none.astype(np.uint64))
    sums = prefix_sums(data)
    rolling = mix((sums[gram:] - sums[:-gram]) * powers(n + 1)[1][: n + 1 - gram])
    low = (rolling & ~_PLACE) | np.arange(len(rolling), dtype=np.uint64)
    span, reach = match - gram + 1, 1
    while 2 * reach <= span:  # the smallest of the next ``reach`` grams
        low = np.minimum(low[:-reach], low[reach:])
        reach *= 2
    low = np.minimum(low[: len(low) - (span - reach)], low[span - reach :])
    sizes = np.diff(offsets)
    fits = np.maximum(sizes - match + 1, 0)
    whole = np.zeros(windows + 1, np.int64)
    inner = fits > 0
    np.add.at(whole, offsets[:-1][inner], 1)
    np.add.at(whole, np.minimum(offsets[:-1][inner] + fits[inner], windows), -1)
    place = np.flatnonzero(np.cumsum(whole[:windows]) > 0)
    if not len(place):
        none = np.zeros(0, np.int64)
        return Phrases(none, none, none, none.astype(np.uint64), none.astype(np.uint64))
    trigger = (low[place] & _PLACE).astype(np.int64)
    new = np.flatnonzero(np.r_[True, trigger[1:] != trigger[:-1]])
    count = np.diff(np.r_[new, len(place)])
    start, at = place[new], trigger[new]
    content = span_hash(sums, start, start + count + match - 1) ^ mix((at - start + 1).astype(np.uint64))
    text = np.searchsorted(offsets, start, "right") - 1
    return Phrases(piece.texts[text], start - offsets[text] + piece.starts[text], count, rolling[at], content)
