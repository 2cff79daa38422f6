"""Keys that similar sets must share: the pigeonhole over a partition of the universe.

Sets whose Jaccard similarity reaches a threshold differ in few elements. Sizes
are cut into bands; in a band ``differ`` elements at most are in one of two linked
sets only. A hash deals the elements into segments, the same for every set of
the band, and the differing elements spoil only some of them:

* ``equal``: a segment without a differing element is the same in both sets;
* ``subset``: a segment with one is still the same in two of its three parts;
* ``deletion``: with one, a set's segment is the other's without one element.

Each kind needs a certain number of segments; which kind a band uses, and with
how many spare segments, is the cheapest by ``cost``: keys to ship, and expected
meetings of sets that are not similar, which short keys cause.

Spare segments buy the right to leave out keys without content. With ``spare``
segments more than needed, linked sets share keys in ``spare + 1`` segments. If all
of those were empty, both sets would have more than ``spare`` empty ones; so only
such (rare) sets emit empty keys.
"""

from __future__ import annotations

import functools
import math
from typing import NamedTuple

import numpy as np

from tickloom.llm.words import exact_words, mix

_STEP = np.uint64(0x9E3779B97F4A7C15)
# The cost model: chance that an element of an unrelated set fits, weight of such meetings, weight of empty keys.
FITS, MEETING, EMPTY = 0.3, 40.0, 1e5


def shingle_sets(data: np.ndarray, offsets: np.ndarray, n: int) -> list[np.ndarray]:
    """Per text the sorted distinct hashes of its ``n``-word shingles; a shorter text is one shingle as a whole."""
    hashes, counts = exact_words(data, offsets)
    ends = np.cumsum(counts)
    rolled = np.zeros(max(0, len(hashes) - n + 1), np.uint64)
    for j in range(n):
        rolled = mix(rolled * _STEP + hashes[j : j + len(rolled)])
    out = []
    for end, count in zip(ends.tolist(), counts.tolist(), strict=True):
        if count >= n:
            out.append(np.unique(rolled[end - count : end - n + 1]))
        elif count:
            whole = mix(np.array([count], np.uint64))
            for j in range(end - count, end):
                whole = mix(whole * _STEP + hashes[j : j + 1])
            out.append(whole)
        else:
            out.append(np.zeros(0, np.uint64))
    return out


class Band(NamedTuple):
    number: int
    low: int  # the smallest size of the smaller set
    high: int  # its largest size
    partner: int  # the largest size of the other one
    differ: int  # elements that are in one of the two only, at most
    kind: str
    segments: int
    spare: int


def _tail(mean: float, most: int) -> float:
    """The chance that a Poisson number of this mean exceeds ``most``."""
    term, below = math.exp(-mean), 0.0
    for i in range(most + 1):
        below += term
        term *= mean / (i + 1)
    return max(0.0, 1 - below)


def _options(low: int, differ: int):
    for spare in [*range(40), *range(40, 80, 4), *range(80, 1000, 20)]:
        m = differ + 1 + spare
        size = low / m
        yield m, size, m * math.exp(-size), "equal", m, spare
        m = differ // 2 + 1 + spare
        size = low / m
        yield 3 * m, size * 2 / 3, m * 3 * math.exp(-size * 2 / 3), "subset", m, spare
        yield m + low, size - 1, m * (1 + size) * math.exp(-size), "deletion", m, spare


def cost(keys: float, size: float, empty: float, spare: int) -> float:
    return keys * (1 + MEETING * FITS ** max(size, 0)) + EMPTY * _tail(empty, spare)


@functools.lru_cache(maxsize=4096)
def band(number: int, low: int, threshold: int) -> Band:
    high = 100 * low // threshold
    partner = 100 * high // threshold
    differ = (100 - threshold) * (high + partner) // (100 + threshold)
    keys, size, empty, kind, segments, spare = min(_options(low, differ), key=lambda o: cost(o[0], o[1], o[2], o[5]))
    return Band(number, low, high, partner, differ, kind, segments, spare)


@functools.lru_cache(maxsize=4)
def _lows(threshold: int) -> list[int]:
    return [1]


def bands_of(size: int, threshold: int) -> list[Band]:
    """The bands in which a set of this size may meet a partner: its own, and the one below if it is small enough."""
    lows = _lows(threshold)
    while lows[-1] <= size:
        lows.append(100 * lows[-1] // threshold + 1)
    own = int(np.searchsorted(lows, size, "right")) - 1
    out = [band(own, lows[own], threshold)]
    if own and size <= (below := band(own - 1, lows[own - 1], threshold)).partner:
        out.append(below)
    return out


def keys_in(elements: np.ndarray, b: Band) -> np.ndarray:
    """The set's keys in a band; none where linked sets can only be equal."""
    if not b.differ:
        return np.zeros(0, np.uint64)
    parts = 3 if b.kind == "subset" else 1
    slots = b.segments * parts
    slot = ((elements >> np.uint64(11)) % np.uint64(slots)).astype(np.int64)
    values = mix(elements + _STEP)
    order = np.argsort(slot, kind="stable")
    filled, starts, counts = np.unique(slot[order], return_index=True, return_counts=True)
    sums, sizes = np.zeros(slots, np.uint64), np.zeros(slots, np.int64)
    sums[filled], sizes[filled] = np.add.reduceat(values[order], starts), counts
    salt = mix(np.arange(slots, dtype=np.uint64) + np.uint64(b.number << 32) + np.uint64(1))
    if b.kind == "subset":
        sums, sizes = sums.reshape(-1, 3), sizes.reshape(-1, 3)
        content, size = sums.sum(1, keepdims=True) - sums, sizes.sum(1, keepdims=True) - sizes
        keys = mix(content ^ salt.reshape(-1, 3))
        empty = size == 0
        spoiled = int(empty.any(1).sum())
    elif b.kind == "equal":
        keys, empty = mix(sums ^ salt), sizes == 0
        spoiled = int(empty.sum())
    else:
        without = sums[slot] - values
        keys = np.concatenate([mix(sums ^ salt), mix(without ^ salt[slot])])
        empty = np.concatenate([sizes == 0, sizes[slot] == 1])
        spoiled = int((sizes <= 1).sum())
    return keys.ravel() if spoiled > b.spare else keys[~empty]


def keys_of(elements: np.ndarray, threshold: int) -> np.ndarray:
    """Distinct keys of a set; two different sets at or above the threshold share one."""
    if not len(elements):
        return np.zeros(0, np.uint64)
    return np.unique(np.concatenate([keys_in(elements, b) for b in bands_of(len(elements), threshold)]))


def sketch(elements: np.ndarray, bins: int = 128) -> np.ndarray:
    """How many elements fall into each of ``bins`` (a power of two) bins.

    The sum of two sketches' differences is never more than the number of
    elements that are in one of the sets only.
    """
    return np.bincount((elements >> np.uint64(3)).astype(np.int64) & (bins - 1), minlength=bins).astype(np.int32)
