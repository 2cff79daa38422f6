"""Words of packed texts as 64-bit hashes, for many texts at once.

A word is a run of bytes other than space and 0x09 to 0x0D; A to Z count as a to z.
"""

from __future__ import annotations

from typing import NamedTuple

import numpy as np
import xxhash

from tickloom.llm.runs import portions

_RANDOM = np.random.default_rng(20_240_613)
_ODD = np.uint64(0x9E3779B97F4A7C15)
_BASE = 0xD6E8FEB86659FD93
_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_VALUES = _RANDOM.integers(1, 2**63, 256, np.uint64) * np.uint64(2) + np.uint64(1)
_FOLDED = _VALUES.copy()
_FOLDED[ord("A") : ord("Z") + 1] = _VALUES[ord("a") : ord("z") + 1]

_powers = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """The first ``n`` powers of the base and of its inverse, modulo 2**64."""
    if len(_powers[0]) < n:
        for i, base in enumerate((_BASE, pow(_BASE, -1, 2**64))):
            table = np.full(max(n, 1 << 16), base, np.uint64)
            table[0] = 1
            _powers[i] = np.multiply.accumulate(table)
    return _powers[0][:n], _powers[1][:n]


def mix(x: np.ndarray) -> np.ndarray:
    """Every bit of the result depends on every bit of ``x`` (unsigned 64-bit, one to one)."""
    x = x ^ (x >> np.uint64(30))
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def prefix_sums(data: np.ndarray, fold: bool = False) -> np.ndarray:
    """``s`` with ``s[i]`` the polynomial sum of the first ``i`` bytes; see ``span_hash``."""
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum((_FOLDED if fold else _VALUES)[data] * powers(len(data))[0], out=sums[1:])
    return sums


def span_hash(sums: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Hashes of the spans ``[start, end)``; equal bytes have equal hashes wherever they stand."""
    return mix((sums[ends] - sums[starts]) * powers(len(sums))[1][starts] + (ends - starts).astype(np.uint64) * _ODD)


class Words(NamedTuple):
    hashes: np.ndarray
    counts: np.ndarray  # words per text


def words(data: np.ndarray, offsets: np.ndarray) -> Words:
    """The words' hashes in order, and how many each text has."""
    if not len(data):
        return Words(np.zeros(0, np.uint64), np.zeros(len(offsets) - 1, np.int64))
    inside = ~_SPACE[data]
    first = np.zeros(len(data) + 1, bool)
    first[offsets] = True  # a text's first byte
    starts = inside.copy()
    starts[1:] &= ~inside[:-1] | first[1:-1]
    ends = inside.copy()
    ends[:-1] &= ~inside[1:] | first[1:-1]
    starts = np.flatnonzero(starts)
    ends = np.flatnonzero(ends) + 1
    hashes = span_hash(prefix_sums(data, fold=True), starts, ends)
    return Words(hashes, np.diff(np.searchsorted(starts, offsets)))


def exact_words(data: np.ndarray, offsets: np.ndarray) -> Words:
    """The same, with hashes of each different word's bytes by xxh3.

    The sums of ``words`` can be equal for words built to a rule, such as the Thue-Morse word and
    its complement. What decides about equality of texts takes these.
    """
    counts = np.zeros(len(offsets) - 1, np.int64)
    hashes = [np.zeros(0, np.uint64)]
    for different, index, owner in portions(data, offsets, ~_SPACE[data]):
        named = np.fromiter(map(xxhash.xxh3_64_intdigest, different.to_pylist()), np.uint64, len(different))
        hashes.append(named[index])
        counts += np.bincount(owner, minlength=len(counts))
    return Words(np.concatenate(hashes), counts)
