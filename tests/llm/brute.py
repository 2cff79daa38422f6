"""Plain versions of the operators, for small tables."""

from __future__ import annotations

import hashlib
import math
import re
from collections import Counter

WORD = re.compile(rb"[^\x20\x09-\x0D]+")
LOWER = bytes.maketrans(bytes(range(65, 91)), bytes(range(97, 123)))


def words(text: str | None) -> list[bytes]:
    return WORD.findall((text or "").encode().translate(LOWER))


def shingles(text: str | None, n: int) -> frozenset:
    found = words(text)
    if 0 < len(found) < n:
        return frozenset([tuple(found)])
    return frozenset(tuple(found[i : i + n]) for i in range(len(found) - n + 1))


def components(texts: dict[int, str | None], n: int, threshold: int) -> dict[int, tuple[int, int]]:
    """Per document the size of its set and its component."""
    sets = {doc: shingles(text, n) for doc, text in texts.items()}
    root = {doc: doc for doc in texts}

    def find(doc):
        while root[doc] != doc:
            doc = root[doc]
        return doc

    order = sorted(sets)
    for i, a in enumerate(order):
        for b in order[i + 1 :]:
            shared = len(sets[a] & sets[b])
            if shared and 100 * shared >= threshold * len(sets[a] | sets[b]):
                low, high = sorted((find(a), find(b)))
                root[high] = low
    return {doc: (len(sets[doc]), find(doc)) for doc in sets}


def removed(texts: list[tuple[int, bytes]], match: int) -> dict[int, list[bool]]:
    """Per document which bytes a repeat covers."""
    seen, out = set(), {}
    for doc, text in sorted(texts):
        gone = [False] * len(text)
        for i in range(len(text) - match + 1):
            part = text[i : i + match]
            if part in seen:
                gone[i : i + match] = [True] * match
            seen.add(part)
        out[doc] = gone
    return out


def spans(gone: list[bool]) -> int:
    return sum(1 for i, x in enumerate(gone) if x and (not i or not gone[i - 1]))


def top(vectors: dict[int, list[float]], query: int, k: int) -> list[tuple[int, int]]:
    whole = {i: [math.floor(256 * float(x)) for x in v] for i, v in vectors.items()}
    scores = [(-sum(a * b for a, b in zip(whole[query], v)), i) for i, v in whole.items() if i != query]
    return [(i, -s) for s, i in sorted(scores)[:k]]


def weighted_jaccard(a: str, b: str) -> float:
    x, y = Counter(words(a)), Counter(words(b))
    most = sum(max(x[w], y[w]) for w in x.keys() | y.keys())
    return sum(min(x[w], y[w]) for w in x.keys() | y.keys()) / most if most else 1.0


def sha(data: bytes) -> str:
    return hashlib.sha256(data).hexdigest()
