"""The query on languages once more, text by text in plain Python."""

from __future__ import annotations

import itertools
import math
import re
from collections import Counter, defaultdict

GRAMS, HASH = 1 << 14, 2654435761
SMOOTHING, WEIGHT, MOST, NONE, ANY, HOST, VALUE = 0.5, 0.3, 400, 0.01, 0.02, 20, 5
SYMBOLS = [32, *range(ord("a"), ord("z") + 1), *range(0x80, 0x100)]
MARKUP = re.compile(r"<(script|style)\b[^>]*>.*?</\1\s*>|<!--.*?-->|<[^>]*>|&#?[a-z0-9]+;", re.I | re.S)


def folded(text: str) -> bytes:
    return bytes(b + 32 if 65 <= b <= 90 else b if b in SET else 32 for b in text.encode())


SET = set(SYMBOLS)


def place(x: int, y: int, z: int) -> int | None:
    """The slot of a trigram; one with two spaces in a row has none."""
    if x == y == 32 or y == z == 32:
        return None
    return (((x << 16 | y << 8 | z) * HASH) % 2**32) >> 18


def grams(text: str) -> list[int]:
    data = folded(text)
    return [p for i in range(len(data) - 2) if (p := place(*data[i : i + 3])) is not None]


def background(letters: Counter) -> list[float]:
    total = sum(letters.values())
    share = {s: (1 - ANY) * letters[s] / total + ANY / len(SYMBOLS) if total else 1 / len(SYMBOLS) for s in SYMBOLS}
    out = [0.0] * GRAMS
    for x, y, z in itertools.product(SYMBOLS, repeat=3):
        if (p := place(x, y, z)) is not None:
            out[p] += share[x] * share[y] * share[z]
    whole = sum(out)
    return [value / whole for value in out]


def normal(logs: list[float]) -> list[float]:
    powers = [math.exp(x - max(logs)) for x in logs]
    return [x / sum(powers) for x in powers]


def document(doc_id, text, source) -> dict:
    return {"key": ("doc", doc_id), "text": text or "", "host": source, "declared": None, "suffix": None, "domain": None}


def page(page_id, url, html) -> dict:
    found = re.search(r"^[a-zA-Z][a-zA-Z0-9+.-]*://(?:[^/?#@]*@)?([^/:?#]+)", url or "")
    host = found.group(1).lower() if found else None
    suffix, domain = (re.search(p, host or "") for p in (r"\.([a-z]+)$", r"([^.]+\.[^.]+)$"))
    declared = re.search(r"<html\b[^>]*?\blang\s*=\s*[\"']?([a-z]{2,3})\b", html or "", re.I)
    return {
        "key": ("page", page_id), "text": MARKUP.sub(" ", html or ""), "host": host,
        "declared": declared.group(1).lower() if declared else None,
        "suffix": suffix and suffix.group(1), "domain": domain and domain.group(1),
    }


def identified(rows: list[dict], labelled: list[tuple[str, str]]) -> dict:
    """Per row its language, posterior and whether it is accepted."""
    labels = sorted({label for text, label in labelled if text is not None and label is not None})
    counts: dict[str, Counter] = defaultdict(Counter)
    letters: Counter = Counter()
    for text, label in labelled:
        if text is not None and label is not None:
            letters.update(folded(text))
            counts[label].update(grams(text))
    plain = background(letters)
    tables = []
    for label in labels:
        total = sum(counts[label].values()) + SMOOTHING * GRAMS
        tables.append([math.log((counts[label][g] + SMOOTHING * GRAMS * plain[g]) / total) for g in range(GRAMS)])
    tables.append([math.log(x) for x in plain])
    for row in rows:
        found = grams(row["text"])
        scale = WEIGHT * min(len(found), MOST) / max(len(found), 1)
        row["n"], row["logs"] = len(found), [scale * sum(table[g] for g in found) for table in tables]
        row["logs"][-1] += math.log(NONE)
        row["own"] = normal(row["logs"])
    size = len(tables)
    overall = [1 + sum(row["own"][i] for row in rows) for i in range(size)]
    base = [x / sum(overall) for x in overall]
    sums: dict = {}
    for key in ("declared", "suffix", "domain", "host"):
        for row in rows:
            if row[key] is not None:
                held = sums.setdefault((key, row[key]), [0.0] * size)
                for i in range(size):
                    held[i] += row["own"][i]

    def alone(row, key):
        held = sums.get((key, row[key]))
        return held and [max(n - x, 0) for n, x in zip(held, row["own"])]

    def level(row, key, parent):
        held = alone(row, key)
        return [(n + HOST * p) / (sum(held) + HOST) for n, p in zip(held, parent)] if held else parent

    def value(row, key):
        held = alone(row, key)
        return [math.log((n + VALUE * w / sum(overall)) / w) for n, w in zip(held, overall)] if held else [0.0] * size

    out = {}
    for row in rows:
        prior = level(row, "host", level(row, "domain", base))
        logs = [a + math.log(p) + b + c for a, p, b, c in zip(row["logs"], prior, value(row, "declared"), value(row, "suffix"))]
        posteriors = normal(logs)[:-1]
        best = max(posteriors)
        out[row["key"]] = (labels[posteriors.index(best)], best, row["n"] > 0 and best >= 0.5)
    return out
