"""Document fingerprints by consistent weighted sampling.

A text's terms are its lower-case words, weighted by how often they occur. For
every sample each term has two gamma-distributed numbers and a uniform one that
depend on the term alone; from them and the weight follows a value, and the
sample keeps the smallest. Two texts keep the same value with a probability equal
to their generalised Jaccard similarity, the sum of the smaller weights over the
sum of the larger ones. The share of equal samples estimates it.

What is kept of a sample names the winning term and its rounded weight, not the
value, whose last bits may differ between processors.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickloom.llm.arrow import column
from tickloom.llm.tables import partitions
from tickloom.llm.words import mix, words

SAMPLES = 64
# Bytes of text hashed together, and terms sampled together.
CHUNK_BYTES = 1 << 20
CHUNK_TERMS = 1 << 13
# (Term, weight) pairs whose samples a worker remembers: 0.5 KB each, the pairs of frequent words above all.
KNOWN_KINDS = 120_000
_SALTS = mix(np.arange(1, 6 * SAMPLES + 1, dtype=np.uint64)).reshape(6, SAMPLES)
_ODD = np.uint64(0x9E3779B97F4A7C15)


def _log_uniform(terms: np.ndarray, salts: np.ndarray) -> np.ndarray:
    bits = mix(terms[:, None] ^ salts[None, :]) >> np.uint64(41)
    return np.log((bits.astype(np.float32) + np.float32(0.5)) * np.float32(2.0**-23))


def samples(terms: np.ndarray, weights: np.ndarray) -> np.ndarray:
    """What each (term, weight) offers to each sample, a row per term; the smallest number wins.

    The upper half of a number has the order of the value's logarithm, the lower half is a hash of the
    term and its rounded weight. A gamma number of shape 2 is minus the logarithm of a product of two uniform ones.
    """
    r = -(_log_uniform(terms, _SALTS[0]) + _log_uniform(terms, _SALTS[1]))
    c = np.log(-(_log_uniform(terms, _SALTS[2]) + _log_uniform(terms, _SALTS[3])))
    beta = (mix(terms[:, None] ^ _SALTS[4]) >> np.uint64(40)).astype(np.float32) * np.float32(2.0**-24)
    t = np.floor(np.log(weights.astype(np.float32))[:, None] / r + beta)
    value = (c - r * (t - beta) - r).view(np.uint32)
    # The bits of floats in their order: negative ones reversed, positive ones behind them.
    ordered = np.where(value >> np.uint32(31), ~value, value | np.uint32(1 << 31)).astype(np.uint64)
    name = mix((terms[:, None] ^ _SALTS[5]) + t.astype(np.int64).astype(np.uint64) * _ODD) >> np.uint64(32)
    return (ordered << np.uint64(32)) | name


class Sampler:
    """``samples`` with a memory of the pairs met before."""

    def __init__(self) -> None:
        self.names, self.values = np.zeros(0, np.uint64), np.zeros((0, SAMPLES), np.uint64)

    def __call__(self, terms: np.ndarray, weights: np.ndarray) -> np.ndarray:
        # Two pairs of one name would share samples; with 64 bits that does not happen in practice.
        names = mix(terms ^ mix(weights.astype(np.uint64)))
        out = np.empty((len(terms), SAMPLES), np.uint64)
        at = np.minimum(np.searchsorted(self.names, names), max(len(self.names) - 1, 0))
        known = self.names[at] == names if len(self.names) else np.zeros(len(names), bool)
        out[known] = self.values[at[known]]
        fresh = np.flatnonzero(~known)
        for a in range(0, len(fresh), CHUNK_TERMS):
            some = fresh[a : a + CHUNK_TERMS]
            out[some] = samples(terms[some], weights[some])
        self._keep(names, out, fresh)
        return out

    def _keep(self, names: np.ndarray, values: np.ndarray, fresh: np.ndarray) -> None:
        """Remember new pairs while there is room; when it is used up, only what this call needed stays."""
        if len(self.names) + len(fresh) <= KNOWN_KINDS:
            names, values = np.concatenate([self.names, names[fresh]]), np.concatenate([self.values, values[fresh]])
        elif len(names) > KNOWN_KINDS:
            names, values = names[:KNOWN_KINDS], values[:KNOWN_KINDS]
        order = np.argsort(names)
        self.names, self.values = names[order], values[order]


def fingerprints(data: np.ndarray, offsets: np.ndarray, sampled=samples) -> np.ndarray:
    """16 bits per sample and text, 0 only for texts without words."""
    n = len(offsets) - 1
    found = words(data, offsets)
    out = np.zeros((n, SAMPLES), np.uint16)
    filled = np.flatnonzero(found.counts)
    if not len(filled):
        return out
    # Distinct words get dense numbers, so that (text, word) sorts as one number.
    vocabulary, number = np.unique(found.hashes, return_inverse=True)
    text = np.repeat(np.arange(n, dtype=np.int64), found.counts)
    pairs, weights = np.unique(text * len(vocabulary) + number, return_counts=True)
    text, number = np.divmod(pairs, len(vocabulary))
    # A (term, weight) is sampled once for all texts that hold it.
    kinds, kind = np.unique(number * (int(weights.max()) + 1) + weights, return_inverse=True)
    term, weight = np.divmod(kinds, int(weights.max()) + 1)
    values = sampled(vocabulary[term], weight)
    starts = np.searchsorted(text, filled)
    ends = np.append(starts[1:], len(text))
    least = np.empty((len(filled), SAMPLES), np.uint64)
    first = 0
    while first < len(filled):
        last = max(first + 1, int(np.searchsorted(ends, starts[first] + 4 * CHUNK_TERMS, "right")))
        part = slice(starts[first], ends[last - 1])
        least[first:last] = np.minimum.reduceat(values[kind[part]], starts[first:last] - starts[first], axis=0)
        first = last
    bits = (least >> np.uint64(16)) & np.uint64(0xFFFF)
    out[filled] = np.maximum(bits, np.uint64(1)).astype(np.uint16)
    return out


def _hex(row: np.ndarray) -> str:
    return row.astype(">u2").tobytes().hex()


def likeness(a: np.ndarray, b: np.ndarray) -> float:
    """Share of equal samples; 1 for two texts without words, 0 if only one has none."""
    return float(np.count_nonzero(a == b)) / SAMPLES


def edited(text: str, following: str) -> str:
    """The last quarter of the characters replaced by as many of the next text's first ones."""
    n = len(text) // 4
    return text[: len(text) - n] + following[:n]


def _print_all(some: list[str], sampled) -> np.ndarray:
    encoded = [text.encode("utf-8", "replace") for text in some]
    out, first = [], 0
    while first < len(encoded):
        last, size = first, 0
        while last < len(encoded) and (last == first or size + len(encoded[last]) <= CHUNK_BYTES):
            size += len(encoded[last])
            last += 1
        part = encoded[first:last]
        out.append(fingerprints(np.frombuffer(b"".join(part), np.uint8), np.cumsum([0, *map(len, part)]), sampled))
        first = last
    return np.concatenate(out)


def _by_bucket(docs: DataFrame) -> DataFrame:
    """Rows ``doc_id, text, bucket, tail``, each bucket a range of ``doc_id`` in order.

    There are as many buckets as shuffle partitions. The first row of a bucket is
    sent to the bucket before it as well (the very first one to the last bucket),
    as the row ``tail`` that follows all others. What the driver holds is one
    number per bucket.
    """
    n = partitions(docs.sparkSession)
    least = -(2**63)
    place = F.coalesce(F.col("doc_id").cast("bigint"), F.lit(least))
    rows = docs.select("doc_id", F.coalesce("text", F.lit("")).cast("binary").alias("text"), place.alias("place"))
    cuts = rows.approxQuantile("place", [i / n for i in range(1, n)], 0.1 / n) if n > 1 else []
    bounds = np.unique(np.asarray(cuts, np.float64)).astype(np.int64)

    @F.pandas_udf("int")
    def bucket(places: pd.Series) -> pd.Series:
        return pd.Series(np.searchsorted(bounds, places.to_numpy(), "right").astype(np.int32))

    heads = rows.select("place", bucket("place").alias("bucket")).groupBy("bucket").agg(F.min("place").alias("head"))
    order = sorted((r.bucket, r.head) for r in heads.collect())
    before = {head: order[i - 1][0] for i, (_, head) in enumerate(order)}

    @F.pandas_udf("array<int>")
    def targets(places: pd.Series) -> pd.Series:
        buckets = np.searchsorted(bounds, places.to_numpy(), "right")
        return pd.Series([[int(b), before[p]] if p in before else [int(b)] for p, b in zip(places, buckets, strict=True)])

    sent = rows.select("doc_id", "text", "place", F.posexplode(targets("place")).alias("tail", "bucket"))
    return (
        sent.withColumn("tail", F.col("tail") > 0)
        .repartition(n, "bucket")
        .sortWithinPartitions("bucket", "tail", "place", "text")
        .drop("place")
    )


def compare_with_edits(docs: DataFrame) -> DataFrame:
    """Fingerprints of every text and of its edited form, and how like they are.

    Returns ``doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint,
    near_edited, near_next``. The next document is the one of the next higher
    ``doc_id``, after the last the first; a text is shuffled once.

    Defined cases: a null text is empty, and its fingerprint is all zeros, which
    no text with words has; two empty fingerprints have likeness 1, an empty one
    and another 0; a null ``doc_id`` comes before all others; rows of one
    ``doc_id`` follow each other in order of their texts; a single document is
    its own next one; further columns are ignored.
    """
    kind = docs.schema["doc_id"].dataType

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sampled = Sampler()
        waiting: list[tuple] = []  # the last row, whose next one has not come yet
        for whole in batches:
            for at in range(0, whole.num_rows, 256):
                batch = whole.slice(at, 256)
                rows = [value.decode("utf-8", "replace") for value in column(batch, "text").to_pylist()]
                cells = [column(batch, c).to_pylist() for c in ("bucket", "tail")]
                follows = list(zip([w[1] for w in waiting] + rows[: len(rows) - 1], rows, strict=False)) if waiting else list(zip(rows[:-1], rows[1:], strict=True))
                # A text and its edited form stand next to each other: most of their terms are the same.
                together: list[str] = [] if waiting else [rows[0]]
                for before, text in follows:
                    together += [edited(before, text), text]
                marks = _print_all(together, sampled)
                own, other = (marks[1::2], marks[0::2]) if waiting else (marks[0::2], marks[1::2])
                line = waiting + list(zip(column(batch, "doc_id").to_pylist(), rows, own, *cells, strict=True))
                waiting = [line[-1]]
                held = [i for i, (a, b) in enumerate(zip(line[:-1], line[1:], strict=True)) if not a[4] and a[3] == b[3]]
                if not held:
                    continue
                pairs = [(line[i], line[i + 1]) for i in held]
                changed, after = [edited(a[1], b[1]) for a, b in pairs], other[held]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([a[0] for a, _ in pairs], batch.schema.field("doc_id").type),
                        pa.array([len(a[1]) for a, _ in pairs], pa.int64()),
                        pa.array([hashlib.sha256(text.encode("utf-8", "replace")).hexdigest() for text in changed], pa.string()),
                        pa.array([_hex(a[2]) for a, _ in pairs], pa.string()),
                        pa.array([_hex(mark) for mark in after], pa.string()),
                        pa.array([likeness(a[2], mark) for (a, _), mark in zip(pairs, after, strict=True)], pa.float64()),
                        pa.array([likeness(a[2], b[2]) for a, b in pairs], pa.float64()),
                    ],
                    ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"],
                )

    return _by_bucket(docs).mapInArrow(
        run,
        f"doc_id {kind.simpleString()}, n_chars bigint, edited_sha256 string, fingerprint string, "
        "edited_fingerprint string, near_edited double, near_next double",
    )
