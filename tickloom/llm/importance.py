"""Importance resampling towards a target distribution.

Every word run of a text falls into a hashed bucket. What a bucket is worth is
the log ratio of its share in the target to its share in the corpus, kept as an
array of one number per bucket; a document's weight is the mean of the array's
entries at its buckets. Adding a random number of the right distribution turns
"the highest scores" into a draw without replacement.

The highest scores are found without sorting the corpus: scores are persisted,
and the cutoff is closed in on by exact count jobs over them, first on the score,
then, among rows of the cutoff score, on ``doc_id``, then on the persisted row
number. Only selected rows are sorted, by ranges, for their ranks.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickloom.llm.arrow import column, packed
from tickloom.llm.runs import portions, word_bytes
from tickloom.llm.tables import partitions, written

BUCKETS = 10_000
LONGEST = 1
SEED = 2024
LEAST_WORDS = 20
PERCENT = 10
# One count job counts above this many thresholds, which halves the interval four times.
PROBES = 15

WORD_BYTES = word_bytes((ord("0"), ord("9")), (ord("A"), ord("Z")), (ord("a"), ord("z")), (0x80, 0xFF))


def feature_buckets(data: np.ndarray, offsets: np.ndarray, buckets: int, longest: int) -> Iterator[tuple[np.ndarray, np.ndarray, int]]:
    """``(buckets, texts, words)`` of features, portion by portion: each feature's bucket and its text, and
    how many of the entries stand for single words (they come first).

    A feature of several words has the checksum of its words joined by one space;
    it is carried on from the checksum of the words before the last. Portions of a text
    overlap by the words that a run may reach back.
    """
    tail: list[tuple[int, bytes]] = []  # the last words of the portion before, with their text
    for words, index, owner in portions(data, offsets, WORD_BYTES[data]):
        different = words.to_pylist()
        singles = np.fromiter(map(zlib.crc32, different), np.uint32, len(different))[index]
        found, owners = [singles % np.uint32(buckets)], [owner]
        if longest > 1:
            line = [*tail, *((int(o), different[i]) for o, i in zip(owner, index, strict=True))]
            sums = [zlib.crc32(word) for _, word in line]
            for n in range(1, longest):  # runs of n + 1 words, by their last word
                ends = range(max(n, len(tail)), len(line))
                places = [i for i in ends if line[i - n][0] == line[i][0]]
                # sums[i - 1] is the checksum of the n words that end at i - 1.
                runs = {i: zlib.crc32(b" " + line[i][1], sums[i - 1]) for i in range(n, len(line)) if line[i - n][0] == line[i][0]}
                found.append(np.asarray([runs[i] % buckets for i in places], np.uint32))
                owners.append(np.asarray([line[i][0] for i in places], np.int64))
                sums = [runs.get(i, 0) for i in range(len(line))]
            tail = line[-(longest - 1) :]
        yield np.concatenate(found), np.concatenate(owners), len(singles)


def bucket_counts(texts: DataFrame, buckets: int = BUCKETS, longest: int = LONGEST) -> DataFrame:
    """``bucket, n``: the features of all texts; a task sends one row per bucket."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(buckets, np.int64)
        for batch in batches:
            for found, _, _ in feature_buckets(*packed(column(batch, "text")), buckets, longest):
                total += np.bincount(found, minlength=buckets)
        held = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(held), pa.array(total[held])], ["bucket", "n"])

    return texts.select("text").mapInArrow(run, "bucket bigint, n bigint").groupBy("bucket").agg(F.sum("n").alias("n"))


def counted(texts: DataFrame, buckets: int = BUCKETS, longest: int = LONGEST) -> list[int]:
    """Counts by bucket: as many numbers as there are buckets, whatever the input."""
    out = [0] * buckets
    for row in bucket_counts(texts, buckets, longest).collect():
        out[row.bucket] = row.n
    return out


def gains(corpus: list[int], target: list[int]) -> np.ndarray:
    """``floor(1000 ln((t + 1)(S + B) / ((s + 1)(T + B))))`` per bucket, in doubles."""
    whole, wanted, buckets = float(sum(corpus)), float(sum(target)), len(corpus)
    ratios = (((t + 1.0) * (whole + buckets)) / ((s + 1.0) * (wanted + buckets)) for s, t in zip(corpus, target, strict=True))
    return np.asarray([math.floor(1000 * math.log(ratio)) for ratio in ratios], np.int64)


def weighted(docs: DataFrame, worth: np.ndarray, longest: int = LONGEST) -> DataFrame:
    """``doc_id, n_features, n_words, weight`` per row: the floored mean of the array's entries at a text's buckets."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n = batch.num_rows
            features, words, total = np.zeros(n, np.int64), np.zeros(n, np.int64), np.zeros(n, np.int64)
            for found, owner, singles in feature_buckets(*packed(column(batch, "text")), len(worth), longest):
                features += np.bincount(owner, minlength=n)
                words += np.bincount(owner[:singles], minlength=n)
                first = int(owner.min())
                sums = np.zeros(int(owner.max()) + 1 - first, np.int64)
                np.add.at(sums, owner - first, worth[found])
                total[first : first + len(sums)] += sums
            mean = np.floor_divide(total, np.maximum(features, 1))
            yield pa.RecordBatch.from_arrays(
                [column(batch, "doc_id"), pa.array(features), pa.array(words), pa.array(mean)],
                ["doc_id", "n_features", "n_words", "weight"],
            )

    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    return rows.mapInArrow(run, "doc_id bigint, n_features bigint, n_words bigint, weight bigint")


def with_scores(rows: DataFrame, seed: int = SEED) -> DataFrame:
    """Adds ``score``: the weight plus a Gumbel number that the seed and ``doc_id`` decide, in thousandths."""
    key = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit("null"))), 256)
    h = F.conv(F.substring(key, 1, 8), 16, 10).cast("double")
    noise = F.floor(-1000 * F.ln(-F.ln((h + 0.5) / F.lit(4294967296.0))))
    return rows.withColumn("score", (F.col("weight") + noise).cast("bigint"))


def highest_that_keeps(low: int, high: int, least: int, counts: Callable[[list[int]], list[int]]) -> int:
    """The largest ``x`` in ``[low, high]`` of which ``count(>= x)`` is ``least`` or more.

    ``counts`` answers for several thresholds by one job; ``count(>= low)`` is known to suffice.
    """
    while low < high:
        probes = sorted({low + (high - low) * i // (PROBES + 1) + 1 for i in range(PROBES + 1)})
        held = counts(probes)
        enough = [x for x, n in zip(probes, held, strict=True) if n >= least]
        short = [x for x, n in zip(probes, held, strict=True) if n < least]
        low, high = max(enough, default=low), min(short, default=high + 1) - 1
    return low


def _cutoff(rows: DataFrame, value: Column, want: int) -> int:
    """The largest ``x`` that at least ``want`` of the rows reach with ``value``."""
    ends = rows.agg(F.min(value).alias("low"), F.max(value).alias("high")).first()

    def counts(probes: list[int]) -> list[int]:
        return list(rows.agg(*[F.count_if(value >= x).alias(f"n{i}") for i, x in enumerate(probes)]).first())

    return highest_that_keeps(ends.low, ends.high, want, counts)


def drawn(scored: DataFrame, want: int) -> Column:
    """The condition that holds for the ``want`` first rows by score (high to low), ``doc_id`` (low to high, null last) and row.

    Every step narrows down to the rows that tie at the cutoff so far and counts among them.
    """
    # Larger is better in each; a null id is behind all ids.
    order = [F.col("score"), F.coalesce(-F.col("doc_id"), F.lit(-(2**63))), -F.col("_row")]
    chosen, tied = F.lit(False), F.col("_eligible")
    for value in order:
        x = _cutoff(scored.where(tied), value, want)
        above = tied & (value > x)
        want -= scored.where(above).count()
        chosen, tied = chosen | above, tied & (value == x)
    return chosen | tied  # the row number is unique: one row is left


def ranked(rows: DataFrame) -> DataFrame:
    """Adds ``rank`` (from 1) by score, ``doc_id`` and row: a range partition's place is its start plus the place inside."""
    order = [F.col("score").desc(), F.col("doc_id").asc_nulls_last(), F.col("_row")]
    ranges = rows.repartitionByRange(partitions(rows.sparkSession), *order).sortWithinPartitions(*order)
    # The number that Spark gives holds the partition in its upper bits and the place in its lower 33.
    placed = written(ranges.withColumn("_at", F.monotonically_increasing_id()), "ranked")
    part, place = F.shiftright("_at", 33), F.col("_at").bitwiseAND((1 << 33) - 1)
    sizes = {row.part: row["count"] for row in placed.groupBy(part.alias("part")).count().collect()}  # one row per partition
    before, starts = 0, []
    for number in range(max(sizes, default=-1) + 1):
        starts.append(before)
        before += sizes.get(number, 0)
    start = F.get(F.array(*map(F.lit, starts)), part.cast("int")) if starts else F.lit(0)
    return placed.withColumn("rank", (start + place + 1).cast("bigint"))


def resample(
    docs: DataFrame,
    target: DataFrame,
    percent: int = PERCENT,
    least_words: int = LEAST_WORDS,
    buckets: int = BUCKETS,
    longest: int = LONGEST,
    seed: int = SEED,
) -> DataFrame:
    """One row per document: ``doc_id, n_features, weight, score, rank`` (null if it is not drawn).

    ``percent`` of the documents with at least ``least_words`` words are drawn, those
    with the highest scores, ties to the smaller ``doc_id``.

    Defined cases: null and empty texts have no features and weight 0; a null
    ``doc_id`` is keyed like the text "null" and comes last among equal scores;
    rows of one ``doc_id`` are documents of their own, and rows that tie in all are
    ranked by their place in the persisted table; further columns are ignored; an empty
    target leaves all buckets their smoothing; an empty table gives an empty result.
    """
    worth = gains(counted(docs, buckets, longest), counted(target, buckets, longest))
    eligible = F.col("n_words") >= least_words
    scored = written(
        with_scores(weighted(docs, worth, longest), seed).select(
            "doc_id", "n_features", "weight", "score", eligible.alias("_eligible"), F.monotonically_increasing_id().alias("_row")
        ),
        "scored",
    )
    want = percent * scored.where("_eligible").count() // 100
    columns = ["doc_id", "n_features", "weight", "score"]
    if not want:
        return scored.select(*columns, F.lit(None).cast("bigint").alias("rank"))
    chosen = drawn(scored, want)
    first = ranked(scored.where(chosen)).select(*columns, "rank")
    rest = scored.where(~chosen).select(*columns, F.lit(None).cast("bigint").alias("rank"))
    return first.unionByName(rest)
