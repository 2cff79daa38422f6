"""Exact top-k search by inner product without random access (NRA).

A block of vectors holds one sorted list per component: pairs of a vector and its
value. A query reads all lists in parallel, entry by entry, from the end that its
component's sign prefers, and adds up what it reads per vector. At any depth each vector has a
*lower* bound (what was read of it, and the worst end of a list for what was not)
and an *upper* bound (what was read, and the value the list has come to for what
was not). A query stops when no vector outside its candidates can reach the k-th
best lower bound; only the candidates' scores are then resolved.

Depths grow by a factor, so a query that can stop early reads a small part of the
lists, and one that cannot reads each entry once.

Blocks of queries meet blocks of vectors by a join on the pair of block numbers;
every pair is a task of fixed size, and only k rows per query leave it.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tickloom.llm.arrow import column
from tickloom.llm.tables import partitions

K = 5
VECTOR_BLOCK = 8192
QUERY_BLOCK = 512
# Vectors whose lists are read at a time, and queries that read them together.
LIST_LENGTH = 2048
TOGETHER = 32
# Shares of a list that have been read after each round.
DEPTHS = (1 / 32, 1 / 8, 1 / 4, 1 / 2, 1.0)
# A query stops reading when it has this many candidates for each result wanted.
FEW = 8
LONG = (-(2**63), 2**63 - 1)


def _matrix(values: list[list[int]], width: int) -> np.ndarray:
    """Rows padded with zeros to one width, in the narrowest numbers that hold all sums exactly: floats, doubles or Python integers."""
    top = max((abs(v) for row in values for v in row), default=0)
    bound = 4 * top * top * max(width, 1)  # of what the bounds of scores add up
    out = np.zeros((len(values), width), np.float32 if bound < 2**24 else np.float64 if bound < 2**53 else object)
    for i, row in enumerate(values):
        out[i, : len(row)] = row
    return out


def _best(scores: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    """Places of the k highest scores, ties to the smaller id."""
    if len(scores) > k and scores.dtype != object:
        least = np.partition(scores, len(scores) - k)[len(scores) - k]
        places = np.flatnonzero(scores >= least)
    else:
        places = np.arange(len(scores))
    return np.asarray(sorted(places, key=lambda i: (-scores[i], ids[i]))[:k], np.int64)


class Lists:
    """The sorted lists of a block: per component the vectors in order of their values."""

    def __init__(self, vectors: np.ndarray):
        self.vectors = vectors
        self.order = np.argsort(vectors, axis=0, kind="stable").T.copy()  # a list per row, ascending
        self.values = np.take_along_axis(vectors.T, self.order, axis=1)

    def read(self, component: int, down: bool, first: int, last: int) -> tuple[np.ndarray, np.ndarray]:
        """The entries at places ``first`` to ``last``, from the upper end or from the lower one."""
        n = self.order.shape[1]
        part = slice(n - last, n - first) if down else slice(first, last)
        return self.order[component, part], self.values[component, part]


def read_lists(queries: np.ndarray, lists: Lists, own: np.ndarray, k: int, least: np.ndarray) -> list[np.ndarray]:
    """Candidates of each query: places that hold its best vectors, found by reading the lists as deep as needed.

    ``own`` is a query's own place, or -1; ``least`` the score that its k-th best
    vector of other lists has. Queries read together, each in its own direction: an entry
    that was read is added to a row of sums, which has a column for each query
    that has not stopped.
    """
    n = len(lists.vectors)
    down, up = np.maximum(queries, 0).T.copy(), np.minimum(queries, 0).T.copy()  # a positive weight prefers large values
    low, high = lists.values[:, 0], lists.values[:, -1]
    worst = low @ down + high @ up  # what the lists' worst ends would give
    read = np.zeros((n, len(queries)), queries.dtype)  # per vector: what was read of it, above the worst ends
    unread_down, unread_up = np.ones_like(lists.vectors), np.ones_like(lists.vectors)
    found = [np.zeros(0, np.int64)] * len(queries)
    left = np.arange(len(queries))  # the queries that have not stopped
    depth = 0
    for share in DEPTHS:
        until = min(n, max(depth + 1, int(n * share)))
        for component in range(len(lists.order)):
            # A list holds each vector once, so no place is added to twice here.
            places, values = lists.read(component, True, depth, until)
            read[places] += np.multiply.outer(values - low[component], down[component])
            unread_down[places, component] = 0
            places, values = lists.read(component, False, depth, until)
            read[places] += np.multiply.outer(values - high[component], up[component])
            unread_up[places, component] = 0
        depth = until
        lower = read + worst
        upper = lower
        if depth < n:
            reached_down, reached_up = lists.values[:, n - depth] - low, lists.values[:, depth - 1] - high
            upper = lower + unread_down @ (down * reached_down[:, None]) + unread_up @ (up * reached_up[:, None])
        mine = np.flatnonzero(own >= 0)
        lower[own[mine], mine] = upper[own[mine], mine] = -np.inf
        kth = np.maximum(np.partition(lower, n - k, axis=0)[n - k], least) if n > k else least
        # An upper bound that equals the k-th lower bound may still tie with a smaller id.
        held = upper >= kth
        # At the lists' ends what was read is the score.
        stops = (held.sum(axis=0) <= FEW * k) | (depth == n)
        for i in np.flatnonzero(stops):
            found[left[i]] = np.flatnonzero(held[:, i])
        if stops.all():
            break
        if stops.any():
            go = ~stops
            read, down, up, worst, own, least, left = read[:, go], down[:, go], up[:, go], worst[go], own[go], least[go], left[go]
    return found


def search(queries: np.ndarray, query_ids: np.ndarray, vectors: np.ndarray, ids: np.ndarray, k: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """Per query its place, and the places and scores of its k best vectors of this block.

    The block's vectors are taken list by list; the k-th best score so far lets
    the queries stop earlier in the next lists.
    """
    best = [(np.zeros(0, np.int64), np.zeros(0, vectors.dtype))] * len(queries)
    least = np.full(len(queries), -np.inf, vectors.dtype)
    for begin in range(0, len(vectors), LIST_LENGTH):
        lists = Lists(vectors[begin : begin + LIST_LENGTH])
        place_of = {int(v): i for i, v in enumerate(ids[begin : begin + LIST_LENGTH])}
        own = np.array([place_of.get(int(q), -1) for q in query_ids], np.int64)
        for first in range(0, len(queries), TOGETHER):
            some = slice(first, first + TOGETHER)
            for i, held in enumerate(read_lists(queries[some], lists, own[some], k, least[some]), first):
                held = held[held != own[i]]
                places = np.concatenate([best[i][0], begin + held])
                scores = np.concatenate([best[i][1], lists.vectors[held] @ queries[i]])
                top = _best(scores, ids[places], k)
                best[i] = (places[top], scores[top])
                if len(top) == k:
                    least[i] = scores[top[-1]]
    for i, (places, scores) in enumerate(best):
        yield i, places, scores


def _pairs(rows: DataFrame, k: int) -> DataFrame:
    """The k best of every (query block, vector block); rows come sorted by pair."""

    def solve(part: list[pa.RecordBatch]) -> pa.RecordBatch:
        table = pa.Table.from_batches(part)
        ids = table.column("vec_id").to_numpy()
        asks = table.column("asks").to_numpy(zero_copy_only=False).astype(bool)
        values = table.column("v").to_pylist()
        matrix = _matrix(values, max(map(len, values)))
        out: tuple[list, list, list] = ([], [], [])
        if asks.any() and not asks.all():
            queries, vectors = matrix[asks], matrix[~asks]
            if matrix.dtype == object:
                found = ((q, p, s) for q in range(len(queries)) for p, s in [_plain(queries[q], ids[asks][q], vectors, ids[~asks], k)])
            else:
                found = search(queries, ids[asks], vectors, ids[~asks], k)
            for query, places, scores in found:
                out[0].extend([int(ids[asks][query])] * len(places))
                out[1].extend(ids[~asks][places].tolist())
                out[2].extend(min(max(int(s), LONG[0]), LONG[1]) for s in scores)
        return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in out], ["query_id", "vec_id", "score"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        key = None
        for batch in batches:
            pairs = np.stack([column(batch, "q").to_numpy(), column(batch, "b").to_numpy()], 1)
            breaks = [0, *(np.flatnonzero((pairs[1:] != pairs[:-1]).any(1)) + 1).tolist(), len(pairs)]
            for first, last in zip(breaks[:-1], breaks[1:], strict=True):
                if last > first:
                    if held and key != tuple(pairs[first]):
                        yield solve(held)
                        held = []
                    key = tuple(pairs[first])
                    held.append(batch.slice(first, last - first))
        if held:
            yield solve(held)

    return rows.mapInArrow(run, "query_id bigint, vec_id bigint, score bigint")


def _plain(query: np.ndarray, query_id: int, vectors: np.ndarray, ids: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Scores in Python integers, for components too large for the bounds to be exact in doubles."""
    others = np.flatnonzero(ids != query_id)
    scores = np.asarray([sum(a * b for a, b in zip(map(int, query), map(int, vectors[i]), strict=True)) for i in others], object)
    first = _best(scores, ids[others], k)
    return others[first], scores[first]


def top_k(vectors: DataFrame, every: int = 50, k: int = K) -> DataFrame:
    """``query_id, rank, vec_id, score``: the k best partners of each vector whose id is divisible by ``every``.

    Components are ``floor(256 * x)`` of the double ``x``; the score is their
    integer inner product.

    Defined cases: vectors that are null, or hold null or non-finite components,
    and rows without ``vec_id`` take no part; rows of one ``vec_id`` are one vector
    (the smallest array); of vectors of different lengths the shorter counts as
    filled up with zeros, and an empty one scores 0 with all; components beyond
    2**62 stop there, scores beyond a long stop at its limits; fewer than k partners give
    fewer rows; further columns are ignored.
    """
    usable = vectors.where(
        "vec_id is not null and embedding is not null and forall(embedding, x -> x is not null and not isnan(x) and abs(x) < double('infinity'))"
    )
    whole = (
        usable.select(F.col("vec_id").cast("bigint").alias("vec_id"), F.transform("embedding", lambda x: x.cast("double")).alias("v"))
        .groupBy("vec_id")
        .agg(F.min("v").alias("v"))
        .select("vec_id", F.expr("transform(v, x -> cast(floor(least(greatest(256 * x, -4.611686018427388e18D), 4.611686018427388e18D)) as bigint))").alias("v"))
    )
    sizes = whole.agg(F.count("*").alias("n"), F.count_if(F.col("vec_id") % every == 0).alias("q")).first()
    blocks, asking = -(-sizes.n // VECTOR_BLOCK) or 1, -(-sizes.q // QUERY_BLOCK) or 1
    block = F.pmod(F.xxhash64("vec_id"), F.lit(blocks))
    group = F.pmod(F.xxhash64(F.lit(1), "vec_id"), F.lit(asking))
    # A vector goes to every block of queries, a query to every block of vectors.
    offered = whole.select("vec_id", "v", block.alias("b"), F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(asking - 1).cast("bigint"))).alias("q"), F.lit(False).alias("asks"))
    asked = whole.where(F.col("vec_id") % every == 0).select("vec_id", "v", F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(blocks - 1).cast("bigint"))).alias("b"), group.alias("q"), F.lit(True).alias("asks"))
    # A task works pair by pair, so there need not be one for each.
    tasks = min(blocks * asking, 8 * partitions(vectors.sparkSession))
    paired = offered.unionByName(asked).repartition(tasks, "q", "b").sortWithinPartitions("q", "b")
    local = _pairs(paired, k)
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return local.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
