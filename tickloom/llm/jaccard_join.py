"""Exact n-gram Jaccard join: keys by the pigeonhole, then verification of what they bring together.

1. Every text becomes its set of shingles; texts of one set are a *class*, whose
   smallest document stands for it.
2. Tasks ship the sets' keys (``set_keys``), packed per bucket of keys. A bucket
   finds the keys of more than one document: *meetings*.
3. A meeting becomes links between documents that may be similar: sketches rule
   out pairs that cannot be, and a spanning forest of the rest is kept, as only
   what is connected matters for step 4. Connected documents are a *cluster*.
4. Each cluster's sets come together and are compared exactly. Pairs that are in
   one component already are passed over. Clusters beyond a block's size are
   dealt into blocks, and every pair of blocks is a task of its own.
5. The components of the exact links are the result.

A key that very many documents share is thinned out where it arises: within a
chunk of a task its documents are linked to the first one without a check, and
only that one is shipped, marked: what it meets under the key is linked without a
check too, as it may be similar to a document that was not shipped. Such links can
only make clusters larger, step 4 decides.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickloom.llm.arrow import column, giving_back, packed, slices
from tickloom.llm.components import components
from tickloom.llm.set_keys import keys_of, shingle_sets, sketch
from tickloom.llm.tables import partitions, written

WORDS, THRESHOLD = 5, 80
CHUNK_BYTES = 1 << 20
# Keys packed together before they are shipped, per task.
SHIP_KEYS = 1 << 19
# A key of more documents than this in one chunk is thinned out to the first of them.
THIN = 8
# Meetings of more documents than this are linked to the first one without a sketch check.
WIDE = 1024
# Documents and elements of a block, about; blocks are compared two at a time.
BLOCK, BLOCK_ELEMENTS = 2048, 300_000
# Bins of the sketches that are shipped: about one for eight elements, so that those of unrelated sets differ by
# more than the threshold allows, whatever their size. A count that is cut at 255 can only bring two sketches closer.
BINS = (64, 1024)
KEY_BYTES = 5


def _chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
    for batch in batches:
        data, offsets = packed(column(batch, "text"))
        for first, last in slices(offsets, CHUNK_BYTES):
            yield batch.slice(first, last - first), data[offsets[first] : offsets[last]], offsets[first : last + 1] - offsets[first]


def _bins(size: int) -> int:
    return min(max(1 << (size // 8).bit_length(), BINS[0]), BINS[1])


def _folded(sketches: list[bytes]) -> np.ndarray:
    """Sketches brought to the fewest bins among them: the bin of an element is given by its lowest bits."""
    bins = min(map(len, sketches))
    return np.stack([np.minimum(np.frombuffer(s, np.uint8).reshape(-1, bins).sum(0, dtype=np.int32), 255) for s in sketches])


def document_sets(docs: DataFrame, words: int) -> DataFrame:
    """``doc_id, n_shingles, set_id, sketch``; ``set_id`` (null for an empty set) names the set by 128 bits."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, data, offsets in _chunks(batches):
            sets = shingle_sets(data, offsets, words)
            names = [hashlib.blake2b(s.tobytes(), digest_size=16).digest() if len(s) else None for s in sets]
            yield pa.RecordBatch.from_arrays(
                [
                    column(batch, "doc_id").cast(pa.int64()),
                    pa.array([len(s) for s in sets], pa.int64()),
                    pa.array(names, pa.binary()),
                    pa.array([np.minimum(sketch(s, _bins(len(s))), 255).astype(np.uint8).tobytes() for s in sets], pa.binary()),
                ],
                ["doc_id", "n_shingles", "set_id", "sketch"],
            )

    return docs.select("doc_id", "text").mapInArrow(giving_back(run), "doc_id bigint, n_shingles bigint, set_id binary, sketch binary")


def _shipments(docs: DataFrame, words: int, threshold: int, buckets: int) -> DataFrame:
    """Packed keys: ``bucket``, its ``docs`` with the number of their keys, the ``keys``, a bit for each that was ``thinned``; ``stars`` are links made here."""

    def pack(ids: list[int], keys: list[np.ndarray], marks: list[np.ndarray], stars: list[np.ndarray]) -> pa.RecordBatch:
        owner = np.repeat(np.arange(len(ids)), [len(k) for k in keys])
        flat = np.concatenate(keys) if keys else np.zeros(0, np.uint64)
        mark = np.concatenate(marks) if marks else np.zeros(0, bool)
        bucket = (flat % np.uint64(buckets)).astype(np.int64)
        order = np.argsort(bucket, kind="stable")
        flat, owner, mark, bucket = flat[order], owner[order], mark[order], bucket[order]
        rest = np.ascontiguousarray((flat // np.uint64(buckets)).astype("<u8")).view(np.uint8).reshape(-1, 8)[:, :KEY_BYTES]
        names = np.asarray(ids, np.int64)
        out: list[tuple] = []
        starts = np.flatnonzero(np.r_[True, bucket[1:] != bucket[:-1]]) if len(bucket) else np.zeros(0, np.int64)
        for first, last in zip(starts.tolist(), [*starts[1:].tolist(), len(bucket)][: len(starts)], strict=True):
            held, counts = np.unique(owner[first:last], return_counts=True)
            out.append((int(bucket[first]), names[held].tobytes(), counts.astype(np.int32).tobytes(), rest[first:last].tobytes(), np.packbits(mark[first:last]).tobytes(), b""))
        if stars:
            out.append((len(out) % buckets, b"", b"", b"", b"", np.unique(np.concatenate(stars), axis=0).tobytes()))
        return pa.RecordBatch.from_arrays(
            [pa.array([row[0] for row in out], pa.int32()), *(pa.array([row[i] for row in out], pa.binary()) for i in range(1, 6))],
            ["bucket", "docs", "counts", "keys", "thinned", "stars"],
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids: list[int] = []
        keys: list[np.ndarray] = []
        marks: list[np.ndarray] = []
        stars: list[np.ndarray] = []
        held = 0
        for batch, data, offsets in _chunks(batches):
            seen: dict[bytes, int] = {}
            some: list[np.ndarray] = []
            fresh: list[int] = []
            for doc, elements in zip(column(batch, "doc_id").to_pylist(), shingle_sets(data, offsets, words), strict=True):
                if doc is None or not len(elements):
                    continue
                # Of copies in the chunk the first is shipped; their class links them.
                if seen.setdefault(elements.tobytes(), doc) == doc:
                    fresh.append(doc)
                    some.append(keys_of(elements, threshold))
            if not fresh:
                continue
            flat = np.concatenate(some)
            owner = np.repeat(np.arange(len(fresh)), [len(k) for k in some])
            order = np.argsort(flat, kind="stable")
            starts = np.flatnonzero(np.r_[True, flat[order][1:] != flat[order][:-1]]) if len(flat) else np.zeros(0, np.int64)
            counts = np.diff(np.r_[starts, len(flat)])
            keep, mark = np.ones(len(flat), bool), np.zeros(len(flat), bool)
            names = np.asarray(fresh, np.int64)
            for at in np.flatnonzero(counts > THIN):
                places = order[starts[at] : starts[at] + counts[at]]
                keep[places[1:]] = False
                mark[places[0]] = True
                stars.append(np.stack([np.full(len(places) - 1, names[owner[places[0]]]), names[owner[places[1:]]]], 1))
            if stars:
                stars = [np.unique(np.concatenate(stars), axis=0)]
            ids += fresh
            ends = np.cumsum([len(k) for k in some])
            keys += [k[keep[e - len(k) : e]] for k, e in zip(some, ends, strict=True)]
            marks += [mark[e - len(k) : e][keep[e - len(k) : e]] for k, e in zip(some, ends, strict=True)]
            held += int(keep.sum())
            if held >= SHIP_KEYS:
                yield pack(ids, keys, marks, stars)
                ids, keys, marks, stars, held = [], [], [], [], 0
        if ids:
            yield pack(ids, keys, marks, stars)

    return docs.select("doc_id", "text").mapInArrow(giving_back(run), "bucket int, docs binary, counts binary, keys binary, thinned binary, stars binary")


def _meetings(shipments: DataFrame, n: int) -> DataFrame:
    """``list, sure, doc_id``: documents that share a key, each different list once per task.

    A list is named by a hash of its members; two lists of one name would be checked as one.
    ``sure`` lists are linked without a sketch check.
    """

    def meet(rows: list[tuple]) -> Iterator[pa.RecordBatch]:
        """The meetings of one bucket, from its packs ``docs, counts, keys, thinned, stars``."""
        docs = np.concatenate([np.frombuffer(row[0], np.int64) for row in rows])
        doc = np.repeat(docs, np.concatenate([np.frombuffer(row[1], np.int32) for row in rows]))
        raw = np.concatenate([np.frombuffer(row[2], np.uint8) for row in rows]).reshape(-1, KEY_BYTES)
        wide = np.zeros((len(raw), 8), np.uint8)
        wide[:, :KEY_BYTES] = raw
        key = wide.view("<u8").ravel()
        order = np.argsort(key, kind="stable")
        thinned = np.concatenate([np.unpackbits(np.frombuffer(row[3], np.uint8), count=len(row[2]) // KEY_BYTES) for row in rows]).astype(bool)
        key, doc, thinned = key[order], doc[order], thinned[order]
        starts = np.flatnonzero(np.r_[True, key[1:] != key[:-1]]) if len(key) else np.zeros(0, np.int64)
        sizes = np.diff(np.r_[starts, len(key)])
        links = [np.frombuffer(row[4], np.int64).reshape(-1, 2) for row in rows]
        hides = np.logical_or.reduceat(thinned, starts) if len(key) else np.zeros(0, bool)
        seen: tuple[set[bytes], set[bytes]] = set(), set()
        lists: list[np.ndarray] = []
        for at in np.flatnonzero(sizes > 1):
            members = np.unique(doc[starts[at] : starts[at] + sizes[at]])
            unchecked = bool(hides[at]) or len(members) > WIDE
            if len(members) < 2 or (name := members.tobytes()) in seen[unchecked]:
                continue
            seen[unchecked].add(name)
            if unchecked:
                links.append(np.stack([np.full(len(members) - 1, members[0]), members[1:]], 1))
            else:
                lists.append(members)
        sure = [*np.unique(np.concatenate(links), axis=0)]
        for some, flag in ((lists, False), (sure, True)):
            for at in range(0, len(some), 1 << 13):
                part = some[at : at + (1 << 13)]
                name = [int.from_bytes(hashlib.blake2b(m.tobytes(), digest_size=8).digest(), "little", signed=True) for m in part]
                member = np.concatenate(part)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.repeat(name, [len(m) for m in part]), pa.int64()), pa.array(np.full(len(member), flag)), pa.array(member, pa.int64())],
                    ["list", "sure", "doc_id"],
                )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        last = None
        for batch in batches:
            for bucket, *pack in zip(*(column(batch, c).to_pylist() for c in ("bucket", "docs", "counts", "keys", "thinned", "stars")), strict=True):
                if held and bucket != last:
                    yield from meet(held)
                    held = []
                last = bucket
                held.append(tuple(pack))
        if held:
            yield from meet(held)

    return shipments.repartition(n, "bucket").sortWithinPartitions("bucket").mapInArrow(giving_back(run), "list bigint, sure boolean, doc_id bigint")


def _by_key(batches: Iterator[pa.RecordBatch], names: list[str]) -> Iterator[pa.Table]:
    """Tables of the rows of one key each, from batches sorted by it."""
    held: list[pa.RecordBatch] = []
    last = None
    for batch in batches:
        keys = np.stack([column(batch, name).to_numpy(zero_copy_only=False).astype(np.int64) for name in names], 1)
        breaks = [0, *(np.flatnonzero((keys[1:] != keys[:-1]).any(1)) + 1).tolist(), len(keys)]
        for first, end in zip(breaks[:-1], breaks[1:], strict=True):
            if end > first:
                if held and last != tuple(keys[first]):
                    yield pa.Table.from_batches(held)
                    held = []
                last = tuple(keys[first])
                held.append(batch.slice(first, end - first))
    if held:
        yield pa.Table.from_batches(held)


def _differ(size: np.ndarray, other: np.ndarray | int, threshold: int) -> np.ndarray:
    return (100 - threshold) * (size + other) // (100 + threshold)


def _plausible(meetings: DataFrame, threshold: int, n: int) -> DataFrame:
    """Links ``a, b`` that connect in each meeting what sketches cannot rule out; input ``list, sure, doc_id, n_shingles, sketch``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        a: list[int] = []
        b: list[int] = []
        for table in _by_key(batches, ["list", "sure"]):
            ids, at = np.unique(table.column("doc_id").to_numpy(), return_index=True)
            if len(ids) < 2:
                continue
            if table.column("sure")[0].as_py():
                a += [int(ids[0])] * (len(ids) - 1)
                b += ids[1:].tolist()
            else:
                sizes = table.column("n_shingles").to_numpy()[at]
                marks = _folded(table.column("sketch").take(pa.array(at)).to_pylist())
                root = np.arange(len(ids))
                for i in range(len(ids) - 1):
                    others = np.flatnonzero(root != root[i])
                    if not len(others):
                        break
                    others = others[others > i]
                    near = others[np.abs(marks[others] - marks[i]).sum(1) <= _differ(sizes[others], sizes[i], threshold)]
                    for j in near:
                        if root[j] != root[i]:
                            root[root == root[j]] = root[i]
                            a.append(int(ids[i]))
                            b.append(int(ids[j]))
            if len(a) > 1 << 14:
                yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], ["a", "b"])
                a, b = [], []
        yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], ["a", "b"])

    return meetings.repartition(n, "list", "sure").sortWithinPartitions("list", "sure").mapInArrow(giving_back(run), "a bigint, b bigint")


def exact_links(ids: np.ndarray, sets: list[np.ndarray], side: np.ndarray, across: bool, threshold: int) -> list[tuple[int, int]]:
    """Links at or above the threshold that connect all linked sets; with ``across`` only between the two sides."""
    sizes = np.asarray([len(s) for s in sets], np.int64)
    flat = np.concatenate(sets)
    _, token = np.unique(flat, return_inverse=True)
    ends = np.cumsum(sizes)
    starts = ends - sizes
    marks = np.stack([sketch(s) for s in sets])
    root = np.arange(len(sets))
    present = np.zeros(int(token.max()) + 1 if len(token) else 1, bool)
    out = []
    for i in range(len(sets)):
        if across and side[i]:
            continue
        others = np.flatnonzero(root != root[i])
        others = others[side[others] == 1] if across else others[others > i]
        if not len(others):
            continue
        limit = _differ(sizes[others], sizes[i], threshold)
        others = others[np.abs(sizes[others] - sizes[i]) <= limit]
        others = others[np.abs(marks[others] - marks[i]).sum(1) <= _differ(sizes[others], sizes[i], threshold)]
        if not len(others):
            continue
        mine = token[starts[i] : ends[i]]
        present[mine] = True
        # The tokens of the others in a row: the places of their spans.
        spans = np.repeat(starts[others] - np.r_[0, np.cumsum(sizes[others])[:-1]], sizes[others]) + np.arange(int(sizes[others].sum()))
        shared = np.add.reduceat(present[token[spans]].astype(np.int64), np.r_[0, np.cumsum(sizes[others])[:-1]])
        present[mine] = False
        linked = others[100 * shared >= threshold * (sizes[others] + sizes[i] - shared)]
        for j in linked:
            if root[j] != root[i]:
                root[root == root[j]] = root[i]
                out.append((int(ids[i]), int(ids[j])))
    return out


def _verified(rows: DataFrame, words: int, threshold: int, n: int) -> DataFrame:
    """Exact links within clusters, from rows ``cluster, p, q, block, doc_id, text``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        a: list[int] = []
        b: list[int] = []
        for table in _by_key(batches, ["cluster", "p", "q"]):
            data, offsets = packed(table.column("text").combine_chunks() if table.num_rows else table.column("text"))
            sets: list[np.ndarray] = []
            for first, last in slices(offsets, CHUNK_BYTES):
                sets += shingle_sets(data[offsets[first] : offsets[last]], offsets[first : last + 1] - offsets[first], words)
            ids = table.column("doc_id").to_numpy()
            p, q = table.column("p")[0].as_py(), table.column("q")[0].as_py()
            side = (table.column("block").to_numpy() == q).astype(np.int64)
            for x, y in exact_links(ids, sets, side, p != q, threshold):
                a.append(x)
                b.append(y)
            if len(a) > 1 << 14:
                yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], ["a", "b"])
                a, b = [], []
        yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], ["a", "b"])

    return rows.repartition(n, "cluster", "p", "q").sortWithinPartitions("cluster", "p", "q").mapInArrow(giving_back(run), "a bigint, b bigint")


def join_components(docs: DataFrame, words: int = WORDS, threshold: int = THRESHOLD) -> DataFrame:
    """``doc_id, n_shingles, component_id`` for every row.

    Words are runs of bytes other than white space, A to Z in lower case; a
    document's set holds its distinct ``words``-word shingles, or its whole word
    sequence if it has fewer words. Two documents are linked when the sets'
    Jaccard similarity is ``threshold`` per cent or more; ``component_id`` is the
    smallest ``doc_id`` reachable by links.

    Defined cases: a null text or one without words has an empty set (size 0) and
    is its own component; a row without ``doc_id`` is linked with nothing and has
    a null component; rows of one ``doc_id`` are one document, linked with all that
    one of its rows is linked with; further columns are ignored; an empty table
    gives an empty result.
    """
    spark = docs.sparkSession
    n = partitions(spark)
    sets = written(document_sets(docs, words), "sets")
    named = sets.where("doc_id is not null and set_id is not null")
    classes = named.groupBy("set_id").agg(F.min("doc_id").alias("first"))
    standing = written(named.join(classes, "set_id").select("doc_id", "n_shingles", "sketch", "first"), "standing")

    # Rows of one id may have different sets, which then belong together.
    several = written(named.groupBy("doc_id").agg(F.min("set_id").alias("a"), F.max("set_id").alias("b")).where("a <> b").select("doc_id"), "several")

    met = written(_meetings(_shipments(docs, words, threshold, 2 * n), n), "meetings")
    known = standing.where("doc_id = first").groupBy("doc_id").agg(F.max(F.struct("n_shingles", "sketch")).alias("s")).select("doc_id", "s.*")
    stand_in = standing.select("doc_id", "first")
    # One sketch says nothing of an id's other sets: such an id is linked without a check wherever it meets others.
    unsure = met.where("not sure").join(several, "doc_id", "left_semi").select(F.col("list").alias("_list")).distinct()
    met = met.join(unsure, F.col("list") == F.col("_list"), "left").withColumn("sure", F.col("sure") | F.col("_list").isNotNull()).drop("_list")
    meetings = (
        met.distinct().join(stand_in, "doc_id").select("list", "sure", F.col("first").alias("doc_id")).distinct().join(known, "doc_id")
    )
    clusters = written(components(_plausible(meetings, threshold, n)), "clusters")

    weighed = clusters.join(known.select(F.col("doc_id").alias("node"), "n_shingles"), "node")
    sizes = weighed.groupBy("component").agg(F.count("*").alias("size"), F.sum("n_shingles").alias("elements"))
    blocks = F.expr(f"cast(greatest(ceil(size / {BLOCK}), ceil(elements / {BLOCK_ELEMENTS})) as int)")
    placed = clusters.join(sizes, "component").select(
        F.col("node").alias("doc_id"), F.col("component").alias("cluster"), blocks.alias("blocks"),
        F.pmod(F.xxhash64("node"), blocks).cast("int").alias("block"),
    )
    other = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other")
    pairs = placed.select("doc_id", "cluster", "block", other).select(
        "doc_id", "cluster", "block", F.least("block", "other").alias("p"), F.greatest("block", "other").alias("q")
    )
    texts = docs.where("doc_id is not null").select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    # Shuffled at every size: the list of clustered documents grows with the input.
    links = _verified(pairs.join(texts.hint("merge"), "doc_id").select("cluster", "p", "q", "block", "doc_id", "text"), words, threshold, n)
    same_id = named.join(several, "doc_id", "left_semi").join(classes, "set_id").select(F.col("doc_id").alias("a"), F.col("first").alias("b"))
    linked = components(links.unionByName(same_id)).select(F.col("node").alias("first"), "component")

    labels = named.join(classes, "set_id").select("set_id", "first").distinct().join(linked, "first", "left")
    smallest = F.coalesce("component", "first").alias("component_id")
    found = labels.select("set_id", smallest)
    return sets.join(found, "set_id", "left").select(
        "doc_id", "n_shingles", F.when(F.col("doc_id").isNotNull(), F.coalesce("component_id", "doc_id")).alias("component_id")
    )
