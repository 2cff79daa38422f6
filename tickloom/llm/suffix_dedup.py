"""Removal of repeated byte strings by prefix-free parsing and suffix sorting.

Every byte goes that is covered by a string of ``match`` bytes which also starts
earlier (smaller ``doc_id``, or earlier in the same document).

1. *Parsing.* Texts are cut into overlapping phrases by rolling-hash triggers
   (``phrases``). Equal windows have equal triggers, so they stand in phrases of
   one trigger.
2. *Dictionary.* Phrases are shipped as hashes, packed per bucket of triggers. Of
   a phrase that occurs several times the earliest occurrence stays; in all
   others every window is a repeat. If all phrases of a trigger are equal, that
   settles it. Else the different phrases of the trigger (the dictionary
   entries) may share some windows: they are asked for.
3. *Suffixes.* The asked-for phrases come together by trigger. Their suffixes of at
   least ``match`` bytes are sorted; equal windows are neighbours, and the one of
   the smallest place in the corpus order stays.
4. *Removal.* What was found in 2 and 3 meets the texts.

Steps 3 and 4 read texts and findings dealt to the same buckets, findings first.
A phrase or window that very many documents share leaves a task once; a trigger
with very many different phrases is settled by 128-bit hashes of single windows
instead, which spread over all tasks.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tickloom.llm.arrow import column, giving_back, packed
from tickloom.llm.phrases import Phrases, parse, pieces
from tickloom.llm.tables import partitions, quoted, written

MATCH, GRAM = 100, 48
# Phrases held by a task before they are shipped.
SHIP = 1 << 18
# Findings of a task packed together.
GATHER = 1 << 18
# Suffixes sorted together.
SORTED = 1 << 17
# A trigger with more different phrases than this is settled window by window.
HOT = 256
NO_ID = -(2**63)
TRIGGER_BYTES, CONTENT_BYTES = 5, 8


def _short(values: np.ndarray, width: int) -> bytes:
    return np.ascontiguousarray(values.astype("<u8")).view(np.uint8).reshape(-1, 8)[:, :width].tobytes()


def _long(raw: bytes, width: int) -> np.ndarray:
    out = np.zeros((len(raw) // width, 8), np.uint8)
    out[:, :width] = np.frombuffer(raw, np.uint8).reshape(-1, width)
    return out.view("<u8").ravel()


def _runs(*keys: np.ndarray) -> np.ndarray:
    """Where a new value begins in sorted keys."""
    if not len(keys[0]):
        return np.zeros(0, np.int64)
    new = np.ones(len(keys[0]), bool)
    new[1:] = np.logical_or.reduce([key[1:] != key[:-1] for key in keys])
    return np.flatnonzero(new)


def _spans(begins: np.ndarray, n: int) -> Iterator[tuple[int, int]]:
    return zip(begins.tolist(), [*begins[1:].tolist(), n][: len(begins)], strict=True)


def _later(first: np.ndarray, doc: np.ndarray, start: np.ndarray) -> np.ndarray:
    """Which rows are elsewhere than the first row of their run; ``first``: the runs' begins."""
    lead = np.repeat(first, np.diff(np.r_[first, len(doc)]))
    return (doc != doc[lead]) | (start != start[lead])


# --- findings: spans of windows per document, packed per bucket of documents ------------

COVER, ASK, ASK_HOT = 0, 1, 2
FOUND = "bucket bigint, what int, docs binary, tags binary, starts binary, counts binary, keys binary"


def _found(what: int, doc, tag, start, count, buckets: int, key=None) -> Iterator[pa.RecordBatch]:
    order = np.lexsort((start, tag, doc, doc % buckets))
    doc, tag, start, count = doc[order], tag[order], start[order], count[order]
    key = None if key is None else key[order]
    if key is None and len(doc):  # spans of windows that touch become one
        end = start + count
        new = np.ones(len(doc), bool)
        new[1:] = (doc[1:] != doc[:-1]) | (tag[1:] != tag[:-1]) | (start[1:] > end[:-1])
        at = np.flatnonzero(new)
        count = np.maximum.reduceat(end, at) - start[at]
        doc, tag, start = doc[at], tag[at], start[at]
    bucket = doc % buckets
    begins = _runs(bucket)
    rows = [[], [], [], [], [], []]
    for first, last in _spans(begins, len(doc)):
        part = slice(first, last)
        rows[0].append(int(bucket[first]))
        for i, (values, kind) in enumerate(((doc, "<i8"), (tag, "<u4"), (start, "<i8"), (count, "<i8"), (key, "<u8"))):
            rows[i + 1].append(b"" if values is None else values[part].astype(kind).tobytes())
    if rows[0]:
        yield pa.RecordBatch.from_arrays(
            [pa.array(rows[0], pa.int64()), pa.array([what] * len(rows[0]), pa.int32()), *(pa.array(r, pa.binary()) for r in rows[1:])],
            ["bucket", "what", "docs", "tags", "starts", "counts", "keys"],
        )


def _gathered(findings: Iterator[tuple], buckets: int) -> Iterator[pa.RecordBatch]:
    """Findings ``what, doc, tag, start, count[, key]`` packed together, ``GATHER`` at a time."""
    held: dict[int, list[tuple]] = {}
    size = 0

    def flush() -> Iterator[pa.RecordBatch]:
        for what, parts in held.items():
            columns = [np.concatenate(x) for x in zip(*parts, strict=True)]
            yield from _found(what, *columns[:4], buckets, key=columns[4] if len(columns) > 4 else None)

    for what, *columns in findings:
        held.setdefault(what, []).append(tuple(columns))
        size += len(columns[0])
        if size >= GATHER:
            yield from flush()
            held, size = {}, 0
    yield from flush()


# --- steps 1 and 2 ------------------------------------------------------------------------

SHIPPED = "bucket int, docs binary, tags binary, held binary, triggers binary, contents binary, starts binary, counts binary, covered binary"


def _texts(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """Per batch its bytes, offsets, document numbers and text checksums."""
    for batch in batches:
        data, offsets = packed(column(batch, "text"))
        tags = np.array([zlib.crc32(data[a:b]) for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist(), strict=True)], np.int64)
        yield data, offsets, column(batch, "place").to_numpy(), tags


def _ship(docs: DataFrame, match: int, gram: int, buckets: int) -> DataFrame:
    def pack(parts: list[tuple]) -> pa.RecordBatch:
        doc, tag, start, count, trigger, content = (np.concatenate(x) for x in zip(*parts, strict=True))
        bucket = (trigger % np.uint64(buckets)).astype(np.int64)
        trigger = trigger // np.uint64(buckets) & np.uint64(2**40 - 1)
        # Of a phrase that is here several times only the earliest occurrence travels.
        order = np.lexsort((start, doc, content, trigger, bucket))
        begins = _runs(bucket[order], trigger[order], content[order])
        later = np.zeros(len(doc), bool)
        later[order] = _later(begins, doc[order], start[order])
        covered = [np.stack([x[later] for x in (doc, tag, start, count)])] if later.any() else []
        keep = ~later
        doc, tag, start, count, trigger, content, bucket = (x[keep] for x in (doc, tag, start, count, trigger, content, bucket))
        order = np.lexsort((start, tag, doc, bucket))
        doc, tag, start, count, trigger, content, bucket = (x[order] for x in (doc, tag, start, count, trigger, content, bucket))
        rows: list[tuple] = []
        begins = _runs(bucket)
        for first, last in _spans(begins, len(doc)):
            s = slice(first, last)
            owners = _runs(doc[s], tag[s])
            rows.append(
                (
                    int(bucket[first]), doc[s][owners].astype("<i8").tobytes(), tag[s][owners].astype("<u4").tobytes(),
                    np.diff(np.r_[owners, last - first]).astype("<u4").tobytes(), _short(trigger[s], TRIGGER_BYTES), _short(content[s], CONTENT_BYTES),
                    start[s].astype("<u4").tobytes() if start[s].max(initial=0) < 2**32 else start[s].astype("<i8").tobytes(),
                    count[s].astype(np.uint8).tobytes(), b"",
                )
            )
        if covered:
            rows.append((int(len(rows) and rows[0][0]), *[b""] * 7, covered[0].astype("<i8").tobytes()))
        names = [part.split()[0] for part in SHIPPED.split(", ")]
        return pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.int32()), *(pa.array([r[i] for r in rows], pa.binary()) for i in range(1, 9))], names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts, held = [], 0
        for data, offsets, ids, tags in _texts(batches):
            for piece in pieces(data, offsets, match):
                found: Phrases = parse(piece, match, gram)
                if len(found.text):
                    parts.append((ids[found.text], tags[found.text], found.start, found.count, found.trigger, found.content))
                    held += len(found.text)
                if held >= SHIP:
                    yield pack(parts)
                    parts, held = [], 0
        if parts:
            yield pack(parts)

    return docs.mapInArrow(giving_back(run), SHIPPED)


def _dictionary(shipped: DataFrame, n: int, buckets: int) -> DataFrame:
    """Findings: occurrences that repeat an earlier phrase, and phrases whose windows have to be compared."""

    def settle(parts: list[tuple]) -> Iterator[tuple]:
        """The findings of one bucket of triggers."""
        doc, tag, start, count, trigger, content = (np.concatenate(x) for x in zip(*parts, strict=True))
        order = np.lexsort((start, doc, content, trigger))
        doc, tag, start, count, trigger, content = (x[order] for x in (doc, tag, start, count, trigger, content))
        entries = _runs(trigger, content)
        later = _later(entries, doc, start)
        yield COVER, doc[later], tag[later], start[later], count[later]
        begins = _runs(trigger)
        different = np.diff(np.r_[np.searchsorted(entries, begins), len(entries)])
        different = np.repeat(different, np.diff(np.r_[begins, len(trigger)]))
        for what, wanted in ((ASK, (different > 1) & (different <= HOT)), (ASK_HOT, different > HOT)):
            ask = ~later & wanted
            yield what, doc[ask], tag[ask], start[ask], count[ask], trigger[ask]

    def findings(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        parts: list[tuple] = []
        last = None
        for batch in batches:
            for row in zip(*(column(batch, part.split()[0]).to_pylist() for part in SHIPPED.split(", ")), strict=True):
                bucket, docs, tags, held, triggers, contents, starts, counts, covered = row
                if covered:
                    yield COVER, *np.frombuffer(covered, "<i8").reshape(4, -1)
                    continue
                if parts and bucket != last:
                    yield from settle(parts)
                    parts = []
                last = bucket
                held = np.frombuffer(held, "<u4")
                trigger = _long(triggers, TRIGGER_BYTES) | np.uint64(bucket << (8 * TRIGGER_BYTES))
                wide = "<u4" if len(starts) == 4 * len(trigger) else "<i8"
                parts.append(
                    (
                        np.repeat(np.frombuffer(docs, "<i8"), held), np.repeat(np.frombuffer(tags, "<u4"), held).astype(np.int64),
                        np.frombuffer(starts, wide).astype(np.int64), np.frombuffer(counts, np.uint8).astype(np.int64), trigger, _long(contents, CONTENT_BYTES),
                    )
                )
        if parts:
            yield from settle(parts)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return _gathered(findings(batches), buckets)

    return shipped.repartition(n, "bucket").sortWithinPartitions("bucket").mapInArrow(giving_back(run), FOUND)


# --- texts and findings by bucket ---------------------------------------------------------


class _Findings:
    """The findings of one bucket, by document and text."""

    def __init__(self):
        self.rows: list[tuple] = []
        self.table: tuple | None = None

    def add(self, what: int, docs: bytes, tags: bytes, starts: bytes, counts: bytes, keys: bytes) -> None:
        doc = np.frombuffer(docs, "<i8")
        key = np.frombuffer(keys, "<u8") if keys else np.zeros(len(doc), np.uint64)
        self.rows.append((doc, np.frombuffer(tags, "<u4").astype(np.int64), np.frombuffer(starts, "<i8"), np.frombuffer(counts, "<i8"), key, np.full(len(doc), what)))
        self.table = None

    def of(self, doc: int, tag: int) -> tuple[np.ndarray, ...]:
        """``start, count, key, what`` of one text."""
        if self.table is None:
            if not self.rows:
                self.rows.append((*(np.zeros(0, np.int64),) * 4, np.zeros(0, np.uint64), np.zeros(0, np.int64)))
            columns = [np.concatenate(x) for x in zip(*self.rows, strict=True)]
            order = np.argsort(columns[0], kind="stable")
            self.table = tuple(c[order] for c in columns)
        ids, tags, *rest = self.table
        a, b = np.searchsorted(ids, doc, "left"), np.searchsorted(ids, doc, "right")
        own = tags[a:b] == tag
        return tuple(c[a:b][own] for c in rest)


def _dealt(docs: DataFrame, found: DataFrame, n: int, buckets: int) -> DataFrame:
    """Findings, then texts, of each bucket."""
    bucket = F.pmod("place", F.lit(buckets))
    texts = docs.select(bucket.alias("bucket"), F.lit(9).alias("what"), "place", "text", "carry")
    return texts.unionByName(found, allowMissingColumns=True).repartition(n, "bucket").sortWithinPartitions("bucket", "what")


def _with_findings(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.RecordBatch, int, bytes, _Findings, int]]:
    """Texts with the findings of their bucket: the batch, the row in it, text, findings, document."""
    held, last = _Findings(), None
    for batch in batches:
        buckets, whats = column(batch, "bucket").to_pylist(), column(batch, "what").to_pylist()
        places, texts = column(batch, "place").to_pylist(), column(batch, "text")
        findings = [column(batch, c) for c in ("docs", "tags", "starts", "counts", "keys")]
        for i, (bucket, what) in enumerate(zip(buckets, whats, strict=True)):
            if bucket != last:
                held, last = _Findings(), bucket
            if what < 9:
                held.add(what, *(f[i].as_py() for f in findings))
            else:
                yield batch, i, texts[i].as_py(), held, places[i]


# --- step 3 -------------------------------------------------------------------------------

SENT = "bucket int, kind int, keys binary, docs binary, tags binary, starts binary, counts binary, content binary"


def _send(dealt: DataFrame, match: int, buckets: int) -> DataFrame:
    """The asked-for phrases as bytes (kind 0), windows of hot triggers as hashes (kind 1), windows settled here (kind 2)."""

    def rows(kind: int, key: np.ndarray, doc, tag, start, count, content: list[bytes]) -> Iterator[pa.RecordBatch]:
        bucket = (key % np.uint64(buckets)).astype(np.int64)
        order = np.argsort(bucket, kind="stable")
        begins = _runs(bucket[order])
        out: list[tuple] = []
        for first, last in _spans(begins, len(order)):
            at = order[first:last]
            out.append(
                (
                    int(bucket[at[0]]), kind, key[at].tobytes(), doc[at].astype("<i8").tobytes(), tag[at].astype("<u4").tobytes(),
                    start[at].astype("<i8").tobytes(), count[at].astype("<u4").tobytes(), b"".join([content[i] for i in at]) if content else b"",
                )
            )
        if out:
            kinds = [pa.int32(), pa.int32(), *[pa.binary()] * 6]
            yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in out], k) for i, k in enumerate(kinds)], [p.split()[0] for p in SENT.split(", ")])

    def ship(phrases: list[tuple], windows: list[tuple]) -> Iterator[pa.RecordBatch]:
        if phrases:
            key, doc, tag, start, count, content = zip(*phrases, strict=True)
            yield from rows(0, np.array(key, np.uint64), *(np.array(x, np.int64) for x in (doc, tag, start, count)), content)
        if windows:
            name, doc, tag, start = zip(*windows, strict=True)
            doc, tag, start = (np.array(x, np.int64) for x in (doc, tag, start))
            name = np.frombuffer(b"".join(name), "<u8").reshape(-1, 2)
            order = np.lexsort((start, doc, name[:, 1], name[:, 0]))
            name, doc, tag, start = name[order], doc[order], tag[order], start[order]
            later = _later(_runs(name[:, 0], name[:, 1]), doc, start)
            one = np.ones(len(doc), np.int64)
            if later.any():
                yield from rows(2, name[later, 0], doc[later], tag[later], start[later], one[later], [])
            name, doc, tag, start, one = (x[~later] for x in (name, doc, tag, start, one))
            yield from rows(1, np.ascontiguousarray(name[:, 0]), doc, tag, start, one, [x.tobytes() for x in name[:, 1]])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        phrases, windows, size = [], [], 0
        for _, _, text, findings, doc in _with_findings(batches):
            tag = zlib.crc32(text)
            for start, count, key, what in zip(*(c.tolist() for c in findings.of(doc, tag)), strict=True):
                if what == ASK:
                    phrases.append((key, doc, tag, start, count, text[start : start + count + match - 1]))
                    size += count + match
                elif what == ASK_HOT:
                    for at in range(start, start + count):
                        windows.append((hashlib.blake2b(text[at : at + match], digest_size=16).digest(), doc, tag, at))
                    size += 64 * count
            if size >= 1 << 24:
                yield from ship(phrases, windows)
                phrases, windows, size = [], [], 0
        yield from ship(phrases, windows)

    return dealt.mapInArrow(giving_back(run), SENT)


def suffix_repeats(key, doc, start, count, content: bytes, match: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Which windows of phrases repeat an earlier one of the same key: the phrase's row, and the window's place in it.

    Rows are sorted by key, document and place. The suffixes of all phrases of
    a key are sorted as strings; the sort is stable, so of equal windows the
    earliest comes first.
    """
    sizes = count + match - 1
    begins = np.cumsum(np.r_[0, sizes])
    data = np.frombuffer(content, np.uint8)
    groups = _runs(key)
    ends = np.r_[groups[1:], len(key)]
    total = np.cumsum(np.r_[0, count])
    g = 0
    while g < len(groups):
        h = max(g + 1, int(np.searchsorted(total[ends], total[groups[g]] + SORTED, "right")))
        a, b = int(groups[g]), int(ends[h - 1])
        row = np.repeat(np.arange(a, b), count[a:b])
        place = np.arange(len(row)) - np.repeat(total[a:b] - total[a], count[a:b])
        suffix = np.empty((len(row), 4 + match), np.uint8)
        suffix[:, :4] = np.repeat(np.arange(g, h), ends[g:h] - groups[g:h]).astype(">u4").view(np.uint8).reshape(-1, 4)[row - a]
        suffix[:, 4:] = np.lib.stride_tricks.sliding_window_view(data, match)[begins[row] + place]
        order = np.argsort(suffix.view(f"V{4 + match}").ravel(), kind="stable")
        suffix = suffix[order]
        new = np.r_[True, (suffix[1:] != suffix[:-1]).any(1)]
        row, place = row[order], place[order]
        later = _later(np.flatnonzero(new), doc[row], start[row] + place)
        yield row[later], place[later]
        g = h


def _compare(sent: DataFrame, match: int, n: int, buckets: int) -> DataFrame:
    def settle(kind: int, rows: list[tuple]) -> Iterator[tuple]:
        """The findings of one bucket and kind."""
        key, doc, tag, start, count, content = (np.concatenate(x) for x in zip(*rows, strict=True))
        tag, count = tag.astype(np.int64), count.astype(np.int64)
        if kind == 2:
            yield COVER, doc, tag, start, count
        elif kind == 1:
            second = content.view("<u8")
            order = np.lexsort((start, doc, second, key))
            key, second, doc, tag, start, count = (x[order] for x in (key, second, doc, tag, start, count))
            later = _later(_runs(key, second), doc, start)
            yield COVER, doc[later], tag[later], start[later], count[later]
        else:
            begins = np.cumsum(np.r_[0, count + match - 1])
            order = np.lexsort((start, doc, key))
            raw = content.tobytes()
            content = b"".join([raw[begins[i] : begins[i + 1]] for i in order.tolist()])
            key, doc, tag, start, count = (x[order] for x in (key, doc, tag, start, count))
            for row, place in suffix_repeats(key, doc, start, count, content, match):
                yield COVER, doc[row], tag[row], start[row] + place, np.ones(len(row), np.int64)

    def findings(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        rows: list[tuple] = []
        last = None
        for batch in batches:
            for bucket, kind, *raw in zip(*(column(batch, p.split()[0]).to_pylist() for p in SENT.split(", ")), strict=True):
                if rows and (bucket, kind) != last:
                    yield from settle(last[1], rows)
                    rows = []
                last = (bucket, kind)
                rows.append(tuple(np.frombuffer(x, t) for x, t in zip(raw, ("<u8", "<i8", "<u4", "<i8", "<u4", np.uint8), strict=True)))
        if rows:
            yield from settle(last[1], rows)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return _gathered(findings(batches), buckets)

    return sent.repartition(n, "bucket").sortWithinPartitions("bucket", "kind").mapInArrow(giving_back(run), FOUND)


# --- step 4 -------------------------------------------------------------------------------


def _whole(text: bytes, edges: np.ndarray) -> np.ndarray:
    """The spans without characters that they cut."""
    out = []
    for a, b in edges.tolist():
        while a < b and text[a] & 0xC0 == 0x80:
            a += 1
        while a < b < len(text) and text[b] & 0xC0 == 0x80:
            b -= 1
        if a < b:
            out.append((a, b))
    return np.array(out, np.int64).reshape(-1, 2)


def _remove(dealt: DataFrame, match: int, whole_characters: bool) -> DataFrame:
    spans_type = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["carry", "kept", "n_bytes", "n_removed", "spans"]

        def result(batch: pa.RecordBatch, rows: list[tuple]) -> pa.RecordBatch:
            at, kept, sizes, gone, spans = zip(*rows, strict=True)
            carried = column(batch, "carry").take(pa.array(at, pa.int64()))
            return pa.RecordBatch.from_arrays(
                [carried, pa.array(kept, pa.binary()), pa.array(sizes, pa.int64()), pa.array(gone, pa.int64()), pa.array(spans, spans_type)], names
            )

        rows: list[tuple] = []
        current, size = None, 0
        for batch, i, text, findings, doc in _with_findings(batches):
            if rows and (batch is not current or size >= 1 << 22):
                yield result(current, rows)
                rows, size = [], 0
            current = batch
            start, count, _, _ = findings.of(doc, zlib.crc32(text)) if len(text) >= match else (np.zeros(0, np.int64),) * 4
            change = np.zeros(len(text) + 1, np.int32)
            np.add.at(change, start, 1)
            np.add.at(change, start + count + match - 1, -1)
            covered = np.zeros(len(text) + 2, np.int8)
            covered[1:-1] = np.cumsum(change[:-1]) > 0
            edges = np.flatnonzero(np.diff(covered)).reshape(-1, 2)
            if whole_characters:
                edges = _whole(text, edges)
            kept, last = [], 0
            for a, b in edges.tolist():
                kept.append(text[last:a])
                last = b
            kept = b"".join([*kept, text[last:]])
            rows.append((i, kept, len(text), len(text) - len(kept), [{"start": a, "end": b} for a, b in edges.tolist()]))
            size += len(kept)
        if rows:
            yield result(current, rows)

    rest = StructType.fromDDL("kept binary, n_bytes bigint, n_removed bigint, spans array<struct<start: bigint, end: bigint>>")
    # Not as text: the carried columns may have any names.
    return dealt.mapInArrow(giving_back(run), StructType([dealt.schema["carry"], *rest.fields]))


def remove_repeats(docs: DataFrame, match: int = MATCH, gram: int = GRAM, whole_characters: bool = False) -> DataFrame:
    """Per row ``carry`` (the row as it was, but for its text), ``kept`` bytes, ``n_bytes``, ``n_removed`` and the removed ``spans``.

    Texts are bytes; repeats are judged on the input, and never cross documents.
    With ``whole_characters`` a character that a span would cut stays.

    Defined cases: a null text is empty and keeps nothing; a null ``doc_id`` comes
    before all others; rows of one ``doc_id`` are one document: a string at
    the same place of both is not earlier in either; further columns travel in
    ``carry``, whatever their names; an empty table gives an empty result.
    """
    n = partitions(docs.sparkSession)
    buckets = 2 * n + 1
    rows = docs.select(
        F.coalesce(F.col("doc_id").cast("bigint"), F.lit(NO_ID)).alias("place"),
        F.coalesce("text", F.lit("")).cast("binary").alias("text"),
        F.struct(*[F.col(quoted(c)) for c in docs.columns if c != "text"]).alias("carry"),
    )
    first = written(_dictionary(_ship(rows.select("place", "text"), match, gram, 2 * n), n, buckets), "repeats")
    asked = _dealt(rows.withColumn("carry", F.lit(None).cast("string")), first.where(f"what <> {COVER}"), n, buckets)
    second = written(_compare(_send(asked, match, 2 * n), match, n, buckets), "repeats")
    covered = first.where(f"what = {COVER}").unionByName(second)
    return _remove(_dealt(rows, covered, n, buckets), match, whole_characters)
