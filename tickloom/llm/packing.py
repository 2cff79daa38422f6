"""Harmonic packing: sequences filled by length class, class by class and worker by worker.

A piece of ``n`` ids belongs to class ``k = capacity div n``: its length lies in
``(capacity / (k + 1), capacity / k]``, so exactly ``k`` such pieces fill a
sequence, whichever they are. No piece has to know any other, only its number
within its class. Documents are cut so that most pieces are as long as their
class allows (see ``cuts``).

Pieces are dealt to *workers* by a hash; each worker fills the sequences of a
class with ``k`` pieces each. What a worker has left over (fewer than ``k`` pieces
of a class) is put together in a second round over all workers.
"""

from __future__ import annotations

import functools
import os
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tickloom.llm.arrow import column, giving_back, packed, slices
from tickloom.llm.pair_index import piece_starts
from tickloom.llm.runs import as_utf8, gathered
from tickloom.llm.tables import written

CAPACITY = 2048
END_ID = 1
# A rest of fewer ids than this is not cut any further.
LEAST_CUT = 64
WORKERS = 256
# Different pieces kept per Python worker, words and bytes encoded in one call, and bytes of texts worked on at once.
MEMO_WORDS = 400_000
JOINED_WORDS = 500
CALL_BYTES = 1 << 20
GATHERED_BYTES = 1 << 23

# Letters of Latin-1: normalised and lowered they stay letters, one by one.
PLAIN = re.compile(rb"(?:[A-Za-z]|\xc3[\x80-\x96\x98-\xb6\xb8-\xbf])+")


def cuts(length: int, capacity: int = CAPACITY, least: int = LEAST_CUT) -> list[int]:
    """Lengths of a document's pieces.

    The longest length ``capacity div k`` that fits is cut off again and again:
    such pieces fill their class without padding (but for the division's
    remainder). A rest below ``least`` is the last piece; its class pads less than
    its own length.
    """
    out = [capacity] * (length // capacity)
    rest = length % capacity
    while rest >= least:
        piece = capacity // -(-capacity // rest)
        out.append(piece)
        rest -= piece
    return out + [rest] if rest else out


class WordIds:
    """Ids of texts, encoded piece by piece: the tokenizer sees a piece once, not at each of its places.

    The tokenizer drops white space, never looks across it, and never joins
    letters, digits and signs, so a text cut there (``piece_starts``) has the ids of its
    pieces in a row. Pieces are told apart for many texts at once; only
    different ones are looked up, and new words of plain letters go to the tokenizer
    many in one text, where each ends with an id that says so.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # tasks are the parallelism
        self.tokenizer = Tokenizer.from_file(path)
        vocabulary = self.tokenizer.get_vocab()
        self.ends = np.zeros(max(vocabulary.values(), default=0) + 1, bool)
        self.ends[[id_ for token, id_ in vocabulary.items() if token.endswith("</w>")]] = True
        added = sorted((token.content.encode() for token in self.tokenizer.get_added_tokens_decoder().values()), key=lambda t: (-len(t), t))
        self.find_added = re.compile(b"|".join(map(re.escape, added))) if added else None
        self.known: dict[bytes, bytes] = {}
        self.older: dict[bytes, bytes] = {}

    def _encoded(self, texts: list[str]) -> list[np.ndarray]:
        return [np.asarray(found.ids, "<u4") for found in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _learn(self, fresh: list[bytes]) -> Iterator[tuple[bytes, bytes]]:
        """New pieces and their ids."""
        plain: list[bytes] = []
        others: list[bytes] = []
        for piece in fresh:
            (plain if piece.isalpha() or PLAIN.fullmatch(piece) else others).append(piece)
        for at in range(0, len(plain), JOINED_WORDS):
            words = plain[at : at + JOINED_WORDS]
            ids = self._encoded([b" ".join(words).decode()])[0]
            ends = np.flatnonzero(self.ends[ids]) + 1
            if len(ends) != len(words):  # the vocabulary has no ends of words
                others += words
                continue
            raw, first = ids.tobytes(), 0
            for word, last in zip(words, (4 * ends).tolist(), strict=True):
                yield word, raw[first:last]
                first = last
        first = 0
        while first < len(others):
            size, last = 0, first
            while last < len(others) and (last == first or size + len(others[last]) < CALL_BYTES):
                size += len(others[last])
                last += 1
            part = others[first:last]
            # One call with the pieces as separate inputs of a batch.
            yield from zip(part, (ids.tobytes() for ids in self._encoded([piece.decode() for piece in part])), strict=True)
            first = last

    def _look_up(self, pieces: list[bytes]) -> list[bytes]:
        if len(self.known) > MEMO_WORDS:
            self.older, self.known = self.known, {}
        # White space around a piece is dropped, and the tokenizer lowers letters itself.
        keys = [piece.strip(b" \t\r\n") for piece in pieces]
        keys = [key.lower() if key.isalpha() or PLAIN.fullmatch(key) else key for key in keys]
        held: dict[bytes, bytes] = {}
        fresh = []
        for key in dict.fromkeys(keys):
            ids = self.known.get(key)
            if ids is None:
                ids = self.older.get(key)
            if ids is None:
                fresh.append(key)
            else:
                held[key] = ids
        held.update(self._learn(fresh))
        self.known.update(held)
        return [held[key] for key in keys]

    def _bounds(self, data: np.ndarray, offsets: np.ndarray, raw: bytes) -> np.ndarray:
        """Where pieces begin, and the end. An added token of the tokenizer's is one piece."""
        cut = np.zeros(len(data) + 1, bool)
        for at in range(0, len(data), GATHERED_BYTES):
            cut[at : min(at + GATHERED_BYTES, len(data))] = piece_starts(data[max(at - 3, 0) : at + GATHERED_BYTES])[min(at, 3) :]
        cut[offsets] = True
        if self.find_added:
            for first, last in zip(offsets[:-1].tolist(), offsets[1:].tolist(), strict=True):
                for match in self.find_added.finditer(raw, first, last):
                    cut[match.start() + 1 : match.end()] = False
                    cut[[match.start(), match.end()]] = True
        return np.flatnonzero(cut)

    def encode(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The ids of packed texts, ``END_ID`` behind each, in one run; the offsets of each text's ids in it."""
        raw = data.tobytes()
        bounds = self._bounds(data, offsets, raw)
        parts, counts = [np.zeros(0, "<u4")], [np.zeros(1, np.int64)]
        for i, j in slices(bounds, GATHERED_BYTES):
            coded = pa.LargeBinaryArray.from_buffers(pa.large_binary(), j - i, [None, pa.py_buffer(bounds[i : j + 1]), pa.py_buffer(raw)]).dictionary_encode()
            index = coded.indices.to_numpy()
            found = self._look_up(coded.dictionary.to_pylist())
            lengths = np.fromiter(map(len, found), np.int64, len(found)) // 4
            starts, sizes = (np.cumsum(lengths) - lengths)[index], lengths[index]
            upto = np.cumsum(sizes)
            flat = np.frombuffer(b"".join(found), "<u4")
            parts.append(flat[np.repeat(starts - upto + sizes, sizes) + np.arange(upto[-1])])
            counts.append(sizes)
        before = np.cumsum(np.concatenate(counts))[np.searchsorted(bounds, offsets)]  # ids before each text
        places = before + np.arange(len(offsets))
        ids = np.full(places[-1], END_ID, "<u4")
        inside = np.ones(places[-1], bool)
        inside[places[1:] - 1] = False
        ids[inside] = np.concatenate(parts)
        return ids, places


@functools.lru_cache(maxsize=2)
def word_ids(path: str) -> WordIds:
    return WordIds(path)


def pieces(docs: DataFrame, path: str, capacity: int = CAPACITY) -> DataFrame:
    """``doc_id, start, length, ids_crc32, doc_tokens``: every document tokenized and cut, end id included."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = word_ids(path)
        for batch in gathered(batches, "text", GATHERED_BYTES):
            ids, bounds = encoder.encode(*packed(as_utf8(column(batch, "text"))))
            raw, bounds = ids.view(np.uint8).data, bounds.tolist()
            owner, starts, lengths, sums, totals = [], [], [], [], []
            for i, (first, last) in enumerate(zip(bounds[:-1], bounds[1:], strict=True)):
                start = first
                for length in cuts(last - first, capacity):
                    owner.append(i)
                    starts.append(start - first)
                    lengths.append(length)
                    sums.append(zlib.crc32(raw[4 * start : 4 * (start + length)]))
                    totals.append(last - first)
                    start += length
            doc_ids = column(batch, "doc_id").take(pa.array(owner, pa.int64()))
            numbers = [pa.array(values, pa.int64()) for values in (starts, lengths, sums, totals)]
            yield pa.RecordBatch.from_arrays([doc_ids, *numbers], ["doc_id", "start", "length", "ids_crc32", "doc_tokens"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {kind}, start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint"
    return docs.select("doc_id", "text").mapInArrow(giving_back(run), schema)


def _number(rows: DataFrame, within: list[str]) -> DataFrame:
    """Adds ``_n``, the piece's number in its group, and ``_full``: whether its sequence is filled."""
    group = Window.partitionBy(*within)
    order = [F.col(c) for c in ("doc_id", "start", "ids_crc32")]
    return (
        rows.withColumn("_n", F.row_number().over(group.orderBy(*order)) - 1)
        .withColumn("_count", F.count("*").over(group))
        .withColumn("_full", F.expr("_n < _count - _count % _class"))
        .drop("_count")
    )


def harmonic(found: DataFrame, capacity: int = CAPACITY, workers: int = WORKERS) -> DataFrame:
    """Adds ``sequence_id`` and ``offset`` to pieces.

    A worker sorts one class of its share. The second round sees fewer than
    ``k`` pieces of class ``k`` from each worker; what it leaves over, fewer than
    ``k`` pieces of each class ``k`` whatever the input's size, is packed by first
    fit, longest first. ``sequence_id`` is made of the class (0: first fit), the
    worker (``workers``: later rounds) and the sequence's number there.
    """
    columns = found.columns
    first = _number(
        found.withColumn("_class", F.expr(f"{capacity} div length")).withColumn(
            "_worker", F.pmod(F.xxhash64("doc_id", "start", "ids_crc32"), F.lit(workers))
        ),
        ["_class", "_worker"],
    )
    second = _number(first.where("not _full").withColumn("_worker", F.lit(workers).cast("bigint")), ["_class"])
    sequence = F.expr(f"((_n div _class) * {workers + 1} + _worker) * {capacity + 1} + _class").cast("bigint")
    filled = first.where("_full").unionByName(second.where("_full")).select(*columns, "_n", sequence.alias("sequence_id"))

    def fit(rows: pa.Table) -> pa.Table:
        lengths = rows.column("length").to_pylist()
        room: list[int] = []
        at = [0] * len(lengths)
        for i in sorted(range(len(lengths)), key=lambda i: (-lengths[i], i)):
            at[i] = next((s for s, free in enumerate(room) if free >= lengths[i]), len(room))
            if at[i] == len(room):
                room.append(capacity)
            room[at[i]] -= lengths[i]
        ids = [(s * (workers + 1) + workers) * (capacity + 1) for s in at]
        return pa.table([*(rows.column(c) for c in columns), pa.array(range(len(ids)), pa.int64()), pa.array(ids, pa.int64())], [*columns, "_n", "sequence_id"])

    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in found.schema)
    fitted = (
        second.where("not _full")
        .select(*columns, F.lit(0).alias("_rest"))
        .groupBy("_rest")
        .applyInArrow(lambda rows: fit(rows.sort_by([(c, "ascending") for c in ("doc_id", "start", "ids_crc32")])), f"{schema}, _n bigint, sequence_id bigint")
    )
    place = Window.partitionBy("sequence_id").orderBy("_n").rowsBetween(Window.unboundedPreceding, -1)
    return (
        filled.withColumn("_n", F.col("_n").cast("bigint"))
        .unionByName(fitted)
        .withColumn("offset", F.coalesce(F.sum("length").over(place), F.lit(0)).cast("bigint"))
        .select(*columns, "sequence_id", "offset")
    )


def pack(docs: DataFrame, path: str, capacity: int = CAPACITY) -> DataFrame:
    """Pieces of all documents in sequences of at most ``capacity`` ids.

    Returns ``doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset``.

    Defined cases: a null or empty text is a document of one id, the end id; a
    null ``doc_id`` stays null; repeated rows are packed once each; further
    columns are ignored; an empty table gives an empty result.
    """
    return harmonic(written(pieces(docs, path, capacity), "pieces"), capacity)
