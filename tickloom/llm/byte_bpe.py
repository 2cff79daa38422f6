"""Byte-level BPE by a two-tier lookup.

Tier one resolves a whole pre-token that is in the vocabulary with a minimal
perfect hash: ``n`` keys fill ``n`` slots exactly, a slot is reached through the
seed of the key's bucket, and one comparison tells whether the key is really
there. Tier two merges what is not in the vocabulary: the bytes form a linked
list, a heap yields the pair of the lowest rank (ties to the left), and only the
two pairs next to a merge are ranked anew.
"""

from __future__ import annotations

import base64
import functools
import hashlib
import heapq
import itertools
import re
from collections.abc import Iterator

import pyarrow as pa
import regex
import xxhash
from pyspark.sql import DataFrame

from tickloom.llm.arrow import column, texts

# Entries kept of the pieces of text met last, per worker.
MEMO_ENTRIES = 400_000


class MinimalPerfectHash:
    """Vocabulary entries in as many slots as there are entries.

    Buckets are placed from the largest to the smallest; a bucket tries seeds
    until all of its keys fall into free slots.
    """

    def __init__(self, keys: list[bytes], per_bucket: int = 4):
        self.size = len(keys)
        self.buckets = max(1, self.size // per_bucket)
        self.seeds = [0] * self.buckets
        self.keys: list[bytes | None] = [None] * self.size
        grouped: list[list[bytes]] = [[] for _ in range(self.buckets)]
        for key in keys:
            grouped[xxhash.xxh3_64_intdigest(key) % self.buckets].append(key)
        digest, size, placed = xxhash.xxh3_64_intdigest, self.size, self.keys
        for bucket in sorted(range(self.buckets), key=lambda b: -len(grouped[b])):
            seed = 0
            while grouped[bucket]:
                seed += 1
                slots: dict[int, bytes] = {}
                for key in grouped[bucket]:
                    slot = digest(key, seed) % size
                    if placed[slot] is not None or slot in slots:
                        break  # most seeds fail at their first key
                    slots[slot] = key
                else:
                    self.seeds[bucket] = seed
                    for slot, key in slots.items():
                        placed[slot] = key
                    break

    def slot(self, key: bytes) -> int:
        """The key's slot, or -1 if it is not one of the keys."""
        if not self.size:
            return -1
        seed = self.seeds[xxhash.xxh3_64_intdigest(key) % self.buckets]
        slot = xxhash.xxh3_64_intdigest(key, seed) % self.size
        return slot if self.keys[slot] == key else -1


class Memo(dict):
    """What ``make`` gives for a key; of the older entries only those in use are kept."""

    def __init__(self, make, most: int = MEMO_ENTRIES):
        self.make, self.most, self.older = make, most, {}

    def __missing__(self, key):
        value = self.older.get(key)
        if value is None:
            value = self.make(key)
        if len(self) >= self.most:
            self.older = dict(self)
            self.clear()
        self[key] = value
        return value


class ByteBpe:
    """``pattern`` and ``ranks`` as the public rank files give them; no special tokens."""

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        self.pattern = regex.compile(pattern)
        self.table = MinimalPerfectHash(list(ranks))
        self.ids = [ranks[key] for key in self.table.keys]
        self.rank_of = ranks
        self.bytes_of = {rank: key for key, rank in ranks.items()}
        self.name_of = {rank: str(rank) for rank in self.bytes_of}
        self.tokens = Memo(self._pretoken)
        self.pieces = Memo(self._piece)

    def _pretoken(self, pretoken: str) -> tuple[int, ...]:
        raw = pretoken.encode("utf-8", "replace")
        slot = self.table.slot(raw)
        return (self.ids[slot],) if slot >= 0 else tuple(self.merged(raw))

    def merged(self, raw: bytes) -> list[int]:
        """The ids of a pre-token that the vocabulary does not hold as a whole."""
        n, rank, push, pop = len(raw), self.rank_of.get, heapq.heappush, heapq.heappop
        end = list(range(1, n + 1))  # of the part that starts here; 0: swallowed by the part before
        before = list(range(-1, n - 1))
        heap = [(r, i, i + 2) for i in range(n - 1) if (r := rank(raw[i : i + 2])) is not None]
        heapq.heapify(heap)
        while heap:
            _, left, stop = pop(heap)
            right = end[left]
            if not right or right >= n or end[right] != stop:
                continue  # one of the two parts has changed since
            end[left], end[right] = stop, 0
            if stop < n:
                before[stop] = left
                if (r := rank(raw[left : end[stop]])) is not None:
                    push(heap, (r, left, end[stop]))
            if (b := before[left]) >= 0 and (r := rank(raw[b:stop])) is not None:
                push(heap, (r, b, stop))
        ids, i = [], 0
        while i < n:
            ids.append(rank(raw[i : end[i]]))
            i = end[i]
        return ids

    def _piece(self, piece: str) -> tuple[int, ...]:
        tokens = self.pattern.findall(piece)
        if len(tokens) == 1:  # remembered as a piece
            return self._pretoken(tokens[0])
        out: list[int] = []
        for token in tokens:
            out += self.tokens[token]
        return tuple(out)

    def encode(self, text: str) -> list[int]:
        """The ids of a text.

        A text is first cut before every single space that stands between two
        characters that are no white space. A pre-token starts there whatever
        surrounds it, so the pieces can be encoded, and remembered, by themselves.
        """
        first, *pieces = _CUT.split(text)
        return [*self._piece(first), *itertools.chain.from_iterable(map(self.pieces.__getitem__, pieces))]

    def decode(self, ids: list[int]) -> bytes:
        return b"".join(map(self.bytes_of.__getitem__, ids))


_CUT = re.compile(r"(?<=\S)(?= \S)")


@functools.lru_cache(maxsize=4)
def load(path: str, pattern: str) -> ByteBpe:
    """The tokenizer of a rank file, once per worker."""
    with open(path, "rb") as lines:
        pairs = (line.split() for line in lines if line.strip())
        return ByteBpe({base64.b64decode(token): int(rank) for token, rank in pairs}, pattern)


def encode_decode(docs: DataFrame, path: str, pattern: str) -> DataFrame:
    """Per row: ``doc_id, n_tokens, ids_sha256, decoded_sha256``.

    ``path`` names a rank file that is installed on every machine. Texts are
    encoded whole, row by row, without a shuffle.

    Defined cases: a null text is empty (0 tokens, digests of the empty string);
    a null ``doc_id`` stays null; repeated rows give repeated results; further
    columns are ignored; an empty table gives an empty result.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = load(path, pattern)
        for batch in batches:
            counts, ids_digests, text_digests = [], [], []
            for text in texts(batch):
                ids = bpe.encode(text)
                counts.append(len(ids))
                ids_digests.append(hashlib.sha256(",".join(map(bpe.name_of.__getitem__, ids)).encode()).hexdigest())
                text_digests.append(hashlib.sha256(bpe.decode(ids)).hexdigest())
            yield pa.RecordBatch.from_arrays(
                [column(batch, "doc_id"), pa.array(counts, pa.int64()), pa.array(ids_digests, pa.string()), pa.array(text_digests, pa.string())],
                ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"],
            )

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(
        run, f"doc_id {kind}, n_tokens bigint, ids_sha256 string, decoded_sha256 string"
    )
