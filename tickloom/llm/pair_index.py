"""BPE by an index of pair occurrences.

The different pieces of text of a portion are laid out as one run of symbols in
linked lists, one list per pre-token. An index holds, for each pair that a merge
is known for, all places where it stands. The pair of the lowest rank that is
active is merged at all of its places at once, in every pre-token; the pairs that
come to stand next to these places are added to the lists of their ranks. A place
that a merge has changed in the meantime is passed over when its pair's turn comes.

Merging all places of a pair before the next pair gives what each pre-token
by itself would come to, as a merge's parts are always made by merges of lower rank
(``Merges`` checks that).
"""

from __future__ import annotations

import functools
import hashlib
import heapq
import json
import re
import unicodedata
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from tokenizers.pre_tokenizers import ByteLevel

from tickloom.llm.arrow import column, packed, slices
from tickloom.llm.runs import as_utf8, gathered

# Bytes of different pieces that are merged in one index; a longer pre-token is one by itself.
INDEX_BYTES = 1 << 22
# Different pieces remembered per worker.
MEMO_ENTRIES = 400_000
# Bytes of texts worked on at once; a text may lie in several portions.
PORTION = 1 << 23
# The pre-tokens of byte-level tokenizers (fixed value of the format), for three classes of characters.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?{letter}+| ?{digit}+| ?{sign}+|\s+(?!\S)|\s+"


def newer_characters() -> set[str]:
    """Characters that the pattern library calls letters or digits and the tokenizer library, of an older Unicode version, does not.

    They are among those that Python's own tables do not know yet. The tokenizer
    library tells by joining a letter to a letter and a digit to a digit.
    """
    unassigned = "".join(c for c in map(chr, range(0x110000)) if unicodedata.category(c) == "Cn")
    split = ByteLevel(add_prefix_space=False).pre_tokenize_str
    return {c for before, kind in (("a", r"\p{L}"), ("1", r"\p{N}")) for c in regex.findall(kind, unassigned) if len(split(before + c)) > 1}


def pretoken_pattern(newer: set[str]) -> regex.Pattern:
    """The pattern by which characters of ``newer`` are signs."""
    letter, digit, sign = r"\p{L}", r"\p{N}", r"[^\s\p{L}\p{N}]"
    if newer:
        signs = "[" + "".join(map(regex.escape, sorted(newer))) + "]"
        letter, digit, sign = rf"[\p{{L}}--{signs}]", rf"[\p{{N}}--{signs}]", rf"[{sign}||{signs}]"
    return regex.compile(PATTERN.format(letter=letter, digit=digit, sign=sign), regex.V1)


def byte_characters() -> list[str]:
    """The character that stands for each byte in vocabulary files: printable Latin-1 ones for themselves, the others from 256 on."""
    plain = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    others = [b for b in range(256) if b not in plain]
    return [chr(b) if b in plain else chr(256 + others.index(b)) for b in range(256)]


class Merges:
    """Vectorised look-up of ``(left, right) -> rank, result`` and of the bytes of ids."""

    def __init__(self, vocabulary: dict[str, int], merges: list[tuple[str, str]], extra: dict[str, int]):
        letters = byte_characters()
        number = {letter: b for b, letter in enumerate(letters)}
        self.size = max([*vocabulary.values(), *extra.values()]) + 1
        self.bytes_of: list[bytes] = [b""] * self.size
        for token, id_ in vocabulary.items():
            self.bytes_of[id_] = bytes(map(number.__getitem__, token))
        for token, id_ in extra.items():
            self.bytes_of[id_] = token.encode()
        self.first = np.asarray([vocabulary[letter] for letter in letters], np.int64)
        triples = [(vocabulary[a], vocabulary[b], vocabulary[a + b]) for a, b in merges]
        self.left, self.right, self.result = np.asarray(triples, np.int64).reshape(-1, 3).T
        made = np.full(self.size, -1)
        np.maximum.at(made, self.result, np.arange(len(triples)))
        if (np.maximum(made[self.left], made[self.right]) >= np.arange(len(triples))).any():
            raise ValueError("a merge comes before one that makes its parts")
        keys = self.left * self.size + self.right
        self.rank = np.argsort(keys, kind="stable")
        self.keys = keys[self.rank]

    def ranks(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """The rank of each pair, -1 where there is no merge."""
        wanted = left * self.size + right
        at = np.minimum(np.searchsorted(self.keys, wanted), len(self.keys) - 1)
        return np.where(self.keys[at] == wanted, self.rank[at], -1)

    def encode(self, pretokens: list[bytes]) -> list[np.ndarray]:
        """The ids of each pre-token."""
        lengths = np.fromiter(map(len, pretokens), np.int64, len(pretokens))
        data = np.frombuffer(b"".join(pretokens), np.uint8)
        symbol = self.first[data]
        after, before = np.arange(1, len(data) + 1), np.arange(-1, len(data) - 1)
        ends = np.cumsum(lengths)
        after[ends[lengths > 0] - 1] = -1
        before[(ends - lengths)[lengths > 0]] = -1

        index: dict[int, list[np.ndarray]] = {}  # rank -> places of the left part, some of them out of date
        active: list[int] = []

        def add(places: np.ndarray) -> None:
            """Enter the pairs that begin at these places."""
            rank = self.ranks(symbol[places], symbol[after[places]])
            places, rank = places[rank >= 0], rank[rank >= 0]
            if not len(rank):
                return
            order = np.argsort(rank, kind="stable")
            places, rank = places[order], rank[order]
            cuts = np.flatnonzero(rank[1:] != rank[:-1]) + 1
            for value, part in zip(rank[np.append(0, cuts)].tolist(), np.split(places, cuts), strict=True):
                if value not in index:
                    index[value] = []
                    heapq.heappush(active, value)
                index[value].append(part)

        add(np.flatnonzero(after >= 0))
        while active:
            rank = heapq.heappop(active)
            at = np.sort(np.concatenate(index.pop(rank)))
            at = at[np.append(True, at[1:] != at[:-1])]
            a, b = self.left[rank], self.right[rank]
            at = at[(symbol[at] == a) & (after[at] >= 0)]
            at = at[symbol[after[at]] == b]
            if a == b and len(at) > 1:
                # In a run of one symbol the pairs overlap: every second place, from the left.
                linked = np.append(False, after[at[:-1]] == at[1:])
                heads = np.flatnonzero(~linked)
                inside = np.arange(len(at)) - np.repeat(heads, np.diff(np.append(heads, len(at))))
                at = at[inside % 2 == 0]
            if not len(at):
                continue
            swallowed = after[at]
            symbol[at], symbol[swallowed] = self.result[rank], -1
            follows = after[swallowed]
            after[at] = follows
            before[follows[follows >= 0]] = at[follows >= 0]
            left = before[at]
            add(np.concatenate([left[left >= 0], at[follows >= 0]]))
        alive = symbol >= 0
        counts = np.append(0, np.cumsum(alive))
        ids = symbol[alive].astype("<u4")
        return [ids[i:j] for i, j in zip(counts[ends - lengths].tolist(), counts[ends].tolist(), strict=True)]


# Classes of bytes between which a pre-token always ends (0: not told by the byte alone).
_CLASS = np.zeros(256, np.uint8)
_CLASS[0x21:0x7F] = 3
_CLASS[ord("0") : ord("9") + 1] = 2
_CLASS[ord("A") : ord("Z") + 1] = _CLASS[ord("a") : ord("z") + 1] = 1
_CLASS[ord("'")] = 0
_SPACE = np.zeros(256, bool)
_SPACE[[0x09, 0x0A, 0x0D, 0x20]] = True
_PRINTED = np.zeros(256, bool)
_PRINTED[0x21:0x7F] = True
_PAIR_LEAD = np.zeros(256, bool)
_PAIR_LEAD[0xC3:0xE0] = True  # lead bytes of two; no white space among their characters


def piece_starts(data: np.ndarray) -> np.ndarray:
    """Flags of bytes before which a pre-token ends, whatever stands elsewhere.

    These are places between letters, digits and signs (apostrophes apart), places
    before white space, and places behind a line break or tab that stands by itself. In
    between there may be more ends; the pattern finds them in the pieces.
    """
    kind, space = _CLASS[data], _SPACE[data]
    cut = np.zeros(len(data), bool)
    if len(data) < 2:
        return cut
    cut[1:] = (kind[1:] != kind[:-1]) & (kind[1:] > 0) & (kind[:-1] > 0)
    seen = _PRINTED[data]  # the byte ends a character that is no white space
    seen[1:] |= _PAIR_LEAD[data[:-1]]
    cut[1:] |= space[1:] & seen[:-1]
    alone = cut & space & (data != 0x20)
    cut[1:] |= alone[:-1] & (_PRINTED | _PAIR_LEAD)[data[1:]]
    return cut


class PairIndexBpe:
    """A byte-level BPE tokenizer file; its added tokens are matched in texts first, as its library does."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            whole = json.load(file)
        model, added = whole["model"], whole.get("added_tokens", [])
        if any(token[flag] for token in added for flag in ("single_word", "lstrip", "rstrip")):
            raise ValueError("added tokens that depend on their surroundings are not supported")
        merges = [tuple(m.split(" ", 1)) if isinstance(m, str) else tuple(m) for m in model["merges"]]
        self.merges = Merges(model["vocab"], merges, {token["content"]: token["id"] for token in added})
        self.added = {token["content"].encode(): np.asarray([token["id"]], "<u4").tobytes() for token in added}
        longest_first = sorted(self.added, key=lambda token: (-len(token), token))
        self.find_added = re.compile(b"|".join(map(re.escape, longest_first))) if added else None
        self.newer = newer_characters()
        self.pattern, self.exact = pretoken_pattern(set()), pretoken_pattern(self.newer)
        self.tokens = pa.array(self.merges.bytes_of, pa.large_binary())
        self.known: dict[bytes, bytes] = {}
        self.older: dict[bytes, bytes] = {}

    def _pretokens(self, piece: bytes) -> list[bytes]:
        if piece.isalpha() or piece[:1] == b" " and piece[1:].isalpha():  # ASCII letters alone
            return [piece]
        text = piece.decode()
        pattern = self.pattern if piece.isascii() or self.newer.isdisjoint(text) else self.exact
        return [token.encode() for token in pattern.findall(text)]

    def _learn(self, pieces: list[bytes]) -> Iterator[tuple[bytes, bytes]]:
        """Pieces and their ids, merged together in indexes of bounded size."""
        at = 0
        while at < len(pieces):
            split, size, first = [], 0, at
            while at < len(pieces) and (size < INDEX_BYTES or at == first):
                split.append(self._pretokens(pieces[at]))
                size += len(pieces[at])
                at += 1
            different = dict.fromkeys(token for tokens in split for token in tokens)
            ids = dict(zip(different, (found.tobytes() for found in self.merges.encode(list(different))), strict=True))
            for piece, tokens in zip(pieces[first:at], split, strict=True):
                yield piece, b"".join(map(ids.__getitem__, tokens))

    def _look_up(self, pieces: list[bytes]) -> list[bytes]:
        """The ids of different pieces; those that are not remembered are merged together."""
        if len(self.known) > MEMO_ENTRIES:
            self.older, self.known = self.known, {}
        found = [self.added.get(piece) or self.known.get(piece) or self.older.get(piece) for piece in pieces]
        fresh = dict(self._learn([piece for piece, ids in zip(pieces, found, strict=True) if ids is None]))
        found = [fresh[piece] if ids is None else ids for piece, ids in zip(pieces, found, strict=True)]
        self.known.update(zip(pieces, found, strict=True))
        return found

    def encode(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The ids of packed texts in one run, and the offsets of each text's ids in it."""
        raw = data.tobytes()
        cut = np.zeros(len(data) + 1, bool)
        for at in range(0, len(data), PORTION):
            cut[at : min(at + PORTION, len(data))] = piece_starts(data[max(at - 3, 0) : at + PORTION])[min(at, 3) :]
        cut[offsets] = True
        if self.find_added:
            for first, last in zip(offsets[:-1].tolist(), offsets[1:].tolist(), strict=True):
                for match in self.find_added.finditer(raw, first, last):
                    cut[match.start() + 1 : match.end()] = False
                    cut[[match.start(), match.end()]] = True
        bounds = np.flatnonzero(cut)
        ids, counts = [np.zeros(0, "<u4")], [np.zeros(1, np.int64)]
        for i, j in slices(bounds, PORTION):
            part = pa.LargeBinaryArray.from_buffers(pa.large_binary(), j - i, [None, pa.py_buffer(bounds[i : j + 1]), pa.py_buffer(raw)])
            coded = part.dictionary_encode()
            index = coded.indices.to_numpy()
            found = self._look_up(coded.dictionary.to_pylist())
            lengths = np.fromiter(map(len, found), np.int64, len(found)) // 4
            starts, sizes = (np.cumsum(lengths) - lengths)[index], lengths[index]
            upto = np.cumsum(sizes)
            flat = np.frombuffer(b"".join(found), "<u4")
            ids.append(flat[np.repeat(starts - upto + sizes, sizes) + np.arange(upto[-1])])
            counts.append(sizes)
        totals = np.cumsum(np.concatenate(counts))  # ids before each bound
        return np.concatenate(ids), totals[np.searchsorted(bounds, offsets)]

    def decode(self, ids: np.ndarray) -> pa.Array:
        """The bytes of each id; together those of the text."""
        return self.tokens.take(pa.array(ids))


@functools.lru_cache(maxsize=2)
def load(path: str) -> PairIndexBpe:
    """The tokenizer of a file, once per worker."""
    return PairIndexBpe(path)


def encode_decode(docs: DataFrame, path: str) -> DataFrame:
    """Per row: ``doc_id, n_tokens, ids_sha256, decoded_sha256``.

    ``path`` names a tokenizer file that is installed on every machine. Texts are
    encoded whole, a partition's batch at a time, without a shuffle. Added tokens that stand
    in a text are one id, as in the file's library.

    Defined cases: a null text is empty (0 tokens, digests of nothing); a null
    ``doc_id`` stays null; repeated rows give repeated results; further columns
    are ignored; an empty table gives an empty result.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = load(path)
        for batch in gathered(batches, "text", PORTION):
            raw, ends = packed(as_utf8(column(batch, "text")))
            ids, bounds = bpe.encode(raw, ends)
            decoded, text_bounds = packed(bpe.decode(ids))
            text_bounds, decoded, raw_ids = text_bounds[bounds].tolist(), decoded.data, ids.view(np.uint8).data
            counts, ids_digests, text_digests = np.diff(bounds), [], []
            bounds = (bounds * 4).tolist()
            for i in range(batch.num_rows):
                ids_digests.append(hashlib.sha256(raw_ids[bounds[i] : bounds[i + 1]]).hexdigest())
                text = decoded[text_bounds[i] : text_bounds[i + 1]]
                text_digests.append(hashlib.sha256(text).hexdigest())
            yield pa.RecordBatch.from_arrays(
                [column(batch, "doc_id"), pa.array(counts), pa.array(ids_digests, pa.string()), pa.array(text_digests, pa.string())],
                ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"],
            )

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {kind}, n_tokens bigint, ids_sha256 string, decoded_sha256 string")
