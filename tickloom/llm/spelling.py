"""Spelling variants: words of a vocabulary that are one edit apart, grouped under the most frequent form.

The vocabulary is scanned as a sorted list. Edit-matrix rows of all words of a
group against the list's word are kept per depth, within the band of one edit; the
next word goes on from the row at the length of its common prefix with the word before
(LCP), and where no row holds an entry below two edits, the words that share the
prefix so far are skipped.

Words meet in groups that Spark deals out. Around one edit, two words share a
prefix and a suffix that together leave out one character at most; so they
share the first half of the shorter word, or the second half. Every word goes to
both groups, of its own length and of the length one below. Groups above a size are
split by the same rule applied to what their words have between the shared ends.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickloom.llm.arrow import column, packed
from tickloom.llm.runs import FOLD, portions
from tickloom.llm.tables import partitions, written

LEAST_LETTERS = 6
LEAST_COUNT = 5
FACTOR = 5
# One run in so many loses a character.
SLIPS = 199
# Words of a group that is not split any further.
GROUP_WORDS = 4096
# Different words that a task counts before it sends them on.
HELD_WORDS = 1 << 20
# Lengths in bytes for which checksums are put together from parts; longer words are read again.
SHORT = 48
_ENDS = 9  # an edit distance that counts as none


def _letters(data: np.ndarray) -> np.ndarray:
    """Which bytes belong to A-Z, a-z or U+00C0 to U+00FF (0xC3 and what follows it)."""
    lead = data == 0xC3
    inside = lead.copy()
    inside[1:] |= lead[:-1]
    lower = FOLD[data]
    return inside | ((lower >= ord("a")) & (lower <= ord("z")))


_CRC = np.asarray([zlib.crc32(bytes([b])) for b in range(256)], np.uint32)
_STEP = _CRC ^ _CRC[0]  # the linear part of a step over one byte


def shifted(sums: np.ndarray, most: int) -> np.ndarray:
    """Row ``n``: what checksums contribute to those of texts that go on for ``n`` more bytes."""
    out = np.empty((most + 1, len(sums)), np.uint32)
    out[0] = sums
    for n in range(1, most + 1):
        out[n] = (out[n - 1] >> np.uint32(8)) ^ _STEP[out[n - 1] & np.uint32(255)]
    return out


def _without(word: bytes, h: int) -> bytes:
    letters = word.decode()
    i = h % len(letters)
    return (letters[:i] + letters[i + 1 :]).encode()


def words_of(data: np.ndarray, offsets: np.ndarray, ids: list, slips: int) -> Iterator[tuple[pa.Array, np.ndarray]]:
    """Different words and how often each occurs, portion by portion, after the slips.

    A run slips if ``slips`` divides the checksum of ``<id>:<run>``. The checksum
    of two texts in a row is made of both checksums, so it is taken once per
    document and once per different run.
    """
    prefixes = [f"{'null' if i is None else i}:".encode() for i in ids]
    starts = np.fromiter(map(zlib.crc32, prefixes), np.uint32, len(prefixes))
    table = shifted(starts, SHORT)
    for words, index, owner in portions(data, offsets, _letters(data)):
        different = words.to_pylist()
        sums = np.fromiter(map(zlib.crc32, different), np.uint32, len(different))
        lengths = np.fromiter(map(len, different), np.int64, len(different))
        short = lengths[index] <= SHORT
        h = table[np.minimum(lengths[index], SHORT), owner] ^ sums[index]
        slipped = np.flatnonzero((h % np.uint32(slips) == 0) & short)
        hits = [(i, int(h[i])) for i in slipped]
        for i in np.flatnonzero(~short):
            if (x := zlib.crc32(different[index[i]], int(starts[owner[i]]))) % slips == 0:
                hits.append((i, x))
        counts = np.bincount(index, minlength=len(different))
        np.subtract.at(counts, index[[i for i, _ in hits]], 1)
        yield words, counts
        if hits:
            yield pa.array([_without(different[index[i]], x) for i, x in hits], pa.large_binary()), np.ones(len(hits), np.int64)


def vocabulary(docs: DataFrame, least_letters: int = LEAST_LETTERS, least_count: int = LEAST_COUNT, slips: int = SLIPS) -> DataFrame:
    """``word, n``: words of at least so many letters and occurrences over all documents."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.Table] = []

        def merged() -> pa.Table:
            return pa.concat_tables(held).group_by("word").aggregate([("n", "sum")]).rename_columns(["word", "n"])

        def texts(table: pa.Table) -> list[pa.RecordBatch]:
            return table.set_column(0, "word", table.column("word").cast(pa.large_string()).cast(pa.string())).to_batches(max_chunksize=10_000)

        for batch in batches:
            data, offsets = packed(column(batch, "text"))
            for words, counts in words_of(data, offsets, column(batch, "doc_id").to_pylist(), slips):
                table = pa.table({"word": words, "n": pa.array(counts, pa.int64())})
                # Two bytes for a letter at most, so none below this length can have enough of them.
                long = pc.greater_equal(pc.binary_length(table.column("word")), least_letters)
                held.append(table.filter(pc.and_(long, pc.greater(table.column("n"), 0))))
            if sum(map(len, held)) > HELD_WORDS:
                held = [merged()]
                if len(held[0]) > HELD_WORDS // 2:
                    yield from texts(held.pop())
        if held:
            yield from texts(merged())

    counts = docs.select("doc_id", "text").mapInArrow(run, "word string, n bigint").where(F.length("word") >= least_letters)
    return counts.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= least_count)


# --- groups ---------------------------------------------------------------------------


def _halved(rows: DataFrame) -> DataFrame:
    """Every row twice: with a longer shared prefix, and with a longer shared suffix.

    ``size`` is the length of the shorter words of a group, ``head`` and ``tail`` the
    lengths of the shared ends, and ``path`` the choices made so far.
    """
    half = "(size - head - tail) div 2"
    return rows.selectExpr(
        "word", "n", "size",
        f"explode(array(named_struct('head', cast(head + {half} AS int), 'tail', tail, 'path', concat(path, 'L')), "
        f"named_struct('head', head, 'tail', cast(tail + {half} AS int), 'path', concat(path, 'R')))) AS side",
    ).select("word", "n", "size", "side.*")


def groups(words: DataFrame, least_letters: int = LEAST_LETTERS, most: int = GROUP_WORDS) -> DataFrame:
    """Rows ``word, n, size, head, tail, path, key``: words of one ``key`` may be near each other.

    Groups of more than ``most`` words whose words differ in more than two characters are split again, until there are none.
    """
    length = "length(word)"
    rows = words.selectExpr(
        "word", "n", f"explode(filter(array({length}, {length} - 1), x -> x >= {least_letters})) AS size", "0 AS head", "0 AS tail", "'' AS path"
    )
    key = F.concat_ws(
        "|", "size", "path", F.expr("substring(word, 1, head)"), F.expr("substring(word, length(word) - tail + 1, tail)")
    )
    done = None
    while True:
        rows = written(_halved(rows).withColumn("key", key), "groups")
        large = rows.where("size - head - tail > 2").groupBy("key").count().where(F.col("count") > most).select("key")
        if large.isEmpty():
            return rows if done is None else done.unionByName(rows)
        small = rows.join(large, "key", "left_anti")
        done = small if done is None else done.unionByName(small)
        rows = rows.join(large, "key", "left_semi")


# --- the scan -------------------------------------------------------------------------


def scan(middles: list[str], size: int) -> tuple[np.ndarray, np.ndarray]:
    """Pairs (places in ``middles``) of strings that are one edit apart; the first of a pair has ``size`` characters.

    ``middles`` are sorted, all different, and have ``size`` or ``size + 1`` characters. A pair of
    two of ``size`` comes in both directions.

    Row ``i`` of the matrix of a list word against a question holds, in the band, the
    edits from the word's first ``i`` characters to the question's first ``i - 1``, ``i``
    and ``i + 1``. Questions whose row has reached two edits leave.
    """
    letters = np.zeros((len(middles), size + 1), np.int32)
    lengths = np.fromiter(map(len, middles), np.int64, len(middles))
    for length in {size, size + 1}:
        at = np.flatnonzero(lengths == length)
        if len(at) and length:
            joined = "".join(middles[i] for i in at).encode("utf-32-le")
            letters[at, :length] = np.frombuffer(joined, "<i4").reshape(len(at), length)
    same = letters[1:] == letters[:-1]
    common = [0, *np.where(same.all(1), size + 1, same.argmin(1)).tolist()] if len(middles) > 1 else [0]
    asks = np.flatnonzero(lengths == size)
    # Questions by position, with a character that matches nothing before and behind them.
    padded = np.full((size + 4, len(asks)), -1, np.int32)
    padded[1 : size + 1] = letters[asks, :size].T
    start = np.zeros(len(asks), np.int8)
    rows: list[tuple] = [(np.arange(len(asks)), start + _ENDS, start, start + 1)]
    found_asks, found_words = [], []
    skip = size + 2  # words whose common prefix with the word before is this long are passed over
    for k in range(len(middles)):
        if common[k] >= skip:
            continue
        skip = size + 2
        del rows[common[k] + 1 :]
        for i in range(common[k] + 1, int(lengths[k]) + 1):
            letter = letters[k, i - 1]
            alive, a, b, c = rows[-1]
            b_up = b + 1
            na = np.minimum(a + (padded[i - 1][alive] != letter), b_up)
            nb = np.minimum(np.minimum(b + (padded[i][alive] != letter), c + 1), na + 1)
            nc = np.minimum(c + (padded[i + 1][alive] != letter), nb + 1)
            keep = np.flatnonzero((na < 2) | (nb < 2) | (nc < 2))
            if not len(keep):
                skip = i
                break
            rows.append((alive[keep], na[keep], nb[keep], nc[keep]))
        else:
            alive, a, b, _ = rows[-1]
            hits = alive[(b if lengths[k] == size else a) == 1]
            found_asks.append(hits)
            found_words.append(np.full(len(hits), k))
    if not found_asks:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    return asks[np.concatenate(found_asks)], np.concatenate(found_words)


def _steps(size: int, path: str) -> Iterator[tuple[int, int]]:
    """For each choice of the second half: where the first half lay."""
    head = tail = 0
    for side in path:
        half = (size - head - tail) // 2
        if side == "R":
            yield head, head + half
            tail += half
        else:
            head += half


def near_in_group(words: list[str], counts: np.ndarray, size: int, head: int, tail: int, path: str) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Places of words with near words, how many, and the place of the most frequent one (ties: the smallest).

    A pair that shares the first half as well is left to that group, so every pair counts once.
    """
    ask, word = scan([w[head : len(w) - tail] for w in words], size - head - tail)
    for first, last in _steps(size, path):
        parts: dict[str, int] = {}
        part = np.fromiter((parts.setdefault(w[first:last], len(parts)) for w in words), np.int64, len(words))
        apart = part[ask] != part[word]
        ask, word = ask[apart], word[apart]
    longer = np.fromiter(map(len, words), np.int64, len(words))[word] > size
    ask, word = np.concatenate([ask, word[longer]]), np.concatenate([word, ask[longer]])
    order = np.empty(len(words), np.int64)
    order[sorted(range(len(words)), key=words.__getitem__)] = np.arange(len(words))
    order = np.lexsort((order, -counts))  # places from the best to the worst
    grade = np.empty(len(words), np.int64)
    grade[order] = np.arange(len(words))
    best = np.full(len(words), len(words))
    np.minimum.at(best, ask, grade[word])
    number = np.bincount(ask, minlength=len(words))
    held = np.flatnonzero(number)
    return held, number[held], order[best[held]]


def near_words(rows: DataFrame) -> DataFrame:
    """``word, n_near, form, form_n``: per word its near words' number and the most frequent of them, over all groups."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        key = None

        def solved() -> Iterator[pa.RecordBatch]:
            table = pa.Table.from_batches(held)
            if len(table) < 2:
                return
            words = table.column("word").to_pylist()
            counts = table.column("n").to_numpy()
            size, head, tail, path = (table.column(c)[0].as_py() for c in ("size", "head", "tail", "path"))
            at, number, best = near_in_group(words, counts, size, head, tail, path)
            if len(at):
                word = table.column("word").combine_chunks()
                yield pa.RecordBatch.from_arrays(
                    [word.take(pa.array(at)), pa.array(number, pa.int64()), word.take(pa.array(best)), pa.array(counts[best], pa.int64())],
                    ["word", "n_near", "form", "form_n"],
                )

        for batch in batches:
            ends = pc.run_end_encode(column(batch, "key")).run_ends.to_pylist()
            keys = column(batch, "key")
            first = 0
            for last in ends:
                this = keys[first].as_py()
                if this != key:
                    if held:
                        yield from solved()
                    held, key = [], this
                held.append(batch.slice(first, last - first))
                first = last
        if held:
            yield from solved()

    middle = F.expr("substring(word, head + 1, length(word) - head - tail)")
    dealt = rows.repartition(partitions(rows.sparkSession), "key").sortWithinPartitions("key", middle)
    local = dealt.mapInArrow(run, "word string, n_near bigint, form string, form_n bigint")
    best = F.min(F.struct((-F.col("form_n")).alias("n"), "form")).alias("best")
    return local.groupBy("word").agg(F.sum("n_near").alias("n_near"), best).selectExpr("word", "n_near", "best.form AS form", "-best.n AS form_n")


def with_roots(forms: DataFrame, most: int, factor: int, least_count: int) -> DataFrame:
    """Adds ``root``: where following the forms ends.

    A form is ``factor`` (above 1) times as frequent as its word, so chains have a length that the most
    frequent word bounds; every round doubles the distance followed.
    """
    links = forms.where("form IS NOT NULL").select("word", F.col("form").alias("root"))
    steps = max(0, math.floor(math.log(max(most, least_count, 1) / max(least_count, 1), factor)) + 1)
    for _ in range(max(steps - 1, 0).bit_length()):
        links = written(links, "links")
        further = links.select(F.col("word").alias("root"), F.col("root").alias("next"))
        links = links.join(further, "root", "left").select("word", F.coalesce("next", "root").alias("root"))
    return forms.join(links, "word", "left").withColumn("root", F.coalesce("root", "word"))


def variants(
    docs: DataFrame,
    least_letters: int = LEAST_LETTERS,
    least_count: int = LEAST_COUNT,
    factor: int = FACTOR,
    slips: int = SLIPS,
    group_words: int = GROUP_WORDS,
) -> DataFrame:
    """One row per word of the vocabulary: ``word, form, root, n, n_near, form_n``.

    Near words differ by one inserted, deleted or replaced character. ``form`` is the
    near word with the largest ``n`` (ties: the smallest in code-point order) if that is at
    least ``factor`` times the word's, and ``root`` where following forms ends.

    Defined cases: a null text has no words; a null ``doc_id`` takes part in the
    slips like the text "null"; repeated rows count as often as they stand; words of
    any length take part; further columns are ignored; an empty table gives an
    empty result.
    """
    words = written(vocabulary(docs, least_letters, least_count, slips), "vocabulary")
    most = words.agg(F.max("n")).first()[0]
    near = near_words(groups(words, least_letters, group_words))
    frequent = F.col("form_n") >= factor * F.col("n")
    forms = words.join(near, "word", "left").select(
        "word",
        F.when(frequent, F.col("form")).alias("form"),
        "n",
        F.coalesce("n_near", F.lit(0)).cast("bigint").alias("n_near"),
        F.when(frequent, F.col("form_n")).alias("form_n"),
    )
    return with_roots(written(forms, "forms"), most or 0, factor, least_count).select("word", "form", "root", "n", "n_near", "form_n")
