import base64
import random

import brute
import public_tokenizers
import tiktoken

from tickloom.llm import byte_bpe
from tickloom.llm.byte_bpe import MinimalPerfectHash, encode_decode, load

PATH = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")


def reference():
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(PATH, "rb"))}
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def test_every_key_has_a_slot_of_its_own():
    keys = [str(i).encode() for i in range(3000)]
    table = MinimalPerfectHash(keys)
    assert sorted(table.slot(key) for key in keys) == list(range(3000))
    assert table.slot(b"none") == -1 and MinimalPerfectHash([]).slot(b"x") == -1


def test_ids_equal_the_library():
    rng, bpe, library = random.Random(1), load(PATH, public_tokenizers.PATTERN), reference()
    letters = " \n\t  abcdeéß'12.,|s't中　\x1c\x85 "
    for _ in range(3000):
        text = "".join(rng.choice(letters) for _ in range(rng.randrange(40)))
        ids = bpe.encode(text)
        assert ids == library.encode_ordinary(text), text
        assert bpe.decode(ids).decode() == text
    long = "".join(rng.choice("abc") for _ in range(20_000))
    assert bpe.encode(long) == library.encode_ordinary(long)


def test_rows(spark):
    rows = [(1, "The cat's  hat.", "x"), (2, "", "x"), (3, None, "x"), (None, "un été", "x"), (1, "The cat's  hat.", "x")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, n_tokens string")
    library = reference()
    expected = []
    for doc, text, _ in rows:
        ids = library.encode_ordinary(text or "")
        expected.append((doc, len(ids), brute.sha(",".join(map(str, ids)).encode()), brute.sha((text or "").encode())))
    assert sorted(map(tuple, encode_decode(docs, PATH, public_tokenizers.PATTERN).collect()), key=str) == sorted(expected, key=str)
    assert encode_decode(docs.limit(0), PATH, public_tokenizers.PATTERN).count() == 0


def test_work_is_not_done_twice(monkeypatch):
    """A seed is given up at its first taken slot; a piece of one pre-token is remembered once."""
    calls, digest = [0], byte_bpe.xxhash.xxh3_64_intdigest

    def counted(*args):
        calls[0] += 1
        return digest(*args)

    monkeypatch.setattr(byte_bpe.xxhash, "xxh3_64_intdigest", counted)
    MinimalPerfectHash([str(i).encode() for i in range(3000)])
    assert calls[0] < 250_000  # 406,890 when all keys of a bucket were tried with each seed
    bpe = byte_bpe.ByteBpe({bytes([i]): i for i in range(256)}, r"\w+| \w+|\s+|[^\w\s]+")
    assert bytes(bpe.encode("one two one two, three")) == b"one two one two, three"
    assert set(bpe.pieces) == {" two", " one", " two,", " three"} and set(bpe.tokens) == {" two", ","}
