import json
import random

import brute
import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

from tickloom.llm import pair_index
from tickloom.llm.arrow import packed
from tickloom.llm.pair_index import Merges, encode_decode, load

PATH = public_tokenizers.path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def library():
    tokenizer = Tokenizer.from_file(PATH)
    tokenizer.no_truncation()
    tokenizer.no_padding()
    return tokenizer


def ids_of(some):
    ids, bounds = load(PATH).encode(*packed(pa.array(some, pa.string())))
    return [ids[i:j].tolist() for i, j in zip(bounds[:-1], bounds[1:], strict=True)]


def random_texts(n):
    rng = random.Random(1)
    letters = " \n\t  abcdeéßñ'12.,|s't中　\x1c\x85\xa0 -<>՘࢏"
    return ["".join(rng.choice(letters) for _ in range(rng.randrange(50))) for _ in range(n)]


def test_ids_equal_the_library(library):
    rng = random.Random(2)
    some = random_texts(4000)
    some += ["a<|endoftext|>b <|endoftext|>", "<|endoftext|><|endoftext|>", "<|endof", "text|>", "", "a" * 3000, "\n" * 50 + "x's"]
    some += ["".join(rng.choice("ab") for _ in range(30_000))]  # one pre-token
    expected = [found.ids for found in library.encode_batch(some, add_special_tokens=False)]
    assert ids_of(some) == expected
    bpe = load(PATH)
    for text, ids in zip(some[-300:], expected[-300:], strict=True):
        assert b"".join(bpe.decode(np.asarray(ids, "<u4")).to_pylist()).decode() == library.decode(ids, skip_special_tokens=False) == text


def test_portions_do_not_matter(library, monkeypatch):
    some = random_texts(200)
    expected = ids_of(some)
    monkeypatch.setattr(pair_index, "PORTION", 37)
    monkeypatch.setattr(pair_index, "INDEX_BYTES", 5)
    monkeypatch.setattr(load(PATH), "known", {})
    monkeypatch.setattr(load(PATH), "older", {})
    assert ids_of(some) == expected


def test_merges_must_follow_their_parts():
    vocabulary = {letter: i for i, letter in enumerate(pair_index.byte_characters())} | {"ab": 256, "abc": 257}
    Merges(vocabulary, [("a", "b"), ("ab", "c")], {})
    with pytest.raises(ValueError, match="before one"):
        Merges(vocabulary, [("ab", "c"), ("a", "b")], {})


def test_overlapping_pairs():
    vocabulary = {letter: i for i, letter in enumerate(pair_index.byte_characters())} | {"aa": 256, "aaaa": 257}
    merges = Merges(vocabulary, [("a", "a"), ("aa", "aa")], {})
    a = vocabulary["a"]
    found = [ids.tolist() for ids in merges.encode([b"aaa", b"a", b"aaaaaaa", b"", b"baab"])]
    assert found == [[256, a], [a], [257, 256, a], [], [vocabulary["b"], 256, vocabulary["b"]]]


def test_files_with_unsupported_tokens(tmp_path):
    whole = json.loads(open(PATH, encoding="utf-8").read())
    whole["added_tokens"][0]["lstrip"] = True
    (tmp_path / "t.json").write_text(json.dumps(whole))
    with pytest.raises(ValueError, match="surroundings"):
        pair_index.PairIndexBpe(str(tmp_path / "t.json"))


def test_rows(spark, library):
    rows = [(1, "The cat's  hat.", "x"), (2, "", "x"), (3, None, "x"), (None, "un été", "x"), (1, "The cat's  hat.", "x")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, n_tokens string")
    expected = []
    for doc, text, _ in rows:
        ids = library.encode(text or "", add_special_tokens=False).ids
        expected.append((doc, len(ids), brute.sha(np.asarray(ids, "<u4").tobytes()), brute.sha((text or "").encode())))
    assert sorted(map(tuple, encode_decode(docs, PATH).collect()), key=str) == sorted(expected, key=str)
    assert encode_decode(docs.limit(0), PATH).count() == 0
    # Bytes that are no UTF-8 are replaced before they are encoded.
    broken = spark.sql("SELECT 1L AS doc_id, cast(x'61FF62' AS string) AS text")
    assert encode_decode(broken, PATH).first().decoded_sha256 == brute.sha("a�b".encode())
