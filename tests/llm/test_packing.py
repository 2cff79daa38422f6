import random
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

from tickloom.llm.arrow import packed
from tickloom.llm.packing import CAPACITY, WordIds, cuts, pack

PATH = public_tokenizers.path("word_bpe_49k.json")
SCHEMA = "doc_id bigint, text string, start string"


@pytest.mark.parametrize("length", [1, 2, 63, 64, 65, 1023, 1024, 1025, 2047, 2048, 2049, 10_000])
def test_cuts_cover_a_document(length):
    parts = cuts(length)
    assert sum(parts) == length and all(0 < part <= CAPACITY for part in parts)


def test_ids_equal_the_library():
    rng, mine, library = random.Random(1), WordIds(PATH), Tokenizer.from_file(PATH)
    letters = " \n\t  abcdeéßΣİ'12.,|s't中　\x1c\x85̈"
    texts = ["".join(rng.choice(letters) for _ in range(rng.randrange(40))) for _ in range(3000)] + ["a <|endoftext|> b<|startoftext|>c"]
    ids, bounds = mine.encode(*packed(pa.array(texts)))
    for text, first, last in zip(texts, bounds[:-1], bounds[1:], strict=True):
        assert ids[first:last].tolist() == [*library.encode(text, add_special_tokens=False).ids, 1], text


def test_every_id_is_in_one_piece_and_padding_is_small(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text")
    library = Tokenizer.from_file(PATH)
    ids = {r.doc_id: library.encode(r.text, add_special_tokens=False).ids + [1] for r in docs.collect()}
    got = pack(docs, PATH).collect()
    places: dict[int, list] = {}
    for r in got:
        places.setdefault(r.doc_id, []).append((r.start, r.length))
        part = np.asarray(ids[r.doc_id][r.start : r.start + r.length], "<u4").tobytes()
        assert r.ids_crc32 == zlib.crc32(part) and r.doc_tokens == len(ids[r.doc_id])
    for doc, parts in places.items():
        at = 0
        for start, length in sorted(parts):
            assert start == at
            at += length
        assert at == len(ids[doc])
    assert places.keys() == ids.keys()
    sequences: dict[int, list] = {}
    for r in got:
        sequences.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for parts in sequences.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= CAPACITY
    total = sum(map(len, ids.values()))
    assert len(sequences) * CAPACITY < 1.05 * total


def test_defined_cases(spark):
    rows = [(1, None, "x"), (2, "", "x"), (None, "word", "x"), (3, "same", "x"), (3, "same", "x"), (4, "a " * 30_000, "x")]
    got = pack(spark.createDataFrame(rows, SCHEMA), PATH).collect()
    assert sum(r.length for r in got) == 1 + 1 + 2 + 2 + 2 + 30_001
    assert {r.doc_tokens for r in got if r.doc_id in (1, 2)} == {1}
    assert len({(r.sequence_id, r.offset) for r in got}) == len(got)
    assert pack(spark.createDataFrame([], SCHEMA), PATH).count() == 0
