import random

import brute
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tickloom.llm.suffix_dedup import remove_repeats
from tickloom.llm.tables import prepare

SCHEMA = "doc_id bigint, text string, bucket string, what int"


def check(spark, texts, match=100, gram=48):
    docs = spark.createDataFrame([(i, t, "x", 1) for i, t in texts], SCHEMA).repartition(5)
    got = {r.carry.doc_id: r for r in remove_repeats(docs, match, gram).collect()}
    expected = brute.removed([(i, (t or "").encode()) for i, t in texts], match)
    assert got.keys() == expected.keys()
    for doc, text in texts:
        data, gone, row = (text or "").encode(), expected[doc], got[doc]
        assert bytes(row.kept) == bytes(b for b, g in zip(data, gone) if not g), doc
        assert (row.n_bytes, row.n_removed, len(row.spans)) == (len(data), sum(gone), brute.spans(gone))
    return got


def prose(rng, n):
    return " ".join("".join(rng.choice("abcdefgéß\x00") for _ in range(rng.randrange(1, 9))) for _ in range(n))


def test_passages_copies_and_runs(spark):
    rng = random.Random(1)
    shared = [prose(rng, 40) for _ in range(4)]
    texts = [(i, prose(rng, rng.randrange(0, 120)) + rng.choice(shared)[: rng.randrange(60, 200)] + prose(rng, 20)) for i in range(60)]
    texts += [(100, texts[3][1]), (101, texts[3][1] + "!"), (102, "a" * 500), (103, "ab" * 300), (104, ""), (105, None), (106, shared[0][:99])]
    check(spark, texts)


def test_a_common_line_in_very_many_documents(spark):
    """More different phrases of one trigger than are compared together."""
    rng = random.Random(2)
    line = prose(rng, 20)[:80]
    check(spark, [(i, prose(rng, 12) + line + prose(rng, 12)) for i in range(400)])


@pytest.mark.parametrize("match, gram", [(10, 4), (100, 99), (20, 20)])
def test_other_lengths(spark, match, gram):
    rng = random.Random(match)
    check(spark, [(i, "".join(rng.choice("ab ") for _ in range(150))) for i in range(30)], match, gram)


def test_a_text_longer_than_a_piece(spark):
    rng = random.Random(3)
    long = "".join(rng.choice("abcdefghij") for _ in range(1_200_000))
    docs = spark.createDataFrame([(1, long + long[1_048_400:1_048_800], "x", 1), (2, long[500_000:500_300] + "!", "x", 1)], SCHEMA)
    got = {r.carry.doc_id: r for r in remove_repeats(docs).collect()}
    assert [tuple(s) for s in got[1].spans] == [(1_200_000, 1_200_400)]
    assert [tuple(s) for s in got[2].spans] == [(0, 300)] and bytes(got[2].kept) == b"!"


def test_defined_cases(spark):
    text = prose(random.Random(4), 60)
    rows = [(None, text, "x", 1), (5, text, "y", 2), (5, text, "y", 2), (5, "other " + text, "z", 3)]
    got = remove_repeats(spark.createDataFrame(rows, SCHEMA)).select("carry.*", "n_removed", F.size("spans").alias("n")).collect()
    size = len(text.encode())
    # A row without id comes first; rows of one document at the same place do not repeat each other.
    assert sorted((r.doc_id or 0, r.bucket, r.what, r.n_removed) for r in got) == [(0, "x", 1, 0), (5, "y", 2, size), (5, "y", 2, size), (5, "z", 3, size)]
    assert remove_repeats(spark.createDataFrame([], SCHEMA)).count() == 0


def test_whole_characters(spark):
    text = "é" * 60
    rows = [(1, "x" + text, "x", 1), (2, text + "é", "x", 1)]
    row = remove_repeats(spark.createDataFrame(rows, SCHEMA), whole_characters=True).where("carry.doc_id = 2").first()
    bytes(row.kept).decode()


def test_packed_rows_travel_in_small_batches(spark):
    """Rows of many findings: a thousand of them at once took more memory than a task has."""
    rows = prepare(spark).range(0, 40, 1, 1).selectExpr("id", "repeat('x', 1000000) AS packed")

    def sizes(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array([batch.num_rows]), pa.array([batch.nbytes])], ["n", "bytes"])

    found = rows.mapInArrow(sizes, "n bigint, bytes bigint").collect()
    assert sum(r.n for r in found) == 40 and max(r.bytes for r in found) < 6_000_000
