import random

import brute
import numpy as np

from tickloom.llm.fingerprints import SAMPLES, compare_with_edits, edited

SCHEMA = "doc_id bigint, text string, bucket string"


def test_edits_order_and_estimates(spark):
    rng = random.Random(1)
    vocabulary = [f"wörd{i}" for i in range(300)]
    texts = {i * 7: " ".join(rng.choice(vocabulary) for _ in range(rng.randrange(1, 250))) for i in range(150)} | {-5: "", 9000: None}
    docs = spark.createDataFrame([(i, t, "x") for i, t in texts.items()], SCHEMA).repartition(7)
    got = {r.doc_id: r for r in compare_with_edits(docs).collect()}
    order = sorted(texts)
    errors = []
    for doc, following in zip(order, order[1:] + order[:1]):
        text, other, row = texts[doc] or "", texts[following] or "", got[doc]
        changed = edited(text, other)
        n = len(text) // 4
        assert changed == text[: len(text) - n] + other[:n]
        assert (row.n_chars, row.edited_sha256) == (len(text), brute.sha(changed.encode()))
        errors += [row.near_edited - brute.weighted_jaccard(text, changed), row.near_next - brute.weighted_jaccard(text, other)]
    assert len(got) == len(order) and abs(np.mean(errors)) < 0.02 and np.abs(errors).max() < 5 * 0.5 / SAMPLES**0.5


def test_defined_cases(spark):
    rows = [(1, "a b", "x"), (1, "a b", "x"), (2, "A  b", "x"), (None, "c", "x"), (3, None, "x"), (4, "", "x")]
    got = sorted(compare_with_edits(spark.createDataFrame(rows, SCHEMA)).collect(), key=lambda r: (r.doc_id or 0, r.near_next))
    assert len(got) == 6
    prints = {r.doc_id: r.fingerprint for r in got}
    assert prints[1] == prints[2] != prints[None] and set(prints[3]) == set(prints[4]) == {"0"}
    assert [r.near_next for r in got if r.doc_id == 3] == [1.0] and [r.near_next for r in got if r.doc_id == 4] == [0.0]
    alone = compare_with_edits(spark.createDataFrame([(9, "abcdefgh", "x")], SCHEMA)).first()
    assert alone.near_next == 1.0 and alone.edited_sha256 == brute.sha(b"abcdefab")
    assert compare_with_edits(spark.createDataFrame([], SCHEMA)).count() == 0
