import random

import brute
import numpy as np
import pytest

from tickloom.llm.components import components
from tickloom.llm.jaccard_join import exact_links, join_components
from tickloom.llm.set_keys import bands_of, keys_of, sketch

SCHEMA = "doc_id bigint, text string, component_id string"


@pytest.mark.parametrize("threshold", [60, 80, 90])
def test_similar_sets_share_a_key(threshold):
    """Sets just at the threshold, of all sizes, differing by insertions, deletions or both."""
    rng = np.random.default_rng(threshold)
    for size in [*range(1, 60), 100, 150, 333, 550, 1200, 5000]:
        for _ in range(6):
            a = np.unique(rng.integers(0, 2**64, size, np.uint64))
            for share in (0.0, 0.5, 1.0):
                gone = fresh = 0
                while True:  # as many differences as the threshold allows
                    more = (gone + 1, fresh) if rng.random() < share else (gone, fresh + 1)
                    if len(a) - more[0] < 1 or 100 * (len(a) - more[0]) < threshold * (len(a) + more[1]):
                        break
                    gone, fresh = more
                if not gone + fresh:
                    continue
                b = np.unique(np.r_[rng.permutation(a)[gone:], rng.integers(0, 2**64, fresh, np.uint64)])
                assert np.intersect1d(keys_of(a, threshold), keys_of(b, threshold)).size, (size, gone, fresh)
                assert np.abs(sketch(a) - sketch(b)).sum() <= gone + fresh


def test_bands_meet_every_possible_partner():
    for threshold in (80, 90):
        for size in range(1, 400):
            for other in range(size, 100 * size // threshold + 1):
                if (100 - threshold) * (size + other) // (100 + threshold):
                    assert set(bands_of(size, threshold)) & set(bands_of(other, threshold))


def near_copies(rng, n, size):
    base = [f"w{rng.randrange(10**6)}" for _ in range(size)]
    out = []
    for _ in range(n):
        text = list(base)
        for _ in range(rng.randrange(0, 6)):
            text[rng.randrange(size)] = f"x{rng.randrange(10**6)}"
        out.append(" ".join(text))
    return out


@pytest.mark.parametrize("words, threshold", [(3, 90), (5, 80), (1, 60)])
def test_equals_brute_force(spark, words, threshold):
    rng = random.Random(words)
    texts = [t for size in (1, 2, 4, 9, 20, 60, 200) for t in near_copies(rng, 25, size)]
    texts += ["", None, " \t ", "One", "one", "ONE two", "a b c d e f g h", "b c d e f g h a"]
    rows = dict(enumerate(rng.sample(texts, len(texts))))
    docs = spark.createDataFrame([(i, t, "x") for i, t in rows.items()], SCHEMA).repartition(6)
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in join_components(docs, words, threshold).collect()}
    assert got == brute.components(rows, words, threshold)


def test_large_groups(spark):
    """More near copies than a key keeps in a chunk, and exact copies."""
    rng = random.Random(9)
    texts = near_copies(rng, 300, 120) + ["same text of five words"] * 200 + near_copies(rng, 30, 500)
    rows = dict(enumerate(rng.sample(texts, len(texts))))
    docs = spark.createDataFrame([(i, t, "x") for i, t in rows.items()], SCHEMA)
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in join_components(docs, 3, 90).collect()}
    assert got == brute.components(rows, 3, 90)


def test_thinned_keys_across_chunks(spark):
    """A passage that many documents of two chunks share; a linked pair is hidden behind the first documents of its keys."""

    def own(n):
        return " ".join(f"w{rng.randrange(10**6)}" for _ in range(n))

    rng = random.Random(3)
    passage = own(1052)
    rows = {100 * chunk + i: f"{passage} {own(140 if i < 60 else 40)}" for chunk in (0, 1) for i in range(61)}
    docs = spark.createDataFrame([(i, t, "x") for i, t in rows.items()], SCHEMA).repartitionByRange(2, "doc_id").sortWithinPartitions("doc_id")
    got = {r.doc_id: r.component_id for r in join_components(docs, 3, 90).collect()}
    expected = {doc: component for doc, (_, component) in brute.components(rows, 3, 90).items()}
    assert got == expected and expected[160] == 60


def test_defined_cases(spark):
    rows = [(None, "a b c d", "x"), (7, "a b c d", "x"), (7, "a b c d", "x"), (9, "a b c d", "x"), (8, None, "x"), (6, "", "x")]
    got = sorted(map(tuple, join_components(spark.createDataFrame(rows, SCHEMA), 3, 90).collect()), key=str)
    assert got == sorted([(None, 2, None), (7, 2, 7), (7, 2, 7), (9, 2, 7), (8, 0, 8), (6, 0, 6)], key=str)
    assert join_components(spark.createDataFrame([], SCHEMA)).count() == 0


def test_links_across_blocks():
    rng = np.random.default_rng(5)
    base = np.unique(rng.integers(0, 2**64, 40, np.uint64))
    sets = [base, base[1:], base[20:], np.sort(np.r_[base[:-1], np.uint64(5)])]
    ids, side = np.array([10, 11, 12, 13]), np.array([0, 1, 1, 0])
    assert exact_links(ids, sets, side, False, 90) == [(10, 11), (10, 13)]
    assert exact_links(ids, sets, side, True, 90) == [(10, 11), (13, 11)]


def test_components_of_chains_and_stars(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, 100 + i) for i in range(1, 50)] + [(7, 7), (300, 200)]
    got = {r.node: r.component for r in components(spark.createDataFrame(edges, "a bigint, b bigint")).collect()}
    assert got == {**dict.fromkeys(range(41), 0), **dict.fromkeys(range(100, 150), 100), 200: 200, 300: 200}


def thue_morse(letters: int) -> str:
    word = "a"
    while len(word) < letters:
        word += word.translate(str.maketrans("ab", "ba"))
    return word


@pytest.mark.parametrize("letters", [1024, 2048, 4096])
def test_words_built_to_collide_stay_apart(spark, letters):
    word = thue_morse(letters)
    other = word.translate(str.maketrans("ab", "ba"))
    rows = [(1, word), (2, other), (3, f"x {word} y z"), (4, f"x {other} y z"), (5, f"x {word} y z")]
    got = {r.doc_id: r.component_id for r in join_components(spark.createDataFrame(rows, "doc_id bigint, text string"), 3, 90).collect()}
    assert got == {1: 1, 2: 2, 3: 3, 4: 4, 5: 3}


def test_rows_of_one_id_are_one_document(spark):
    rng = random.Random(8)
    a, b, c, d = (" ".join(f"w{rng.randrange(500)}" for _ in range(80)) for _ in range(4))
    near = c + " tail"
    rows = [(5, a), (5, b), (3, b), (7, a), (9, c), (9, d), (11, near), (12, d), (20, "only this one text here")]
    got = {(r.doc_id, r.component_id) for r in join_components(spark.createDataFrame(rows, "doc_id bigint, text string").repartition(3), 3, 90).collect()}
    assert got == {(5, 3), (3, 3), (7, 3), (9, 9), (11, 9), (12, 9), (20, 20)}
