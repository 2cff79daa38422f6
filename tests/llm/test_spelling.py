import random
import re
import zlib
from collections import Counter

import pyarrow as pa
import pytest

from tickloom.llm import runs, spelling
from tickloom.llm.arrow import packed
from tickloom.llm.spelling import scan, variants, words_of

RUN = re.compile("[A-Za-zÀ-ÿ]+")
LOWER = {c: c + 32 for c in range(65, 91)}


def counted(docs, slips=199):
    counts = Counter()
    for doc, text in docs:
        for run in RUN.findall(text or ""):
            run = run.translate(LOWER)
            h = zlib.crc32(f"{'null' if doc is None else doc}:{run}".encode())
            if h % slips == 0:
                i = h % len(run)
                run = run[:i] + run[i + 1 :]
            counts[run] += 1
    return counts


def one_edit(a, b):
    if a == b or abs(len(a) - len(b)) > 1:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    short, long = sorted((a, b), key=len)
    return any(long[:i] + long[i + 1 :] == short for i in range(len(long)))


def plain(docs, least_letters=6, least_count=5, factor=5, slips=199):
    n = {w: c for w, c in counted(docs, slips).items() if len(w) >= least_letters and c >= least_count}
    near = {w: [v for v in n if one_edit(w, v)] for w in n}
    form = {}
    for w, others in near.items():
        best = min(others, key=lambda v: (-n[v], v), default=None)
        form[w] = best if best is not None and n[best] >= factor * n[w] else None

    def root(w):
        while form[w] is not None:
            w = form[w]
        return w

    return sorted((w, form[w], root(w), n[w], len(near[w]), n.get(form[w])) for w in n)


def sample(seed=1, n=300):
    rng = random.Random(seed)
    base = ["colour", "Grüßen", "separate", "nación", "aaaaaa", "abababab", "preceding", "ÀÉÿ÷×þ", "x" * 60]
    docs = []
    for i in range(n):
        words = []
        for _ in range(rng.randrange(30)):
            word = rng.choice(base[: 1 + rng.randrange(len(base))])
            if rng.random() < 0.4:
                at, c = rng.randrange(len(word)), rng.choice("aeé")
                word = rng.choice([word[:at] + word[at + 1 :], word[:at] + c + word[at:], word[:at] + c + word[at + 1 :]])
            words.append(word)
        docs.append((i, rng.choice([" ", ", ", "1"]).join(words)))
    return docs


@pytest.mark.parametrize("group_words", [4096, 6, 1])
def test_equals_plain(spark, group_words):
    docs = sample()
    df = spark.createDataFrame(docs, "doc_id bigint, text string").repartition(4)
    got = variants(df, least_count=2, factor=2, slips=7, group_words=group_words)
    expected = plain(docs, least_count=2, factor=2, slips=7)
    assert sorted(map(tuple, got.collect())) == expected and len(expected) > 100


def test_scan_equals_plain():
    rng = random.Random(4)
    for _ in range(150):
        size = rng.randrange(1, 7)
        words = sorted({"".join(rng.choice("abcÿ") for _ in range(size + rng.randrange(2))) for _ in range(rng.randrange(1, 60))})
        asks, found = scan(words, size)
        expected = {(i, j) for i, a in enumerate(words) for j, b in enumerate(words) if len(a) == size and one_edit(a, b)}
        pairs = list(zip(asks.tolist(), found.tolist(), strict=True))
        assert len(pairs) == len(set(pairs)) and set(pairs) == expected


@pytest.mark.parametrize("portion", [1 << 21, 5])
def test_words_and_slips(monkeypatch, portion):
    monkeypatch.setattr(runs.portions, "__defaults__", (portion,))
    docs = [*sample(2, 60), (None, "Colour Ābc×d Ÿ " + "y" * 200), (-3, None), (9, "")]
    counts = Counter()
    data, offsets = packed(pa.array([text for _, text in docs]))
    for words, n in words_of(data, offsets, [doc for doc, _ in docs], 3):
        for word, count in zip(words.to_pylist(), n.tolist(), strict=True):
            counts[word.decode()] += count
    assert +counts == counted(docs, 3)


def test_defined_cases(spark):
    docs = [(None, "colour color colour", 1)] * 3 + [(5, None, 2), (6, "", 3), (7, "colours " * 40 + "coĺour", 4)]
    df = spark.createDataFrame(docs, "doc_id bigint, text string, word int")
    rows = [(doc, text) for doc, text, _ in docs]
    assert sorted(map(tuple, variants(df).collect())) == plain(rows)
    assert variants(df.limit(0)).count() == 0
    assert spelling.FACTOR == 5
