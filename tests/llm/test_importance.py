import math
import random
import re
import zlib
from collections import Counter
from hashlib import sha256

import numpy as np
import pyarrow as pa
import pytest

from tickloom.llm import importance, runs
from tickloom.llm.arrow import packed
from tickloom.llm.importance import feature_buckets, highest_that_keeps, resample

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = {c: c + 32 for c in range(65, 91)}


def features(text, longest=1):
    words = WORD.findall((text or "").translate(LOWER))
    return [" ".join(words[i : i + n]) for n in range(1, longest + 1) for i in range(len(words) - n + 1)], len(words)


def bucket(feature, buckets):
    return zlib.crc32(feature.encode()) % buckets


def plain(docs, target, percent, least, buckets, longest=1, seed=2024):
    """Rows of (doc_id, n_features, weight, score, rank), with rows of unique ids."""
    corpus, wanted = Counter(), Counter()
    for _, text in docs:
        corpus.update(bucket(f, buckets) for f in features(text, longest)[0])
    for text in target:
        wanted.update(bucket(f, buckets) for f in features(text, longest)[0])
    s, t = sum(corpus.values()), sum(wanted.values())
    rows = []
    for doc, text in docs:
        found, words = features(text, longest)
        gains = [math.floor(1000 * math.log((wanted[b] + 1) * (s + buckets) / ((corpus[b] + 1) * (t + buckets)))) for b in (bucket(f, buckets) for f in found)]
        weight = sum(gains) // len(gains) if gains else 0
        h = int(sha256(f"{seed}:{'null' if doc is None else doc}".encode()).hexdigest()[:8], 16)
        score = weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
        rows.append([doc, len(found), weight, score, words >= least])
    order = sorted((r for r in rows if r[4]), key=lambda r: (-r[3], r[0] is None, r[0] or 0))
    rank = {id(r): i + 1 for i, r in enumerate(order[: percent * len(order) // 100])}
    return sorted(((*r[:4], rank.get(id(r))) for r in rows), key=str)


def corpus(n=400):
    rng = random.Random(3)
    words = ["alpha", "Beta", "été", "x1", "中文", "low", "rare", "Zz"]
    return [(i, " ".join(rng.choice(words) + rng.choice(["", ",", ".", "\n"]) for _ in range(rng.randrange(12)))) for i in range(n)]


@pytest.mark.parametrize("longest", [1, 3])
def test_equals_plain(spark, longest):
    docs = corpus()
    target = ["Beta x1 beta", "", None, "rare low"]
    df = spark.createDataFrame(docs, "doc_id bigint, text string").repartition(5)
    got = resample(df, spark.createDataFrame([(t,) for t in target], "text string"), percent=30, least_words=4, buckets=50, longest=longest)
    assert sorted(map(tuple, got.collect()), key=str) == plain(docs, target, 30, 4, 50, longest)


@pytest.mark.parametrize("longest", [1, 2, 4])
def test_portions_do_not_matter(monkeypatch, longest):
    docs = [text for _, text in corpus(60)] + ["y" * 100 + " a b c"]
    data, offsets = packed(pa.array(docs))

    def counts():
        total, per_text = np.zeros(97, int), np.zeros(len(docs), int)
        for found, owner, _ in feature_buckets(data, offsets, 97, longest):
            total += np.bincount(found, minlength=97)
            per_text += np.bincount(owner, minlength=len(docs))
        return total.tolist(), per_text.tolist()

    whole = counts()
    monkeypatch.setattr(runs.portions, "__defaults__", (7,))
    assert counts() == whole
    assert whole[1] == [len(features(text, longest)[0]) for text in docs]


def test_ties_nulls_repeats_and_other_columns(spark):
    docs = [(7, "a b c", 1)] * 5 + [(None, "a b c", 2)] * 4 + [(3, None, 3), (4, "", 4), (5, "a b c", 5)]
    df = spark.createDataFrame(docs, "doc_id bigint, text string, score int").repartition(3)
    target = spark.createDataFrame([("a",)], "text string")
    rows = resample(df, target, percent=50, least_words=3, buckets=10).collect()
    assert len(rows) == 12
    drawn = sorted((r for r in rows if r.rank), key=lambda r: r.rank)
    assert [r.rank for r in drawn] == [1, 2, 3, 4, 5]
    best = sorted((r for r in rows if r.n_features), key=lambda r: (-r.score, r.doc_id is None, r.doc_id or 0))
    assert [(r.score, r.doc_id) for r in drawn] == [(r.score, r.doc_id) for r in best[:5]]
    assert [(r.doc_id, r.weight, r.rank) for r in rows if r.n_features == 0] in ([(3, 0, None), (4, 0, None)], [(4, 0, None), (3, 0, None)])
    assert resample(df.limit(0), target).count() == 0
    assert resample(df, target.limit(0), percent=100, least_words=1).where("rank is not null").count() == 10


def test_cutoff_by_counts():
    rng = random.Random(5)
    for _ in range(200):
        values = [rng.randrange(-1000, 1000) // rng.choice([1, 50]) for _ in range(rng.randrange(1, 60))]
        want = rng.randrange(1, len(values) + 1)
        jobs = []

        def counts(probes):
            jobs.append(1)
            return [sum(v >= x for v in values) for x in probes]

        assert highest_that_keeps(min(values), max(values), want, counts) == sorted(values, reverse=True)[want - 1]
        assert len(jobs) <= 4
    assert importance.PROBES == 15
