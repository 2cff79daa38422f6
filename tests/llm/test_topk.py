import random

import brute
import numpy as np
import pytest

from tickloom.llm import topk
from tickloom.llm.topk import top_k

SCHEMA = "vec_id bigint, embedding array<float>, label int"


def found(spark, rows, every=50):
    result = {}
    for r in sorted(top_k(spark.createDataFrame(rows, SCHEMA), every).collect(), key=lambda r: (r.query_id, r["rank"])):
        result.setdefault(r.query_id, []).append((r.vec_id, r.score))
    return result


@pytest.mark.parametrize("kind", ["plain", "ties", "clusters"])
def test_equals_brute_force(spark, kind):
    rng = random.Random(kind)
    values = {"plain": lambda: rng.uniform(-1, 1), "ties": lambda: rng.choice([0.0, 0.5]), "clusters": lambda: rng.choice([-0.3, 0.3]) + rng.gauss(0, 0.01)}[kind]
    rows = [(i, [values() for _ in range(12)], 0) for i in range(700)]
    vectors = {r.vec_id: r.embedding for r in spark.createDataFrame(rows, SCHEMA).collect()}
    expected = {q: brute.top(vectors, q, 5) for q in range(0, 700, 50)}
    assert found(spark, rows) == expected


def test_defined_cases(spark):
    rows = [
        (0, [1.0, 0.0], None), (50, [1.0, 0.0], None), (50, [1.0, 0.0], None),  # a repeated row is one vector
        (1, None, 1), (2, [None, 1.0], 1), (3, [float("nan"), 1.0], 1), (4, [float("inf"), 1.0], 1), (None, [1.0, 1.0], 1),
        (5, [], 1), (6, [0.5], 1),
    ]
    result = found(spark, rows)
    assert result[0] == [(50, 65536), (6, 32768), (5, 0)] and result[50] == [(0, 65536), (6, 32768), (5, 0)]
    assert found(spark, []) == {} and found(spark, [(0, [1.0], 1)]) == {}


def test_components_too_large_for_doubles(spark):
    rows = [(0, [3e12, 1.0], 0), (1, [3e12, 2.0], 0), (2, [3e12, 3.0], 0)]
    limit = 2**63 - 1
    assert found(spark, rows) == {0: [(1, limit), (2, limit)]}
    rows = [(0, [1e7, 1.0], 0), (1, [1e6, 3.0], 0), (2, [1e6, 4.0], 0)]
    vectors = {r.vec_id: r.embedding for r in spark.createDataFrame(rows, SCHEMA).collect()}
    assert found(spark, rows) == {0: brute.top(vectors, 0, 5)}


def test_what_earlier_lists_gave_stops_later_ones(monkeypatch):
    rng = np.random.default_rng(3)
    vectors = rng.integers(-100, 100, (900, 8)).astype(np.float32)
    ids, queries = np.arange(900), vectors[::50]
    monkeypatch.setattr(topk, "LIST_LENGTH", 200)
    monkeypatch.setattr(topk, "TOGETHER", 7)
    scores = vectors @ queries.T
    for q, places, best in topk.search(queries, ids[::50], vectors, ids, 5):
        others = [i for i in range(900) if i != 50 * q]
        assert places.tolist() == sorted(others, key=lambda i: (-scores[i, q], i))[:5]
        assert best.tolist() == scores[places, q].tolist()
    # With a k-th score that nothing here reaches, all stop in the first round and hold nothing.
    read = []
    lists = topk.Lists(vectors)
    monkeypatch.setattr(lists, "read", lambda *a, of=lists.read: read.append(a[3]) or of(*a))
    none = np.full(len(queries), -1)
    unreachable = np.full(len(queries), 1e7, np.float32)
    assert not any(map(len, topk.read_lists(queries, lists, none, 5, unreachable))) and max(read) == 900 // 32
