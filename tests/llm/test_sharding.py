import zlib
from collections import Counter

from tickloom.llm.sharding import interleave

SCHEMA = "doc_id bigint, text string, source string, shard string"


def test_shards_are_even_and_have_the_mixture(spark):
    rows = [(i, f"text {i}", "hot" if i % 3 == 0 else f"s{i % 7}", "x") for i in range(2400)]
    got = interleave(spark.createDataFrame(rows, SCHEMA).repartition(5)).collect()
    assert sorted(r.doc_id for r in got) == list(range(2400))
    sources = {i: s for i, _, s, _ in rows}
    whole = Counter(sources.values())
    for shard in range(24):
        own = [r for r in got if r.shard == shard]
        assert len(own) == 100 and sorted(r.slot for r in own) == list(range(100))
        for source, n in Counter(sources[r.doc_id] for r in own).items():
            assert abs(n - whole[source] / 24) <= 2, (shard, source)
    row = next(r for r in got if r.doc_id == 17)
    assert (row["size"], row.text_crc32, row.law, row.grown_shard) == (8 + len("text 17"), zlib.crc32(b"text 17"), "rows", None)


def test_defined_cases(spark):
    rows = [(1, "é", None, "x"), (1, "é", None, "x"), (None, None, "a", "x"), (2, "", "", "x"), (3, "long" * 50_000, "a", "x")]
    got = interleave(spark.createDataFrame(rows, SCHEMA)).collect()
    assert sorted(r["size"] for r in got) == [8, 8, 10, 10, 200_008] and all(r.slot == 0 for r in got)
    assert len({r.shard for r in got}) == 5
    again = interleave(spark.createDataFrame(rows, SCHEMA).repartition(3)).collect()
    assert sorted(map(str, again)) == sorted(map(str, got))
    assert interleave(spark.createDataFrame([], SCHEMA)).count() == 0


def test_counts_differ_by_one_at_most(spark):
    for n in (1, 23, 25, 100):
        got = Counter(r.shard for r in interleave(spark.createDataFrame([(i, "t", "s", "x") for i in range(n)], SCHEMA)).collect())
        counts = [got.get(shard, 0) for shard in range(24)]
        assert max(counts) - min(counts) <= 1 and sum(counts) == n
