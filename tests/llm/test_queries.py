"""The registered queries on the given tables: against SQL where it can say them, else against the plain versions."""

import sys
from pathlib import Path

import brute
import plain_language
import pytest
from compare import connect, differences

sys.path.insert(0, str(Path(__file__).resolve().parents[2]))

import __spark_entry__ as driver  # noqa: E402
from tickloom.llm.queries import ORACLES, QUERIES, catalogue  # noqa: E402


def test_all_are_registered():
    assert {name.split("_")[0] for name in QUERIES} == {f"op{n}" for n in range(1, 14)}
    assert {*QUERIES, "pipeline"} <= driver.queries().keys() and ORACLES.items() <= driver.oracle_sql().items()


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_equals_sql(spark, small, name):
    rows, extra, missing = differences(catalogue()[name](spark, small), connect(small), ORACLES[name])
    assert rows and not extra and not missing


def test_jaccard_join(spark, small):
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{small}/documents.parquet").collect()}
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in catalogue()["op4_jaccard_join"](spark, small).collect()}
    assert got == brute.components(texts, 3, 90)


def test_suffix_dedup(spark, small):
    texts = {r.doc_id: r.text.encode() for r in spark.read.parquet(f"{small}/documents.parquet").collect()}
    gone = brute.removed(list(texts.items()), 100)
    for r in catalogue()["op2_suffix_dedup"](spark, small).collect():
        kept = bytes(b for b, g in zip(texts[r.doc_id], gone[r.doc_id]) if not g)
        assert (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) == (
            len(texts[r.doc_id]), sum(gone[r.doc_id]), brute.spans(gone[r.doc_id]), brute.sha(kept),
        )


@pytest.mark.parametrize("name, table", [("op3_byte_bpe", "documents"), ("op5_warc", "pages"), ("op7_fingerprints", "documents"), ("op9_sharding", "documents")])
def test_a_row_for_every_row(spark, small, name, table):
    assert catalogue()[name](spark, small).count() == spark.read.parquet(f"{small}/{table}.parquet").count()


def test_language_id(spark, small):
    docs = spark.read.parquet(f"{small}/documents.parquet").collect()
    pages = spark.read.parquet(f"{small}/pages.parquet").collect()
    rows = [plain_language.document(r.doc_id, r.text, r.source) for r in docs] + [plain_language.page(r.page_id, r.url, r.html) for r in pages]
    expected = plain_language.identified(rows, [(r.text, r.lang) for r in docs])
    evidence = {row["key"]: (row["host"], row["declared"], row["suffix"]) for row in rows}
    got = catalogue()["op6_language_id"](spark, small).collect()
    assert len(got) == len(rows) == len(expected)
    for r in got:
        key = ("doc", r.doc_id) if r.doc_id is not None else ("page", r.page_id)
        language, posterior, accepted = expected[key]
        assert (r.host, r.declared, r.suffix) == evidence[key]
        # Spark's table of logarithms has single precision.
        assert (r.language, r.accepted) == (language, accepted) and r.posterior == pytest.approx(posterior, abs=1e-3)
