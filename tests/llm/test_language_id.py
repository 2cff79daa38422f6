import random

from pyspark.sql import functions as F

from tickloom.llm.language_id import document_evidence, fit, identify, page_evidence

ROWS = "doc_id bigint, text string, declared string, suffix string, host string, domain string, extra string"


def test_held_out_accuracy(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    held_out = F.pmod(F.xxhash64("doc_id"), F.lit(4)) == 0
    model = fit(docs.where(~held_out).select("text", F.col("lang").alias("label")))
    judged = identify(document_evidence(docs.where(held_out)), model).join(docs.select("doc_id", "lang"), "doc_id")
    right = judged.agg(F.avg((F.col("language") == F.col("lang")).cast("double")), F.avg(F.col("accepted").cast("double"))).first()
    assert right[0] > 0.97 and right[1] > 0.97


def test_other_evidence_decides_where_the_text_does_not(spark):
    english, german = "the house and the garden of the king", "das haus und der garten des königs"
    training = spark.createDataFrame([(english, "en"), (german, "de")] * 20, "text string, label string")
    rows = [(i, english, "en", "uk", "a.uk", "a.uk", "x") for i in range(40)] + [(100 + i, german, "de", "de", "b.de", "b.de", "x") for i in range(40)]
    rows += [(900, "zq zqqz", "de", None, None, None, "x"), (901, "zq zqqz", None, "de", None, None, "x"), (902, "zq zqqz", None, None, "b.de", "b.de", "x"),
             (903, "zq zqqz", None, None, "a.uk", "a.uk", "x"), (904, "", "de", "de", "b.de", "b.de", "x"), (905, "123 456", None, None, None, None, "x")]
    got = {r.doc_id: r for r in identify(spark.createDataFrame(rows, ROWS), fit(training)).collect()}
    assert [got[i].language for i in (0, 100, 900, 901, 902, 903, 904)] == ["en", "de", "de", "de", "de", "en", "de"]
    assert got[902].accepted and not got[904].accepted and not got[905].accepted and got[0].extra == "x"
    assert all(0.99 < got[i].posterior for i in (0, 100))


def test_rare_labels_unseen_languages_and_junk(spark):
    """A label of one in a thousand rows is found; what fits no label is rejected, with several labels and with one."""
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text", "lang", "source").cache()
    german = docs.where("lang = 'de'").orderBy("doc_id").limit(8)
    many = docs.where("lang = 'en'").crossJoin(spark.range(10)).select("text", F.col("lang").alias("label"))
    training = many.unionByName(docs.where("lang = 'fr'").select("text", F.col("lang").alias("label"))).unionByName(german.select("text", F.col("lang").alias("label")))
    rng = random.Random(4)
    junk = spark.createDataFrame([(10**6 + i, "".join(rng.choice("abcdefghijklmnopqrstuvwxyz    ") for _ in range(600)), "junk", "s") for i in range(60)], docs.schema)

    def judged(model):
        rows = identify(document_evidence(docs.unionByName(junk)), model).join(docs.unionByName(junk).select("doc_id", "lang"), "doc_id")
        return {r.lang: (r.right, r.accepted) for r in rows.groupBy("lang").agg(F.avg((F.col("language") == F.col("lang")).cast("double")).alias("right"), F.avg(F.col("accepted").cast("double")).alias("accepted")).collect()}

    some = judged(fit(training))
    assert min(*(some[x][0] for x in ("en", "fr", "de")), *(some[x][1] for x in ("en", "fr", "de"))) > 0.95, some
    assert max(some["es"][1], some["junk"][1]) < 0.1, some
    one = judged(fit(docs.where("lang = 'fr'").select("text", F.col("lang").alias("label"))))
    assert one["fr"][1] > 0.95 and max(one[x][1] for x in ("en", "de", "es", "junk")) < 0.1, one


def test_defined_cases(spark):
    rows = spark.createDataFrame([(1, None, None, None, None, None, "x"), (None, "abc", "en", None, "h", None, "x")] * 2, ROWS)
    nothing = fit(spark.createDataFrame([(None, "en"), ("abc", None)], "text string, label string"))
    assert [(r.language, r.posterior, r.accepted) for r in identify(rows, nothing).collect()] == [(None, 0.0, False)] * 4
    one = fit(spark.createDataFrame([("abc", "en")], "text string, label string"))
    assert sorted((r.language, r.accepted) for r in identify(rows, one).collect()) == [("en", False)] * 2 + [("en", True)] * 2
    assert identify(rows.limit(0), one).count() == 0


def test_evidence_of_pages(spark):
    rows = [(1, "https://User@Blog.Example.co:80/x?y", "<HTML class=a LANG='fr-CA'><script>the</script>Le <b>chat</b>&amp;", "z"), (2, None, None, "z"), (3, "no url", "<p>x", "z")]
    got = {r.page_id: r for r in page_evidence(spark.createDataFrame(rows, "page_id bigint, url string, html string, host string")).collect()}
    assert (got[1].declared, got[1].suffix, got[1].host, got[1].domain) == ("fr", "co", "blog.example.co", "example.co")
    assert got[1].text.split() == ["Le", "chat"]
    assert tuple(got[2])[1:] == ("", None, None, None, None) and got[3].host is None
