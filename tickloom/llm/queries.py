"""The registered queries of the operators and their SQL counterparts."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tickloom.llm import pair_index
from tickloom.llm.byte_bpe import encode_decode
from tickloom.llm.fingerprints import compare_with_edits
from tickloom.llm.importance import resample
from tickloom.llm.jaccard_join import join_components
from tickloom.llm.language_id import document_evidence, fit, identify, page_evidence
from tickloom.llm.packing import pack
from tickloom.llm.preferences import preference_pairs, swapped_last_answers
from tickloom.llm.sharding import interleave
from tickloom.llm.spelling import variants
from tickloom.llm.suffix_dedup import remove_repeats
from tickloom.llm.tables import prepare, table
from tickloom.llm.topk import top_k
from tickloom.llm.warc import round_trip

Query = Callable[[SparkSession, str], DataFrame]


def op1_top_k(spark: SparkSession, folder: str) -> DataFrame:
    return top_k(table(spark, folder, "embeddings"))


def op2_suffix_dedup(spark: SparkSession, folder: str) -> DataFrame:
    found = remove_repeats(table(spark, folder, "documents"))
    return found.select(
        "carry.doc_id",
        "n_bytes",
        "n_removed",
        F.size("spans").cast("bigint").alias("n_spans"),
        F.sha2("kept", 256).alias("kept_sha256"),
    )


def op3_byte_bpe(spark: SparkSession, folder: str) -> DataFrame:
    path = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    return encode_decode(table(spark, folder, "documents"), path, public_tokenizers.PATTERN)


def op4_jaccard_join(spark: SparkSession, folder: str) -> DataFrame:
    return join_components(table(spark, folder, "documents"), words=3, threshold=90)


def op5_warc(spark: SparkSession, folder: str) -> DataFrame:
    return round_trip(spark, table(spark, folder, "pages"))


def op6_language_id(spark: SparkSession, folder: str) -> DataFrame:
    """Pages, with all kinds of evidence, and documents, whose source stands for the host."""
    docs, pages = table(spark, folder, "documents"), table(spark, folder, "pages")
    model = fit(docs.select("text", F.col("lang").alias("label")))
    rows = document_evidence(docs).unionByName(page_evidence(pages), allowMissingColumns=True)
    return identify(rows, model).select(
        "doc_id", "page_id", "host", "declared", "suffix", "language", F.round("posterior", 6).alias("posterior"), "accepted"
    )


def op8_preferences(spark: SparkSession, folder: str) -> DataFrame:
    return preference_pairs(*swapped_last_answers(table(spark, folder, "conversations")))


def op7_fingerprints(spark: SparkSession, folder: str) -> DataFrame:
    return compare_with_edits(table(spark, folder, "documents"))


def op9_sharding(spark: SparkSession, folder: str) -> DataFrame:
    return interleave(table(spark, folder, "documents"))


def op10_packing(spark: SparkSession, folder: str) -> DataFrame:
    return pack(table(spark, folder, "documents"), public_tokenizers.path("word_bpe_49k.json"))


def op11_importance(spark: SparkSession, folder: str) -> DataFrame:
    return resample(table(spark, folder, "documents"), table(spark, folder, "benchmark"))


def op12_pair_index_bpe(spark: SparkSession, folder: str) -> DataFrame:
    return pair_index.encode_decode(table(spark, folder, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


def op13_spelling(spark: SparkSession, folder: str) -> DataFrame:
    return variants(table(spark, folder, "documents"))


# Checksums of the rows (text ``w``) of a table, by the bits of their UTF-8 bytes (fixed value: the polynomial).
def _crc32_sql(of: str) -> str:
    return f"""
          SELECT w, xor(4294967295, list_reduce(
            list_transform(range(octet_length(encode(w))), lambda i: CAST('0x' || substr(hex(encode(w)), 2 * i + 1, 2) AS BIGINT)),
            lambda c, b: list_reduce(range(8), lambda d, k: xor(d >> 1, 3988292384 * (d & 1)), xor(c, b)),
            4294967295::BIGINT)) AS crc FROM {of}"""


_LOWER_SQL = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

QUERIES: dict[str, Query] = {
    "op1_top_k": op1_top_k,
    "op2_suffix_dedup": op2_suffix_dedup,
    "op3_byte_bpe": op3_byte_bpe,
    "op4_jaccard_join": op4_jaccard_join,
    "op5_warc": op5_warc,
    "op6_language_id": op6_language_id,
    "op8_preferences": op8_preferences,
    "op7_fingerprints": op7_fingerprints,
    "op9_sharding": op9_sharding,
    "op10_packing": op10_packing,
    "op11_importance": op11_importance,
    "op12_pair_index_bpe": op12_pair_index_bpe,
    "op13_spelling": op13_spelling,
}

ORACLES: dict[str, str] = {
    "op8_preferences": """
        WITH t AS (
          SELECT conv_id AS p, turn, coalesce(role, 'user') AS role, coalesce(text, '') AS text FROM conversations),
        l AS (
          SELECT p, max(turn) AS last_turn FROM t WHERE role = 'assistant' AND p IS NOT NULL GROUP BY p),
        a AS (
          SELECT xor(t.p, 1) AS p, max(t.text) AS answer
          FROM t JOIN l ON t.p = l.p AND t.turn = l.last_turn WHERE t.role = 'assistant' GROUP BY t.p),
        r AS (
          SELECT t.p, turn, role, CASE WHEN turn = last_turn THEN answer ELSE text END AS text
          FROM t JOIN l ON t.p = l.p JOIN a ON t.p = a.p WHERE turn <= last_turn),
        numbered AS (
          SELECT p, role, text, true AS chosen,
                 row_number() OVER (PARTITION BY p ORDER BY turn NULLS FIRST, role, text) AS n FROM t
          UNION ALL
          SELECT p, role, text, false, row_number() OVER (PARTITION BY p ORDER BY turn NULLS FIRST, role, text) FROM r),
        sides AS (
          SELECT p, n, count(*) AS held, min(role) AS r1, max(role) AS r2, min(text) AS t1, max(text) AS t2
          FROM numbered GROUP BY p, n),
        parted AS (
          SELECT p, coalesce(min(CASE WHEN held < 2 OR r1 <> r2 OR t1 <> t2 THEN n END), max(n) + 1) AS cut
          FROM sides GROUP BY p),
        pieces AS (
          SELECT x.p, x.n, x.chosen, x.n < cut AS shared, '<|' || role || '|>' || chr(10) || text || '<|end|>' || chr(10) AS piece,
                 CASE WHEN role = 'assistant' THEN '0x' || (length(role) + 5) || ',1x' || (length(text) + 8)
                      ELSE '0x' || (length(role) + 5 + length(text) + 8) END AS mask
          FROM numbered x JOIN parted y ON x.p IS NOT DISTINCT FROM y.p)
        SELECT p AS pair_id, count(*) FILTER (chosen AND shared) AS prefix_turns,
               count(*) FILTER (chosen AND NOT shared) AS chosen_turns, count(*) FILTER (NOT chosen AND NOT shared) AS rejected_turns,
               coalesce(string_agg(piece, '' ORDER BY n) FILTER (chosen AND shared), '') AS prompt,
               coalesce(string_agg(piece, '' ORDER BY n) FILTER (chosen AND NOT shared), '') AS chosen,
               coalesce(string_agg(piece, '' ORDER BY n) FILTER (NOT chosen AND NOT shared), '') AS rejected,
               coalesce(string_agg(mask, ',' ORDER BY n) FILTER (chosen AND NOT shared), '') AS chosen_mask,
               coalesce(string_agg(mask, ',' ORDER BY n) FILTER (NOT chosen AND NOT shared), '') AS rejected_mask
        FROM pieces GROUP BY p""",
    "op1_top_k": """
        WITH v AS (
          SELECT vec_id, list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS e FROM embeddings
          WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
            AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
        s AS (
          SELECT q.vec_id AS query_id, c.vec_id, CAST(list_inner_product(q.e, c.e) AS BIGINT) AS score
          FROM v q JOIN v c ON q.vec_id <> c.vec_id WHERE q.vec_id % 50 = 0)
        SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score FROM (
          SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s)
        WHERE rank <= 5""",
    "op11_importance": f"""
        WITH texts AS (
          SELECT doc_id, false AS target, text FROM documents UNION ALL SELECT NULL, true, text FROM benchmark),
        found AS (
          SELECT doc_id, target,
                 regexp_extract_all({_LOWER_SQL.format("coalesce(text, '')")}, '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS words FROM texts),
        features AS (SELECT doc_id, target, unnest(words) AS w FROM found),
        words AS (SELECT DISTINCT w FROM features),
        sums AS ({_crc32_sql("words")}),
        counts AS (
          SELECT crc % 10000 AS bucket, count(*) FILTER (target) AS t, count(*) FILTER (NOT target) AS s
          FROM features JOIN sums USING (w) GROUP BY bucket),
        whole AS (SELECT coalesce(sum(t), 0) AS big_t, coalesce(sum(s), 0) AS big_s FROM counts),
        gains AS (
          SELECT bucket, floor(1000 * ln(((t + 1)::DOUBLE * (big_s + 10000)::DOUBLE) / ((s + 1)::DOUBLE * (big_t + 10000)::DOUBLE)))::BIGINT AS gain
          FROM counts, whole),
        weights AS (
          SELECT doc_id, floor(sum(gain)::DOUBLE / count(*)::DOUBLE)::BIGINT AS weight
          FROM features JOIN sums USING (w) JOIN gains ON bucket = crc % 10000 WHERE NOT target GROUP BY doc_id),
        scored AS (
          SELECT doc_id, len(words)::BIGINT AS n_features, coalesce(weight, 0) AS weight,
                 coalesce(weight, 0) + floor(-1000 * ln(-ln((('0x' || substr(sha256('2024:' || doc_id), 1, 8))::BIGINT + 0.5::DOUBLE) / 4294967296::DOUBLE)))::BIGINT AS score
          FROM found LEFT JOIN weights USING (doc_id) WHERE NOT target),
        ordered AS (
          SELECT *, row_number() OVER (PARTITION BY n_features >= 20 ORDER BY score DESC, doc_id) AS place,
                 count(*) FILTER (n_features >= 20) OVER () AS n FROM scored)
        SELECT doc_id, n_features, weight, score, CASE WHEN n_features >= 20 AND place <= 10 * n // 100 THEN place END AS rank FROM ordered""",
    "op13_spelling": f"""
        WITH RECURSIVE runs AS (
          SELECT doc_id, unnest(regexp_extract_all(coalesce(text, ''), '[A-Za-z\\x{{C0}}-\\x{{FF}}]+')) AS run FROM documents),
        low AS (SELECT doc_id, {_LOWER_SQL.format("run")} AS word, count(*) AS n FROM runs GROUP BY ALL),
        keyed AS (SELECT *, doc_id || ':' || word AS w FROM low),
        sums AS ({_crc32_sql("keyed")}),
        slipped AS (
          SELECT CASE WHEN crc % 199 = 0 THEN substr(word, 1, (crc % length(word))::BIGINT) || substr(word, (crc % length(word))::BIGINT + 2)
                      ELSE word END AS word, n FROM keyed JOIN sums USING (w)),
        v AS (SELECT word, sum(n)::BIGINT AS n FROM slipped WHERE length(word) >= 6 GROUP BY word HAVING sum(n) >= 5),
        cuts AS (
          SELECT word, n, i, substr(word, 1, i - 1) || substr(word, i + 1) AS rest
          FROM (SELECT word, n, unnest(range(1, length(word) + 1)) AS i FROM v)),
        shorter AS (SELECT DISTINCT c.word AS long, c.n AS long_n, v.word AS short, v.n AS short_n FROM cuts c JOIN v ON v.word = c.rest),
        near AS (
          SELECT a.word, b.word AS other, b.n AS other_n FROM cuts a JOIN cuts b ON a.i = b.i AND a.rest = b.rest AND a.word <> b.word
          UNION ALL SELECT long, short, short_n FROM shorter
          UNION ALL SELECT short, long, long_n FROM shorter),
        best AS (
          SELECT word, count(*) AS n_near, min({{'n': -other_n, 'w': encode(other)}}) AS best FROM near GROUP BY word),
        forms AS (
          SELECT v.word, v.n, coalesce(n_near, 0)::BIGINT AS n_near,
                 CASE WHEN -best.n >= 5 * v.n THEN decode(best.w) END AS form, CASE WHEN -best.n >= 5 * v.n THEN -best.n END AS form_n
          FROM v LEFT JOIN best ON best.word = v.word),
        walk AS (
          SELECT word, word AS root, form AS next FROM forms
          UNION ALL
          SELECT walk.word, forms.word, forms.form FROM walk JOIN forms ON forms.word = walk.next)
        SELECT f.word, form, root, n, n_near, form_n::BIGINT AS form_n FROM forms f JOIN walk w ON w.word = f.word AND w.next IS NULL""",
}


def catalogue() -> dict[str, Query]:
    def ready(query: Query) -> Query:
        return lambda spark, folder: query(prepare(spark), folder)

    return {name: ready(query) for name, query in QUERIES.items()}