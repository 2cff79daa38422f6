"""Proportional stratified interleaving: shards that all have the mixture of the whole.

Rows of a source are put into a seeded random order; a row's place in it, divided
by the size of its source, is its *fractional rank*. In the order of fractional
ranks every stretch holds the sources in proportion, so cutting that order into
equal stretches gives shards of the same mixture.

Neither a source nor the whole table is ranked in one task. Ranks are taken in
two steps: rows are counted per bucket of the sort key, the counts are summed up
over the (bounded) list of buckets, and only rows of one bucket are sorted together.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

SHARDS = 24
SEED = 7
# Buckets of a source's shuffled order: the leading hex digits of the key.
KEY_DIGITS = 3
# Buckets of the interleaved order.
RANK_BUCKETS = 16_384


def _bucketed_rank(rows: DataFrame, group: list[str], bucket: str, order: list[Column], name: str) -> DataFrame:
    """Adds ``name``, the rank from 0 within ``group`` by (bucket, order), and ``<name>_of``, the group's size.

    ``bucket`` must rise with the order. The window over the counts sees one row per bucket.
    """
    counts = rows.groupBy(*group, bucket).count()
    upto = Window.partitionBy(*group).orderBy(bucket).rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select(
        *[F.col(c).alias(f"_{c}") for c in group],
        F.col(bucket).alias("_bucket"),
        F.coalesce(F.sum("count").over(upto), F.lit(0)).alias("_before"),
        F.sum("count").over(Window.partitionBy(*group)).alias("_of"),
    )
    keys = F.col(bucket) == F.col("_bucket")
    for c in group:
        keys = keys & (F.col(c) == F.col(f"_{c}"))
    inside = F.row_number().over(Window.partitionBy(*group, bucket).orderBy(*order)) - 1
    return (
        rows.join(starts, keys)
        .withColumn(name, F.col("_before") + inside)
        .withColumn(f"{name}_of", F.col("_of"))
        .drop("_bucket", "_before", "_of", *[f"_{c}" for c in group])
    )


def interleave(docs: DataFrame, shards: int = SHARDS, seed: int = SEED) -> DataFrame:
    """One row per document: ``doc_id, size, text_crc32, law, shard, slot, grown_shard``.

    The law is ``rows``: shards differ by at most one row. ``slot`` counts a
    shard's rows from 0 in the interleaved order. ``size`` is the number of UTF-8
    bytes of the text plus 8 (a null text has none).

    Defined cases: rows of a null ``source`` are a source of their own; a null
    ``doc_id`` is shuffled like the text "null"; rows with one ``doc_id`` are told
    apart by checksum and size, and rows equal in all of them are
    interchangeable; with fewer rows than shards some shards stay empty; further
    columns are ignored.
    """
    text = F.coalesce(F.col("text"), F.lit("")).cast("binary")
    rows = docs.select(
        "doc_id",
        (F.octet_length(text) + 8).cast("bigint").alias("size"),
        F.crc32(text).alias("text_crc32"),
        F.coalesce(F.concat(F.lit("="), F.col("source")), F.lit("")).alias("_source"),
        F.md5(F.concat(F.lit(f"{seed}/"), F.coalesce(F.col("doc_id").cast("string"), F.lit("null"))).cast("binary")).alias("_key"),
    ).withColumn("_digits", F.substring("_key", 1, KEY_DIGITS))
    ties = [F.col(c) for c in ("_key", "text_crc32", "size")]
    ranked = _bucketed_rank(rows, ["_source"], "_digits", ties, "_rank")
    fraction = (2 * F.col("_rank") + 1) / (2.0 * F.col("_rank_of"))
    placed = ranked.withColumn("_fraction", fraction).withColumn(
        "_stretch", F.floor(F.col("_fraction") * RANK_BUCKETS)
    )
    order = [F.col(c) for c in ("_fraction", "_source", "_key", "text_crc32", "size")]
    whole = _bucketed_rank(placed.withColumn("_all", F.lit(0)), ["_all"], "_stretch", order, "_place")
    shard = F.expr(f"_place * {shards} div _place_of")
    return whole.withColumn("shard", shard.cast("int")).select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("rows").alias("law"),
        "shard",
        # A shard starts at the first place whose product with the number of shards reaches it.
        F.expr(f"_place - (shard * _place_of + {shards - 1}) div {shards}").cast("bigint").alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"),
    )
