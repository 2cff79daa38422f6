"""Comparison of two tables of trades by a tree of hashes.

A leaf is a minute, its parents are the hour and the day. A node holds the number of
its rows and two sums of row hashes: they do not depend on the order of rows, and a
row that stands twice counts twice. A parent is the sum of its children. Equal
nodes hold equal rows, but for a coincidence of two 64-bit hashes; the comparison
goes down into unequal nodes only, so tables that differ little are read whole
once, for the leaves, or not at all where a stored tree is compared.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

LEVELS = ("day", "hour", "minute")
_SUMS = ("row_count", "hash_a", "hash_b")
# Sums of 64-bit numbers, kept below 2**64: the same whether they are taken at once or level by level.
_MODULUS = "18446744073709551616BD"


def leaves(
    table: DataFrame, columns: Sequence[str], time_column: str = "trade_timestamp", date_column: str = "trade_date"
) -> DataFrame:
    """``day, hour, minute, row_count, hash_a, hash_b``: the leaves, from one pass with a partial aggregate.

    Null and a value never hash alike: every column goes in with whether it is there.
    ``hour`` and ``minute`` are times, NULL for rows without one.
    """
    time = F.col(time_column)
    row = [part for name in columns for part in (F.col(name).isNull(), F.col(name))]
    hashed = table.select(
        F.col(date_column).alias("day"),
        F.date_trunc("hour", time).alias("hour"),
        F.date_trunc("minute", time).alias("minute"),
        F.xxhash64(F.lit(1), *row).cast("decimal(20,0)").alias("a"),
        F.xxhash64(F.lit(2), *row).cast("decimal(20,0)").alias("b"),
    )
    return hashed.groupBy(*LEVELS).agg(
        F.count("*").alias("row_count"), _total("a").alias("hash_a"), _total("b").alias("hash_b")
    )


def _total(column: str):
    return F.expr(f"cast(pmod(sum({column}), {_MODULUS}) AS decimal(20,0))")


def nodes(tree: DataFrame, level: str) -> DataFrame:
    """The nodes of a level: sums over the leaves below them."""
    path = LEVELS[: LEVELS.index(level) + 1]
    return tree.groupBy(*path).agg(
        F.sum("row_count").alias("row_count"), _total("hash_a").alias("hash_a"), _total("hash_b").alias("hash_b")
    )


def unequal_nodes(one: DataFrame, other: DataFrame, level: str) -> DataFrame:
    """Nodes of two trees that differ: their path, and the number of rows on both sides."""
    path = LEVELS[: LEVELS.index(level) + 1]

    def side(tree: DataFrame, flag: int) -> DataFrame:
        return nodes(tree, level).withColumn("side", F.lit(flag))

    # A node is unequal unless both sides have it with the same sums. Grouping takes null keys for equal.
    both = side(one, 0).unionByName(side(other, 1)).groupBy(*path).agg(
        *[F.max(F.when(F.col("side") == flag, F.struct(*_SUMS))).alias(name) for flag, name in enumerate(("one", "other"))]
    )
    different = both.where(~F.col("one").eqNullSafe(F.col("other")))
    return different.select(
        *path,
        F.coalesce("one.row_count", F.lit(0)).alias("row_count"),
        F.coalesce("other.row_count", F.lit(0)).alias("other_row_count"),
    )


def _below(tree: DataFrame, found: DataFrame, level: str) -> DataFrame:
    """The leaves below some nodes."""
    path = LEVELS[: LEVELS.index(level) + 1]
    marked = found.select(*[F.col(name).alias(f"_{name}") for name in path])
    same = [F.col(name).eqNullSafe(F.col(f"_{name}")) for name in path]
    condition = same[0]
    for part in same[1:]:
        condition = condition & part
    return tree.join(marked, condition, "left_semi")


def tree_differences(one: DataFrame, other: DataFrame) -> DataFrame:
    """The leaves of two trees that differ; each level is compared below the unequal nodes of the one above."""
    for level in LEVELS[:-1]:
        found = unequal_nodes(one, other, level)
        one, other = _below(one, found, level), _below(other, found, level)
    return unequal_nodes(one, other, LEVELS[-1])


def differing_rows(
    one: DataFrame,
    other: DataFrame,
    found: DataFrame,
    keys: Sequence[str],
    columns: Sequence[str],
    time_column: str = "trade_timestamp",
) -> DataFrame:
    """Rows of the unequal leaves that only one side has, or that differ: the keys and ``change``.

    ``change`` is ``removed`` (only in the first table), ``added`` (only in the second) or ``changed``.
    Both tables are filtered to these minutes before they are joined; keys are unique in each.
    """
    minutes = found.select(F.col("minute").alias("_minute"))

    def side(table: DataFrame, name: str) -> DataFrame:
        rows = table.join(minutes, F.date_trunc("minute", F.col(time_column)).eqNullSafe(F.col("_minute")), "left_semi")
        return rows.select(*keys, F.struct(*columns).alias(name))

    both = side(one, "one").join(side(other, "other"), list(keys), "full_outer")
    change = F.when(F.col("other").isNull(), "removed").when(F.col("one").isNull(), "added").otherwise("changed")
    return both.where(~F.col("one").eqNullSafe(F.col("other"))).select(*keys, change.alias("change"))
