"""Connected components of a graph given as an edge table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickloom.llm.tables import written


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """``node, component`` for every node of an edge; the component is its smallest node.

    Large-star and small-star steps in turn: each node links its larger neighbours,
    then its smaller ones and itself, to the smallest node it sees, until
    nothing changes. The number of steps grows with the logarithm of the graph,
    edges never become more, and every step is written to the shared folder. Only
    minima are taken per node, so a node with very many edges is combined before the shuffle.
    """
    links = written(edges.select(F.greatest(a, b).alias("high"), F.least(a, b).alias("low")).where("high <> low").distinct(), "links")
    while True:
        both = links.select(F.col("high").alias("node"), F.col("low").alias("other")).unionByName(
            links.select(F.col("low").alias("node"), F.col("high").alias("other"))
        )
        least = both.groupBy("node").agg(F.least(F.min("other"), F.col("node")).alias("least"))
        large = both.where("other > node").join(least, "node").select(F.col("other").alias("high"), F.col("least").alias("low")).distinct()
        smallest = large.groupBy("high").agg(F.min("low").alias("least"))
        small = large.join(smallest, "high").select(F.explode(F.array("high", "low")).alias("high"), F.col("least").alias("low"))
        after = written(small.where("high <> low").distinct(), "links")
        before = links.select("high", "low")
        links = after
        change = [df.agg(F.count("*").alias("n"), F.sum(F.xxhash64("high", "low").cast("decimal(38,0)")).alias("s")).first() for df in (before, after)]
        if change[0] == change[1]:
            break
    members = links.select(F.col("high").alias("node"), F.col("low").alias("component"))
    return members.unionByName(links.select(F.col("low").alias("node"), F.col("low").alias("component")).distinct())
