"""All registered queries, made ready for comparison with another engine."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tickloom.plans import queries, upkeep_queries
from tickloom.plans.queries import Query, comparable
from tickloom.session import prepare_session

QUERIES: dict[str, Query] = {**queries.QUERIES, **upkeep_queries.QUERIES}


def catalogue() -> dict[str, Query]:
    """Every query, made ready for comparison and run on a session in UTC."""

    def ready(query: Query) -> Query:
        def run(spark: SparkSession, folder: str) -> DataFrame:
            return comparable(query(prepare_session(spark), folder))

        return run

    return {name: ready(query) for name, query in QUERIES.items()}
