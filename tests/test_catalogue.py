"""Every registered query against its SQL counterpart, and the plans that matter at scale."""

import sys
from pathlib import Path

import pytest
from compare import connect, differences
from helpers import plan_of

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

import __spark_entry__ as driver  # noqa: E402

from tickloom.plans.catalogue import catalogue  # noqa: E402
from tickloom.plans.oracles import ORACLES  # noqa: E402

QUERIES = catalogue()


@pytest.fixture(scope="module")
def con(small):
    return connect(small)


def test_every_query_has_a_counterpart():
    assert QUERIES.keys() == ORACLES.keys()
    assert QUERIES.keys() <= driver.queries().keys()
    assert driver.oracle_sql().items() >= ORACLES.items()


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_sql(spark, small, con, name):
    rows, extra, missing = differences(QUERIES[name](spark, small), con, ORACLES[name])
    assert not extra and not missing
    assert rows > 0


def test_entry(spark):
    assert driver.entry(spark).count() > 0


# Queries that return what they have stored: their plan is a plain scan.
STORED = ("stream_", "raw_table_", "aggregated_table_", "idempotent_", "reconcile_", "flow_", "compacted_", "late_", "one_pass_")


@pytest.mark.parametrize("name", sorted(name for name in QUERIES if not name.startswith(STORED)))
def test_plans_stay_in_the_jvm_without_cross_joins(spark, small, name):
    plan = plan_of(QUERIES[name](spark, small))
    for word in ("PythonUDF", "ArrowEvalPython", "BatchEvalPython", "CartesianProduct", "BroadcastNestedLoopJoin"):
        assert word not in plan


@pytest.mark.parametrize("name", ["trade_clean", "trade_agg_1m", "reject_report", "symbol_allow_list"])
def test_messages_are_parsed_once(spark, small, name):
    assert plan_of(QUERIES[name](spark, small)).count("from_json") == 1


def test_flagship_reads_five_columns_and_shuffles_what_it_needs(spark, small):
    plan = plan_of(QUERIES[driver.FLAGSHIP](spark, small))
    assert "RoundRobinPartitioning" not in plan
    # One shuffle for the copies, one for the windows after a partial aggregate.
    assert plan.count("Exchange hashpartitioning(symbol") == 2
    # The third deals the feed's events to tasks; it is no part of the operators.
    assert plan.count("Exchange hashpartitioning") == 3 and plan.count("Exchange hashpartitioning(event_id") == 1
    assert "user_id" not in plan.split("ReadSchema:")[1]
    assert "partial_avg" in plan and "partial_min" in plan
    assert "source" not in plan.split("partial_min(struct(")[1].split("]")[0]
