"""Every registered query against its SQL oracle, and rules for the plans."""

import re

import pytest
from check_oracles import compare, connect

import __spark_entry__ as entry
from caseloom.plans import all_oracles, all_queries

FOLDER = "/root/testdata/sf0.001"
QUERIES, ORACLES = all_queries(), all_oracles()

# These write or stream when called, so their plan is the reading part only.
EAGER = {"materialised_funnel", "realtime_balance", "basket_triples", "replaced_result", "appended_result"}
# Windows over a frame whose size does not grow with the rows: one row per tenure length, per first two letters of the
# vocabulary, per cell of the percentile search, per top-k value.
SMALL_GLOBAL_WINDOWS = {
    "tenure_cumulative", "basket_percentiles", "top_bottom_by_max", "explode_list", "common_exclusion", "recipe_list",
    "order_label", "ingredient_list", "ingredient_usage", "new_product",
}


@pytest.fixture(scope="module")
def duck():
    return connect(FOLDER)


@pytest.mark.parametrize("name", QUERIES)
def test_query_matches_oracle(spark, duck, name):
    assert compare(QUERIES[name](spark, FOLDER).toArrow(), duck.sql(ORACLES[name]).to_arrow_table()) == ""


@pytest.mark.parametrize("name", sorted(set(QUERIES) - EAGER))
def test_plan_rules(spark, name):
    execution = QUERIES[name](spark, FOLDER)._jdf.queryExecution()
    plan = execution.executedPlan().toString()
    for forbidden in ("CartesianProduct", "BroadcastNestedLoopJoin", "ArrowEvalPython", "BatchEvalPython", "MapInPandas"):
        assert forbidden not in plan
    if name not in SMALL_GLOBAL_WINDOWS:
        windows = [line for line in execution.optimizedPlan().toString().splitlines() if line.strip(" :+-").startswith("Window [")]
        # The list after the expressions is the partition key; without one it is the order.
        keys = [re.search(r"\], \[([^\]]*)\](, \[[^\]]*\])?$", line).group(1) for line in windows]
        assert not [k for k in keys if " ASC " in k or " DESC " in k]


def test_entry_runs(spark):
    assert entry.entry(spark).count() > 0


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLES)
    assert set(QUERIES) <= set(entry.queries()) and set(ORACLES) <= set(entry.oracle_sql())
