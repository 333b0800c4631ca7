"""The executed plans stay free of shapes that do not scale."""

import re

import pytest
from conftest import SMALL

from saleslens.registry import QUERIES
from saleslens.sources import Tables

WATCHED = [
    "an_campaign_effect", "an_campaign_tiered_baseline", "an_promo_stats", "an_promo_retention", "an_quadrant", "an_revenue_concentration",
    "join_interval_contains", "join_cross", "join_window_overlap", "join_asof_both", "win_row_number", "win_lag", "agg_quantile", "fc_seasonal_naive",
]


def executed(df):
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]


@pytest.mark.parametrize("name", WATCHED)
def test_no_all_pairs_join_and_no_python_rows(spark, name):
    plan = executed(QUERIES[name](spark, SMALL))
    for bad in ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "FlatMapGroupsInPandas"):
        assert bad not in plan, f"{bad} in {name}"


def test_order_dates_reach_the_reader(spark):
    plan = Tables(spark, SMALL).orders_between("1997-01-01", "1997-12-31").select("order_id")._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"PushedFilters: \[[^\]]*GreaterThanOrEqual\(o_orderdate", plan)
    assert "ReadSchema: struct<o_orderkey:bigint,o_orderdate:timestamp_ntz>" in plan


def test_only_needed_columns_are_read(spark):
    plan = Tables(spark, SMALL).returns.groupBy("return_reason").count()._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<l_linenumber:int,l_returnflag:string>" in plan and "EqualTo(l_returnflag,R)" in plan


def test_quantiles_scan_the_input_once(spark):
    from saleslens.operators.order_stats import exact_quantiles

    paid = Tables(spark, SMALL).payments
    plan = executed(exact_quantiles(paid, ["installments"], "payment_value", {"m": 0.5}))
    assert len(re.findall("FileScan parquet", plan)) == 1 and "ReusedExchange" in plan
