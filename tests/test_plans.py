"""Plans keep the shapes that large tables need."""

import re

import pytest

from __spark_entry__ import queries


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


BATCH = [
    "running_watermark", "strict_window", "agg_changelog", "pctl_low", "delay_report", "dedup_ttl",
    "dedup_all", "gold_kpis", "star_enrich", "kpi_executive", "gmv_by_store", "target_vs_actual",
    "profit_by_category", "profit_by_channel", "upsert_latest", "new_ids_anti", "window_close_lag",
]


@pytest.mark.parametrize("name", BATCH)
def test_no_cross_joins(spark, small, name):
    plan = plan_of(queries()[name](spark, small))
    assert not re.search("CartesianProduct|BroadcastNestedLoopJoin", plan)


@pytest.mark.parametrize("name", ["agg_changelog", "pctl_low", "dedup_ttl", "star_enrich", "gold_kpis",
                                  "target_vs_actual", "profit_by_channel"])
def test_no_single_task_shuffle(spark, small, name):
    assert "SinglePartition" not in plan_of(queries()[name](spark, small))


@pytest.mark.parametrize("name", ["running_watermark", "strict_window", "timeliness_class"])
def test_only_carried_maxima_meet_in_one_task(spark, small, name):
    plan = plan_of(queries()[name](spark, small))
    assert plan.count("SinglePartition") == 1
    below = plan.split("SinglePartition")[1].splitlines()[1]
    assert "HashAggregate" in below and "__bucket" in below


def test_paid_filter_and_columns_reach_the_scan(spark, small):
    plan = plan_of(queries()["profit_by_category"](spark, small))
    scan = next(line for line in plan.splitlines() if "lineitem" in line)
    assert re.search(r"PushedFilters: \[[^\]]*l_returnflag", scan)
    assert "l_shipdate" not in scan.split("ReadSchema")[1] and "l_orderkey" not in scan.split("ReadSchema")[1]


def test_key_filter_reaches_the_scan(spark, small):
    plan = plan_of(queries()["upsert_point_lookup"](spark, small))
    assert re.search(r"PushedFilters: \[[^\]]*EqualTo\(user_id,3\)", plan)


def test_seller_figures_aggregate_before_the_joins(spark, small):
    plan = plan_of(queries()["gmv_by_store"](spark, small))
    lines = plan.splitlines()
    facts = next(i for i, line in enumerate(lines) if "lineitem" in line)
    above = [line for line in lines[:facts] if "Join" in line or "HashAggregate" in line]
    assert "HashAggregate" in above[-1]


def test_top_sellers_are_a_top_k(spark, small):
    assert "TakeOrderedAndProject" in plan_of(queries()["top_performers"](spark, small))
