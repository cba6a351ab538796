"""Scale guards on the physical plans of the registered queries."""

from __future__ import annotations

import contextlib
import io

import pytest


from telcolens.plans import registry
from conftest import SMOKE_SF

QUERIES = registry.queries()
FORBIDDEN = ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "ArrowEvalPython",
             "PythonUDF", "FlatMapGroupsInPandas")


def explain(df, mode: str = "simple") -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain(mode=mode)
    return buf.getvalue()


def plan(spark, name: str) -> str:
    return explain(QUERIES[name](spark, SMOKE_SF), "formatted")


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_no_cross_product_or_python(spark, name):
    p = plan(spark, name)
    for bad in FORBIDDEN:
        assert bad not in p, (name, bad)


def test_filters_reach_the_scan(spark):
    p = plan(spark, "t01_service_usage_3m")
    assert "PushedFilters: [IsNotNull(l_shipdate), GreaterThanOrEqual(l_shipdate,2001-05-02T00:00), " \
        "LessThanOrEqual(l_shipdate,2001-08-02T00:00)" in p


def test_column_pruning(spark):
    p = plan(spark, "t16_age_gender")
    assert "ReadSchema: struct<c_custkey:bigint,c_mktsegment:string>" in p


def test_group_means_without_window(spark):
    for name in ("t17_above_tariff_average", "t18_above_age_average"):
        p = plan(spark, name)
        assert "Window" not in p, name
    assert "BroadcastHashJoin" in plan(spark, "t18_above_age_average")


def test_latest_payment_limits_before_shuffle(spark):
    p = explain(QUERIES["t02_last_payment"](spark, SMOKE_SF))
    lines = p.splitlines()
    partial = next(i for i, x in enumerate(lines) if "WindowGroupLimit" in x and "Partial" in x)
    exchange = next(i for i, x in enumerate(lines) if "Exchange hashpartitioning(subscribers_id" in x)
    assert exchange < partial  # the partial limit sits below (before) the shuffle


def test_top10_is_take_ordered(spark):
    assert "TakeOrderedAndProject" in plan(spark, "t09_top10_complainers")
