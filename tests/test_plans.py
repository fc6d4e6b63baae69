"""Plan-shape checks over every registered query: no cartesian products or
nested-loop joins, no row-at-a-time Python, and pruned Parquet scans."""

import pytest

from docket.plans import all_queries

QUERIES = all_queries()


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_plan_shape(spark, sf_small, name):
    plan = QUERIES[name](spark, sf_small)._jdf.queryExecution().executedPlan().toString()
    for bad in ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "ArrowEvalPython"):
        assert bad not in plan, f"{name}: {bad}"


def final_plan(df):
    """The executed plan as AQE left it."""
    df.collect()
    text = df._jdf.queryExecution().executedPlan().toString()
    assert "AdaptiveSparkPlan" not in text or "isFinalPlan=true" in text
    return text.split("== Initial Plan ==")[0]


@pytest.mark.parametrize("name", ["multi_path_lookup", "role_views", "attach_optional_children", "error_report",
                                  "obligation_balance", "summary_view", "file_trace", "packaging_breakdowns"])
def test_facts_are_scanned_once(spark, sf_small, name, monkeypatch):
    from docket.operators import breakdown
    written = []  # plans of what a query writes aside and reads again: their scans count too
    commit = breakdown.committed
    monkeypatch.setattr(breakdown, "committed", lambda df, what: (written.append(df._jdf.queryExecution().executedPlan().toString()), commit(df, what))[1])
    plan = "\n".join([final_plan(all_queries()[name](spark, sf_small)), *written])
    scans = [line for line in plan.splitlines() if "FileScan parquet" in line and "lineitem.parquet" in line]
    assert len(scans) == 1, plan
    wide = {"l_extendedprice", "l_discount", "l_shipdate", "l_returnflag", "l_quantity", "l_partkey", "l_suppkey", "l_linestatus", "l_linenumber"}
    assert not all(c in scans[0] for c in wide)  # columns are pruned


@pytest.mark.parametrize("name,column", [("unmatched", "o_orderdate"), ("delta_extract", "o_orderdate")])
def test_filters_reach_the_scan(spark, sf_small, name, column):
    plan = final_plan(all_queries()[name](spark, sf_small))
    assert any("PushedFilters" in line and column in line.split("PushedFilters", 1)[1] for line in plan.splitlines())
