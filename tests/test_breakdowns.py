"""Typed breakdown cube and drill index (O-52, O-51)."""

import pytest
from pyspark.sql import functions as F

from docket.operators.breakdown import Rule, breakdown_cube, by_rule, change, read_drill, write_drill
from docket.operators.diff import diff_breakdowns
from docket.plans.packaging_breakdowns import ACTIVITIES, BREAKDOWNS, DRILLS

ROWS = "org long, child string, kind string, material string, nation string, target string, q1 double, q2 double, other string"
RULES = [Rule("by_nation", {"kind": ["Waste"]}, filled=["nation"], blank=["target"], by=["material", "nation"]),
         Rule("all", filled=["material"], by=["material"]), Rule("two", {"kind": ["waste", "Bin"], "nation": ["EN"]}, by=["nation"])]


def cube(spark, rows, **kw):
    df = spark.createDataFrame([(*r, "x") for r in rows], ROWS).repartition(3)
    return breakdown_cube(df, RULES, ["org", "child"], ["material", "nation"], F.col("q1"), F.col("q2"), **kw)


DATA = [(1, None, "Waste", "Glass", "EN", None, 10.0, 15.0), (1, None, "WASTE ", "GLASS", "en", "", 10.0, 5.0), (1, "c", "waste", "Glass", "EN", "SC", 1.0, 1.0),
        (2, None, "Bin", "Paper", "NI", None, 0.0, 7.0), (2, None, "Waste", None, "SC", None, 4.0, None), (3, None, None, "", None, None, 9.0, 9.0),
        (None, None, "Bin", "Paper", "EN", None, 2.0, 2.0)]


def test_cube_members_totals_and_scaffold(spark):
    got = {tuple(r)[:6]: tuple(r)[6:] for r in cube(spark, DATA).collect()}
    member = {k[1:]: v for k, v in got.items() if k[0] == "member"}
    assert member == {
        ("by_nation", 1, None, "GLASS", "EN"): (20.0, 20.0, 0.0, "flat"),  # spellings are one value, shown by the least
        ("by_nation", 2, None, None, "SC"): (4.0, 0.0, 0.0, "flat"),       # a missing quantity is 0
        ("all", 1, None, "GLASS", None): (20.0, 20.0, 0.0, "flat"), ("all", 1, "c", "GLASS", None): (1.0, 1.0, 0.0, "flat"),
        ("all", 2, None, "Paper", None): (0.0, 7.0, 0.0, "flat"), ("all", None, None, "Paper", None): (2.0, 2.0, 0.0, "flat"),
        ("two", 1, None, None, "EN"): (20.0, 20.0, 0.0, "flat"), ("two", 1, "c", None, "EN"): (1.0, 1.0, 0.0, "flat"),
        ("two", None, None, None, "EN"): (2.0, 2.0, 0.0, "flat")}
    total = {k[1:]: v for k, v in got.items() if k[0] == "total"}
    assert total["all", None, None, "Paper", None] == (2.0, 9.0, 350.0, "up")
    assert total["by_nation", None, None, "Paper", "NI"] == (0.0, 0.0, 0.0, "flat")
    zero = {k[1:] for k in got if k[0] == "scaffold"}
    assert zero == {("by_nation", None, None, m, n) for m in ("GLASS", "Paper") for n in ("EN", "NI", "SC")} | {
        ("all", None, None, m, None) for m in ("GLASS", "Paper")} | {("two", None, None, None, "EN")}


def test_value_kind_and_limits(spark):
    rows = [(1, None, "x", "Glass", None, None, 5.0, 0.0), (2, None, "x", "Glass", None, None, 5.0, 4.0)]
    got = {(r.level, r.org): (r.change, r.arrow) for r in cube(spark, rows, kind="value", upper=1, lower=-1).collect() if r.breakdown == "all"}
    assert got["member", 1] == (-5.0, "down") and got["member", 2] == (-1.0, "down") and got["total", None] == (-6.0, "down")
    rows = rows[:1]
    got = {(r.level, r.org): (r.change, r.arrow) for r in cube(spark, rows, kind="value", upper=1, lower=-1).collect() if r.breakdown == "all"}
    assert got["member", 1] == (-5.0, "down") and got["total", None] == (0.0, "flat")  # totals: 0 when a side is 0
    with pytest.raises(ValueError):
        change(F.lit(1.0), F.lit(2.0), "other")


def test_empty_cube(spark):
    assert cube(spark, []).count() == 0


def test_no_cross_join_in_cube(spark):
    plan = cube(spark, DATA)._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan


def test_rule_lists(spark):
    assert len(BREAKDOWNS) == 28 and len({r.name for r in BREAKDOWNS}) == 28
    assert len(DRILLS) == 18 + 11 * len(ACTIVITIES) and len({r.name for r in DRILLS}) == len(DRILLS)
    with pytest.raises(ValueError):
        by_rule(spark.range(1), [Rule("a"), Rule("a")])


def test_drill_reads_one_folder(spark, scratch):
    df = spark.createDataFrame([(*r, "x") for r in DATA], ROWS)
    write_drill(df, RULES, scratch)
    out = read_drill(spark, scratch, "all", material="glass ")
    assert sorted(r.q2 for r in out.collect()) == [1.0, 5.0, 15.0]
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(rule" in plan and "rule" in plan
    assert read_drill(spark, scratch, "two").count() == 4  # NULL and other nations never match
    assert read_drill(spark, scratch, "absent").count() == 0


def test_joined_dims_stay_apart(spark):
    df = spark.createDataFrame([("a / b", "c", 1.0), ("a", "b / c", 2.0), ("a\\", "b", 4.0)], "x string, y string, q double")
    out = diff_breakdowns(df, [("xy", F.lit(True), [F.col("x"), F.col("y")])], F.col("q"), F.col("q")).collect()
    assert sorted(r.s1 for r in out) == [1.0, 2.0, 4.0]
