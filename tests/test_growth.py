"""What a task holds or a step computes must not grow faster than the tables."""

import pytest
from pyspark.sql import functions as F

from docket.functions import scan
from docket.operators import breakdown
from docket.operators.conform import purge_ambiguous
from docket.plans import all_queries
from docket.sources import keyed


@pytest.mark.parametrize("name,keys", [("entity_extract", "l_orderkey"), ("obligation_balance", "l_suppkey")])
def test_partitions_grow_with_the_lines(spark, sf_small, name, keys, monkeypatch):
    lines = spark.read.parquet(f"{sf_small}/lineitem.parquet").count()
    monkeypatch.setattr(scan, "ROWS_IN_PARTITION", lines // 40)
    df = all_queries()[name](spark, sf_small)
    df.collect()
    plan = df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    assert f"hashpartitioning({keys}#" in plan and plan.count("REPARTITION_BY_NUM") == 1
    dealt = next(x for x in plan.splitlines() if "REPARTITION_BY_NUM" in x)
    assert f", {-(-lines // (lines // 40))})" in dealt, dealt
    assert plan.split("REPARTITION_BY_NUM")[0].count("HashAggregate") == 2  # both steps of the grouping work where rows were dealt to


def test_dealt_keeps_every_row(spark, monkeypatch):
    monkeypatch.setattr(scan, "ROWS_IN_PARTITION", 10)
    df = spark.range(95).select((F.col("id") % 5).alias("k"), F.when(F.col("id") > 20, F.col("id")).alias("v"))
    out = scan.dealt(df, 95, "k", "v")
    assert out.rdd.getNumPartitions() == 10
    assert sorted(map(str, out.collect())) == sorted(map(str, df.collect()))


def test_ids_within_the_key_need_no_second_look(spark, scratch):
    spark.createDataFrame([(1, 1, "a"), (1, 1, "b"), (1, 2, "c"), (2, 1, "d"), (None, 1, "e"), (None, 1, "f"), (3, None, "g")],
                          "k long, n int, v string").write.parquet(scratch)
    out = purge_ambiguous(spark.read.parquet(scratch), ["k", "n"], "k")
    assert sorted(r.v for r in out.collect()) == ["d", "g"]
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Relation ") == 2, plan


def test_sync_writes_rows_once(spark, scratch, monkeypatch):
    table = keyed.KeyedTable(spark, scratch, ["k"], 16)
    table.sync(spark.range(100).select(F.col("id").alias("k"), F.lit("a").alias("v")))
    monkeypatch.setattr(keyed, "committed", lambda *_: pytest.fail("rows written aside"))
    done = table.sync(spark.range(1, 101).select(F.col("id").alias("k"), F.when(F.col("id") == 7, "b").otherwise("a").alias("v")))
    assert dict(done.actions) == {"inserted": 1, "updated": 1, "deleted": 1, "unchanged": 98}
    assert 0 < len(done.rewritten) <= 3
    before, after = table.manifest(1), table.manifest(2)
    assert {b for b in {*before, *after} if before.get(b) != after.get(b)} == set(done.rewritten)
    assert sorted(map(tuple, table.read().collect())) == [(k, "b" if k == 7 else "a") for k in range(1, 101)]
    assert table.sync(table.read()).version == 2


def test_cube_handles_texts_once_a_combination(spark, monkeypatch):
    """Rules and names see the combinations, of which there are two, however many rows there are."""
    seen = []
    tag = breakdown.by_rule
    monkeypatch.setattr(breakdown, "by_rule", lambda rows, rules: (seen.append(rows.count()), tag(rows, rules))[1])
    rows = spark.range(1000).select(F.col("id").alias("org"), F.when(F.col("id") % 2 == 0, "Glass").otherwise("GLASS").alias("material"), F.lit(1.0).alias("q"))
    out = breakdown.breakdown_cube(rows, [breakdown.Rule("all", filled=["material"], by=["material"])], ["org"], ["material"], F.col("q"), F.col("q") * 2)
    got = {r.level: 0 for r in out.collect()}
    assert seen == [2] and set(got) == {"member", "total", "scaffold"}
    assert [tuple(r) for r in out.filter("level = 'total'").collect()] == [("total", "all", None, "GLASS", 1000.0, 2000.0, 100.0, "up")]
    assert out.filter("level = 'member'").count() == 1000


def test_new_words_are_looked_up_not_walked():
    from docket.llm.toxicity import Scorer

    class Walked(Scorer):
        def __iter__(self):
            raise AssertionError("walked over all the words remembered")

    import numpy as np
    s = Walked.__new__(Walked)
    s.known = np.array([1.0, 2.0, 0.0], np.float32)
    s.update({b"a": 0, b"b": 1})
    s.learn = lambda new: (s.update({w: 2 for w in new}), s.known.__setitem__(2, 5.0))
    ratio, n = s.log_ratio([[b"b", b"a"], [], [b"c"]])
    assert ratio.tolist() == [2.0, 1.0, 5.0] and n.tolist() == [2, 0, 1]
