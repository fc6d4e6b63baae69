"""Rebinds: snapshot upserts (O-60, O-61)."""

from __future__ import annotations

from pyspark.sql import functions as F

from docket.operators.upsert import upsert_common_columns, upsert_full_sync
from docket.plans.registry import register
from docket.sources import read_table

_ORDER_COLS = ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate"]


def _halves(spark, sf):
    o = read_table(spark, sf, "orders", _ORDER_COLS)
    target = o.filter(F.col("o_orderdate") < F.lit("1999-01-01").cast("timestamp_ntz"))
    source = o.filter(F.col("o_orderdate") >= F.lit("1997-01-01").cast("timestamp_ntz")).withColumn(
        "o_totalprice", F.when(F.col("o_orderstatus") == "O", F.col("o_totalprice") + 1000.0)
                         .otherwise(F.col("o_totalprice")))
    return target, source


@register("upsert_full_sync", """
SELECT o_orderkey, o_custkey, o_orderstatus,
       CASE WHEN o_orderdate >= TIMESTAMP '1997-01-01' AND o_orderstatus = 'O' THEN o_totalprice + 1000.0
            ELSE o_totalprice END AS o_totalprice, o_orderdate
FROM orders
""")
def q_upsert_full_sync(spark, sf):
    target, source = _halves(spark, sf)
    merged, _ = upsert_full_sync(target, source, ["o_orderkey"], delete_missing=False)
    return merged


@register("upsert_action_counts", """
SELECT action, count(*) AS rows FROM (
  SELECT CASE WHEN o_orderdate < TIMESTAMP '1997-01-01' THEN 'deleted'
              WHEN o_orderdate >= TIMESTAMP '1999-01-01' THEN 'inserted'
              WHEN o_orderstatus = 'O' AND o_totalprice + 1000.0 <> o_totalprice THEN 'updated'
              ELSE 'unchanged' END AS action FROM orders)
GROUP BY action
""")
def q_upsert_action_counts(spark, sf):
    target, source = _halves(spark, sf)
    _, counts = upsert_full_sync(target, source, ["o_orderkey"], delete_missing=True)
    return counts


@register("upsert_common_columns", """
SELECT c_custkey, upper(c_name) AS c_name, c_nationkey,
       CASE WHEN c_mktsegment <> 'MACHINERY' THEN c_acctbal END AS c_acctbal, c_mktsegment
FROM customer
""")
def q_upsert_common_columns(spark, sf):
    c = read_table(spark, sf, "customer")
    target = c.filter(F.col("c_mktsegment") != "MACHINERY")
    source = c.drop("c_acctbal").withColumn("c_name", F.upper("c_name"))
    merged, _ = upsert_common_columns(target, source, ["c_custkey"])
    return merged
