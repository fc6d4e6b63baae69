"""Rebinds: expected-but-missing (O-35, O-37 .. O-39)."""

from __future__ import annotations

from pyspark.sql import functions as F

from docket.operators import gaps as G
from docket.functions.periods import year_quarter, year_quarters
from docket.functions.times import in_years
from docket.plans.registry import register
from docket.sources import read_table


@register("expected_grid", """
WITH yr AS (SELECT min(year(o_orderdate)) AS lo, max(year(o_orderdate)) AS hi FROM orders),
pr AS (SELECT y * 10 + q AS p FROM yr, range(lo, hi + 1) a(y), range(1, 5) b(q)),
g AS (SELECT c_custkey, p AS quarter FROM (SELECT DISTINCT c_custkey FROM customer), pr),
f AS (SELECT o_custkey, year(o_orderdate) * 10 + quarter(o_orderdate) AS quarter, count(*) AS n FROM orders GROUP BY ALL),
x AS (SELECT g.c_custkey, CAST(g.quarter AS INTEGER) AS quarter, COALESCE(f.n, 0) AS n_facts, COALESCE(f.n, 0) > 0 AS present
      FROM g LEFT JOIN f ON f.o_custkey = g.c_custkey AND f.quarter = g.quarter)
SELECT *, CAST(sum(CAST(present AS INTEGER)) OVER (PARTITION BY c_custkey) AS BIGINT) AS n_present,
       sum(CASE WHEN present THEN 1 ELSE 0 END) OVER (PARTITION BY c_custkey) = (SELECT count(*) FROM pr) AS all_present
FROM x
""")
def q_expected_grid(spark, sf):
    c = read_table(spark, sf, "customer", ["c_custkey"])
    o = read_table(spark, sf, "orders", ["o_custkey", "o_orderdate"])
    facts = o.select(F.col("o_custkey").alias("c_custkey"), year_quarter("o_orderdate").alias("quarter"))
    return G.expected_grid(c, "c_custkey", year_quarters(o, "o_orderdate"), "quarter", facts)


@register("unmatched", """
SELECT c_custkey, c_name FROM customer c
WHERE NOT EXISTS (SELECT 1 FROM orders o WHERE o.o_custkey = c.c_custkey AND year(o.o_orderdate) = 1998)
""")
def q_unmatched(spark, sf):
    c = read_table(spark, sf, "customer", ["c_custkey", "c_name"])
    o = read_table(spark, sf, "orders", ["o_custkey", "o_orderdate"])
    o98 = o.filter(in_years("o_orderdate", 1998)).select(F.col("o_custkey").alias("c_custkey"))
    return G.unmatched(c, o98, ["c_custkey"])


@register("repeat_submitters", """
SELECT c.c_custkey, c.c_name, x.n_files FROM customer c
JOIN (SELECT o_custkey, count(DISTINCT o_orderkey) AS n_files FROM orders GROUP BY o_custkey
      HAVING count(DISTINCT o_orderkey) > 10) x ON x.o_custkey = c.c_custkey
""")
def q_repeat_submitters(spark, sf):
    c = read_table(spark, sf, "customer", ["c_custkey", "c_name"])
    o = read_table(spark, sf, "orders", ["o_custkey", "o_orderkey"]).withColumnRenamed("o_custkey", "c_custkey")
    rep = G.repeat_submitters(o, "c_custkey", "o_orderkey", more_than=10)
    return c.join(rep, "c_custkey").select("c_custkey", "c_name", "n_files")


@register("error_report", """
WITH o AS (SELECT *, CAST(year(o_orderdate) * 10 + quarter(o_orderdate) AS INTEGER) AS p FROM orders),
l AS (SELECT *, CAST(year(l_shipdate) * 10 + quarter(l_shipdate) AS INTEGER) AS p FROM lineitem),
lo AS (SELECT l.*, ord.o_custkey FROM l JOIN orders ord ON ord.o_orderkey = l.l_orderkey),
oq AS (SELECT DISTINCT o_custkey, p FROM o),
lq AS (SELECT DISTINCT o_custkey, p FROM lo),
tot AS (SELECT l_orderkey, sum(l_extendedprice) AS s FROM lineitem GROUP BY l_orderkey)
SELECT DISTINCT * FROM (
  SELECT 'order_without_lines' AS error_type, CAST(o_orderkey AS VARCHAR) AS entity_key, p AS period
  FROM o WHERE NOT EXISTS (SELECT 1 FROM lineitem x WHERE x.l_orderkey = o.o_orderkey)
  UNION ALL
  SELECT 'lines_without_order', CAST(l_orderkey AS VARCHAR), p
  FROM l WHERE NOT EXISTS (SELECT 1 FROM orders x WHERE x.o_orderkey = l.l_orderkey)
  UNION ALL
  SELECT 'expected_period_missing', CAST(o_custkey AS VARCHAR), p FROM oq
  WHERE NOT EXISTS (SELECT 1 FROM lq WHERE lq.o_custkey = oq.o_custkey AND lq.p = oq.p)
  UNION ALL
  SELECT 'unexpected_period', CAST(o_custkey AS VARCHAR), p FROM lq
  WHERE NOT EXISTS (SELECT 1 FROM oq WHERE lq.o_custkey = oq.o_custkey AND lq.p = oq.p)
  UNION ALL
  SELECT 'total_mismatch', CAST(o.o_orderkey AS VARCHAR), o.p
  FROM o JOIN tot ON tot.l_orderkey = o.o_orderkey WHERE abs(o.o_totalprice - tot.s) > 0.01 * o.o_totalprice)
""")
def q_error_report(spark, sf):
    o = read_table(spark, sf, "orders", ["o_orderkey", "o_custkey", "o_orderdate", "o_totalprice"])
    li = read_table(spark, sf, "lineitem", ["l_orderkey", "l_shipdate", "l_extendedprice"])
    # lines per order once; the set of its periods is bounded by the calendar
    lines = li.groupBy("l_orderkey").agg(F.sum("l_extendedprice").alias("s"), F.collect_set(year_quarter("l_shipdate")).alias("ps"))
    x = o.withColumn("p", year_quarter("o_orderdate")).join(lines, o.o_orderkey == lines.l_orderkey, "full_outer")
    no_lines, no_order = F.col("l_orderkey").isNull(), F.col("o_orderkey").isNull()
    both = ~no_lines & ~no_order
    return G.error_report(x, direct=[
        ("order_without_lines", no_lines, F.col("o_orderkey"), F.array("p")),
        ("lines_without_order", no_order, F.col("l_orderkey"), F.col("ps")),
        ("total_mismatch", both & (F.abs(F.col("o_totalprice") - F.col("s")) > 0.01 * F.col("o_totalprice")), F.col("o_orderkey"), F.array("p"))],
        expected=(~no_order, F.col("o_custkey"), F.array("p")), found=(both, F.col("o_custkey"), F.col("ps")))
