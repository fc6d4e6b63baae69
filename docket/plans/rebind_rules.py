"""Rebinds: late fees, compliance rules, scheme totals, population, compliance grid."""

from __future__ import annotations

from pyspark.sql import functions as F

from docket.operators import rules as R
from docket.plans.registry import register
from docket.sources import read_table

_SIZE = "CASE WHEN o_orderpriority IN ('1-URGENT', '2-HIGH') THEN 'L' WHEN o_orderpriority = '5-LOW' THEN NULL ELSE 'S' END"


def _size():
    p = F.col("o_orderpriority")
    return F.when(p.isin("1-URGENT", "2-HIGH"), "L").when(p != "5-LOW", "S")


@register("late_fee", f"""
WITH x AS (SELECT *, {_SIZE} AS size, CAST(year(o_orderdate) AS INTEGER) AS y FROM orders),
k AS (SELECT o_custkey, y, min(o_orderdate) AS first_submission, max(o_orderdate) AS latest_application,
             max(CASE WHEN o_orderstatus = 'P' THEN o_orderdate END) AS resubmitted FROM x GROUP BY o_custkey, y),
m AS (SELECT x.o_orderkey, x.o_custkey, x.size, x.o_orderdate AS first_submitted, k.first_submission, k.latest_application, k.resubmitted,
             make_date(x.y, 7, 1) AS large, make_date(x.y, 10, 1) AS small,
             CASE WHEN x.o_orderkey % 3 = 0 THEN x.o_orderdate END AS joined, x.o_orderkey % 5 = 0 AS new_joiner
      FROM x JOIN k ON k.o_custkey = x.o_custkey AND k.y = x.y),
c AS (SELECT *, CASE size WHEN 'L' THEN large WHEN 'S' THEN small END AS cutoff,
             COALESCE(first_submission >= CASE WHEN size = 'L' THEN large WHEN size = 'S' THEN small ELSE large END, false) AS late,
             COALESCE(resubmitted >= large, false) AS resub_late FROM m)
SELECT o_orderkey, o_custkey, size, late AS is_late,
       CASE WHEN resubmitted IS NOT NULL THEN CASE WHEN new_joiner THEN resub_late ELSE late END
            WHEN latest_application < cutoff THEN false
            WHEN first_submission >= cutoff THEN true
            WHEN first_submitted > first_submission THEN joined IS NOT NULL
            WHEN size IN ('L', 'S') THEN COALESCE(first_submitted >= cutoff, false)
            ELSE late END AS late_fee
FROM c
""")
def q_late_fee(spark, sf):
    o = read_table(spark, sf, "orders", ["o_orderkey", "o_custkey", "o_orderdate", "o_orderstatus", "o_orderpriority"])
    x = o.withColumn("size", _size()).withColumn("y", F.year("o_orderdate"))
    k = x.groupBy("o_custkey", "y").agg(F.min("o_orderdate").alias("first_submission"), F.max("o_orderdate").alias("latest_application"),
                                        F.max(F.when(F.col("o_orderstatus") == "P", F.col("o_orderdate"))).alias("resubmitted"))
    x = x.join(k, ["o_custkey", "y"])
    large, small = F.make_date("y", F.lit(7), F.lit(1)), F.make_date("y", F.lit(10), F.lit(1))
    cutoff = R.journey_cutoff(F.lit(None).cast("string"), F.col("size"), F.lit(True), large, small)
    late = R.is_late(F.col("first_submission"), cutoff)
    key = F.col("o_orderkey")
    fee = R.member_late_fee(F.col("size"), large, small, F.col("resubmitted"), key % 5 == 0, R.is_late(F.col("resubmitted"), large), late,
                            F.col("latest_application"), F.col("first_submission"), F.col("o_orderdate"), F.when(key % 3 == 0, F.col("o_orderdate")))
    return x.select("o_orderkey", "o_custkey", "size", late.alias("is_late"), fee.alias("late_fee"))


@register("compliance_rules", f"""
WITH l AS (SELECT l_orderkey, sum(l_quantity) * 500 AS weight, bool_or(l_returnflag = 'R') AS hh FROM lineitem GROUP BY l_orderkey),
x AS (SELECT o_orderkey, {_SIZE} AS size, o_orderstatus = 'F' AS liable, COALESCE(l.hh, false) AS has_household, COALESCE(l.weight, 0.0) AS weight
      FROM orders LEFT JOIN l ON l.l_orderkey = o_orderkey)
SELECT o_orderkey, size, round(weight, 2) AS weight,
       CASE WHEN (liable AND has_household AND COALESCE(size, '') <> 'S') OR (NOT liable AND NOT has_household) THEN 'Compliant' ELSE 'Non Compliant' END AS liability,
       CASE WHEN size = 'S' AND weight > 50000 THEN 'Non Compliant' WHEN size = 'S' AND weight <= 50000 THEN 'Compliant' ELSE 'N/A' END AS small_producer
FROM x
""")
def q_compliance_rules(spark, sf):
    o = read_table(spark, sf, "orders", ["o_orderkey", "o_orderstatus", "o_orderpriority"])
    li = read_table(spark, sf, "lineitem", ["l_orderkey", "l_quantity", "l_returnflag"])
    lines = li.groupBy("l_orderkey").agg((F.sum("l_quantity") * 500).alias("weight"), F.max(F.col("l_returnflag") == "R").alias("hh"))
    x = o.join(lines, o.o_orderkey == lines.l_orderkey, "left").withColumn("size", _size())
    weight = F.coalesce("weight", F.lit(0.0))
    return x.select("o_orderkey", "size", F.round(weight, 2).alias("weight"),
                    R.liability_flag(F.col("o_orderstatus") == "F", F.coalesce("hh", F.lit(False)), F.col("size")).alias("liability"),
                    R.small_producer_flag(weight, F.col("size")).alias("small_producer"))


@register("scheme_totals", """
WITH amt AS (SELECT 'n' || s_nationkey AS org, s_acctbal AS a FROM supplier
             UNION ALL SELECT 'c' || c_custkey, c_acctbal FROM customer UNION ALL SELECT 'r' || r_regionkey, 1000.0 * r_regionkey FROM region),
direct AS (SELECT DISTINCT 'r' || n_regionkey AS s, 'n' || n_nationkey AS o FROM nation),
pairs AS (SELECT * FROM direct UNION SELECT d.s, 'c' || c_custkey FROM direct d JOIN customer ON 'n' || c_nationkey = d.o UNION SELECT s, s FROM direct)
SELECT p.s AS scheme_id, round(COALESCE(sum(t.a), 0.0), 2) AS total, count(*) AS n_orgs
FROM pairs p LEFT JOIN (SELECT org, sum(a) AS a FROM amt GROUP BY org) t ON t.org = p.o GROUP BY p.s
""")
def q_scheme_totals(spark, sf):
    def org(kind, col):
        return F.concat(F.lit(kind), F.col(col).cast("string"))
    n = read_table(spark, sf, "nation", ["n_nationkey", "n_regionkey"])
    c = read_table(spark, sf, "customer", ["c_custkey", "c_nationkey", "c_acctbal"])
    s = read_table(spark, sf, "supplier", ["s_nationkey", "s_acctbal"])
    r = read_table(spark, sf, "region", ["r_regionkey"])
    amounts = (s.select(org("n", "s_nationkey").alias("org"), F.col("s_acctbal").alias("a"))
               .unionByName(c.select(org("c", "c_custkey").alias("org"), F.col("c_acctbal").alias("a")))
               .unionByName(r.select(org("r", "r_regionkey").alias("org"), (F.lit(1000.0) * F.col("r_regionkey")).alias("a"))))
    return R.scheme_totals(n.select(org("r", "n_regionkey").alias("scheme"), org("n", "n_nationkey").alias("member")), "scheme", "member",
                           c.select(org("n", "c_nationkey").alias("p"), org("c", "c_custkey").alias("c")), "p", "c", amounts, "org", "a")


@register("next_year_population", """
WITH x AS (SELECT o_custkey, CASE WHEN o_orderpriority = '5-LOW' THEN NULL ELSE o_orderpriority END AS submitter, o_orderstatus,
                  CAST(year(o_orderdate) AS INTEGER) AS year, CASE WHEN month(o_orderdate) <= 6 THEN 1 ELSE 2 END AS h FROM orders),
ob AS (SELECT DISTINCT o_custkey, submitter, year FROM x),
f AS (SELECT o_custkey, submitter, year + 1 AS year, bool_or(h = 1) AS h1, bool_or(h = 2) AS h2 FROM x WHERE o_orderstatus = 'F' GROUP BY ALL)
SELECT ob.*, COALESCE(f.h1, false) AS has_h1, COALESCE(f.h2, false) AS has_h2 FROM ob
LEFT JOIN f ON f.o_custkey = ob.o_custkey AND f.submitter IS NOT DISTINCT FROM ob.submitter AND f.year = ob.year
""")
def q_next_year_population(spark, sf):
    o = read_table(spark, sf, "orders", ["o_orderkey", "o_custkey", "o_orderdate", "o_orderstatus", "o_orderpriority"])
    x = o.withColumn("submitter", F.when(F.col("o_orderpriority") != "5-LOW", F.col("o_orderpriority"))).withColumn("year", F.year("o_orderdate"))
    obligations = x.select("o_custkey", "submitter", "year").distinct()
    return R.next_year_population(obligations, x, ["o_custkey", "submitter"], "year", F.when(F.month("o_orderdate") <= 6, 1).otherwise(2),
                                  F.col("o_orderstatus") == "F", ["o_orderdate", "o_orderkey"])


@register("compliance_grid", """
WITH x AS (SELECT *, CAST(year(o_orderdate) AS INTEGER) AS year, CASE WHEN month(o_orderdate) <= 6 THEN 1 ELSE 2 END AS period FROM orders),
r AS (SELECT *, row_number() OVER (PARTITION BY o_custkey, year, period ORDER BY o_orderdate DESC, o_orderkey DESC) AS rp,
             row_number() OVER (PARTITION BY o_custkey, year ORDER BY o_orderdate DESC, o_orderkey DESC) AS ry FROM x),
p AS (SELECT o_custkey, year, period, min(o_orderdate) AS first_date, max(o_orderdate) AS latest_date,
             max(CASE WHEN rp = 1 THEN o_orderstatus END) AS latest_status, count(*) AS n_files FROM r GROUP BY o_custkey, year, period),
s AS (SELECT o_custkey, year, o_orderpriority AS latest_scheme, o_totalprice FROM r WHERE ry = 1),
ob AS (SELECT o_custkey, year, round(sum(o_totalprice), 2) AS obligation FROM x GROUP BY o_custkey, year)
SELECT p.*, s.latest_scheme, ob.obligation, make_date(p.year, CASE p.period WHEN 1 THEN 4 ELSE 10 END, 1) AS deadline,
       p.first_date <= make_date(p.year, CASE p.period WHEN 1 THEN 4 ELSE 10 END, 1) AS deadline_met
FROM p JOIN s ON s.o_custkey = p.o_custkey AND s.year = p.year JOIN ob ON ob.o_custkey = p.o_custkey AND ob.year = p.year
""")
def q_compliance_grid(spark, sf):
    o = read_table(spark, sf, "orders", ["o_orderkey", "o_custkey", "o_orderdate", "o_orderstatus", "o_orderpriority", "o_totalprice"])
    x = o.withColumn("year", F.year("o_orderdate"))
    obligation = x.groupBy("o_custkey", "year").agg(F.round(F.sum("o_totalprice"), 2).alias("obligation"))
    return R.compliance_grid(x, "o_custkey", "year", F.when(F.month("o_orderdate") <= 6, 1).otherwise(2), "o_orderdate", "o_orderstatus",
                             "o_orderpriority", ["o_orderdate", "o_orderkey"],
                             F.make_date("year", F.when(F.col("period") == 1, 4).otherwise(10), F.lit(1)), obligation)
