"""Rebinds: aggregation (O-36, O-40 .. O-50)."""

from __future__ import annotations

from pyspark.sql import functions as F


from docket.functions.scan import dealt
from docket.operators import measures as M
from docket.operators.events import size_deadline
from docket.plans.rebind_events import CALENDAR_SQL
from docket.plans.registry import register
from docket.sources import read_table

# Full-period factors per return flag (the x1.5 / x2 / x3 variant).
FACTORS = {"A": 1.5, "N": 2.0, "R": 3.0}


@register("extrapolate", """
SELECT l_orderkey, l_linenumber, l_returnflag,
       CAST(l_quantity * CASE l_returnflag WHEN 'A' THEN 1.5 WHEN 'N' THEN 2.0 WHEN 'R' THEN 3.0 ELSE 1.0 END
            AS DECIMAL(16, 2)) AS extrapolated_qty
FROM lineitem
""")
def q_extrapolate(spark, sf):
    li = read_table(spark, sf, "lineitem", ["l_orderkey", "l_linenumber", "l_returnflag", "l_quantity"])
    return M.extrapolate(li, "l_quantity", "l_returnflag", FACTORS, "extrapolated_qty").drop("l_quantity")


@register("extrapolate_moves", """
SELECT l_orderkey, l_linenumber, CAST(round(CAST(l_quantity * CASE l_returnflag WHEN 'A' THEN 1.5 WHEN 'N' THEN 2.0 ELSE 1.0 END AS DECIMAL(16, 2)), 0) AS BIGINT) AS whole_qty,
       CASE WHEN l_returnflag <> 'R' AND l_linestatus IS NOT NULL
            THEN CASE l_returnflag WHEN 'A' THEN 'Accepted' ELSE '' END || ' to ' || CASE l_linestatus WHEN 'F' THEN 'Finished' ELSE 'Open' END END AS move,
       CASE WHEN l_returnflag IN ('A', 'R') AND l_linenumber > 2 THEN l_returnflag || ' - ' || l_linenumber ELSE l_returnflag END AS material
FROM lineitem
""")
def q_extrapolate_moves(spark, sf):
    li = read_table(spark, sf, "lineitem", ["l_orderkey", "l_linenumber", "l_quantity", "l_returnflag", "l_linestatus"])
    x = M.extrapolate(li, "l_quantity", "l_returnflag", {"A": 1.5, "N": 2.0}, "whole_qty", rounded=True)
    x = x.withColumn("from_code", F.when(F.col("l_returnflag") != "R", F.col("l_returnflag")))
    x = x.withColumn("sub", F.when(F.col("l_linenumber") > 2, F.col("l_linenumber").cast("string")))
    return x.select("l_orderkey", "l_linenumber", "whole_qty", M.relative_move("from_code", "l_linestatus", {"A": "Accepted", "F": "Finished", "O": "Open"}).alias("move"),
                    M.split_material("l_returnflag", "sub", ["A", "R"]).alias("material"))


@register("json_payload", """
WITH n AS (SELECT l_returnflag, l_orderkey, l_linenumber, l_partkey,
                  (row_number() OVER (PARTITION BY l_returnflag ORDER BY l_orderkey, l_linenumber, l_partkey) - 1) // 1000 AS page
           FROM lineitem)
SELECT l_returnflag, CAST(page AS BIGINT) AS page, count(*) AS n_members,
       '[' || string_agg('{"l_orderkey":' || l_orderkey || ',"l_linenumber":' || l_linenumber || ',"l_partkey":' || l_partkey || '}', ','
                         ORDER BY l_orderkey, l_linenumber, l_partkey) || ']' AS members_json
FROM n GROUP BY l_returnflag, page
""")
def q_json_payload(spark, sf):
    li = read_table(spark, sf, "lineitem", ["l_returnflag", "l_orderkey", "l_linenumber", "l_partkey"])
    return M.json_payload(li, ["l_returnflag"], ["l_orderkey", "l_linenumber", "l_partkey"], "members_json")


@register("complete_period_weights", """
WITH f AS (SELECT o_custkey, CAST(year(o_orderdate) AS INTEGER) AS year, CAST(quarter(o_orderdate) AS INTEGER) AS quarter, o_orderkey, o_orderdate
           FROM orders WHERE quarter(o_orderdate) IN (1, 2)),
ok AS (SELECT o_custkey, year FROM f GROUP BY o_custkey, year HAVING count(DISTINCT quarter) = 2),
n AS (SELECT * FROM (SELECT f.*, row_number() OVER (PARTITION BY f.o_custkey, f.year, f.quarter
                                                    ORDER BY o_orderdate DESC, o_orderkey DESC) rn
                     FROM f JOIN ok ON f.o_custkey = ok.o_custkey AND f.year = ok.year) WHERE rn = 1),
w AS (SELECT l_orderkey, sum(l_quantity) AS w, sum(CASE WHEN l_returnflag = 'R' THEN l_quantity ELSE 0.0 END) AS d
      FROM lineitem GROUP BY l_orderkey)
SELECT n.o_custkey, n.year, n.quarter, n.o_orderkey, n.o_orderdate,
       round((COALESCE(w.w, 0.0) - COALESCE(w.d, 0.0)) / 1000.0, 3) AS net_weight_t
FROM n LEFT JOIN w ON w.l_orderkey = n.o_orderkey
""")
def q_complete_period_weights(spark, sf):
    o = read_table(spark, sf, "orders", ["o_custkey", "o_orderkey", "o_orderdate"]) \
        .withColumn("year", F.year("o_orderdate")).withColumn("quarter", F.quarter("o_orderdate"))
    li = read_table(spark, sf, "lineitem", ["l_orderkey", "l_quantity", "l_returnflag"])
    return M.complete_period_weights(o, "o_custkey", "year", "quarter", [1, 2],
                                     [F.col("o_orderdate").desc(), F.col("o_orderkey").desc()], "o_orderkey",
                                     li, "l_orderkey", F.col("l_quantity"), F.col("l_returnflag") == "R")


@register("half_year_population", """
WITH x AS (SELECT *, CAST(year(o_orderdate) AS INTEGER) AS year FROM orders),
a AS (SELECT o_custkey, year, bool_or(o_orderstatus = 'F' AND month(o_orderdate) <= 6) AS has_h1,
             bool_or(o_orderstatus = 'F' AND month(o_orderdate) > 6) AS has_h2,
             CAST(min(o_orderdate) AS DATE) AS first_date FROM x GROUP BY o_custkey, year),
l AS (SELECT o_custkey, year, o_orderkey AS latest_file FROM (
        SELECT *, row_number() OVER (PARTITION BY o_custkey, year ORDER BY o_orderdate DESC, o_orderkey DESC) rn
        FROM x WHERE o_orderstatus = 'F') WHERE rn = 1)
SELECT a.o_custkey, a.year, l.latest_file, a.has_h1, a.has_h2, a.first_date,
       CAST(datediff('day', a.first_date, make_date(a.year, 12, 31)) + 1 AS INTEGER) AS obligated_days
FROM a JOIN l ON a.o_custkey = l.o_custkey AND a.year = l.year
""")
def q_half_year_population(spark, sf):
    o = read_table(spark, sf, "orders", ["o_custkey", "o_orderkey", "o_orderdate", "o_orderstatus"])
    return M.half_year_population(o, "o_custkey", "o_orderdate", F.col("o_orderstatus") == "F",
                                  ["o_orderdate", "o_orderkey"], "o_orderkey")


_FLAGS, _STATUSES = ["A", "N", "R"], ["F", "O"]


def _pivot_sql():
    cols = []
    for f in _FLAGS:
        for s in _STATUSES:
            cond = f"l_returnflag = '{f}' AND l_linestatus = '{s}'"
            cols.append(f"round(COALESCE(sum(CASE WHEN {cond} THEN l_quantity END), 0.0), 2) AS qty_{f}_{s}")
    for f in _FLAGS:
        for s in _STATUSES:
            cond = f"l_returnflag = '{f}' AND l_linestatus = '{s}'"
            cols.append(f"count(CASE WHEN {cond} THEN 1 END) AS n_{f}_{s}")
    return "SELECT l_orderkey, " + ", ".join(cols) + " FROM lineitem GROUP BY l_orderkey"


@register("weight_pivots", _pivot_sql())
def q_weight_pivots(spark, sf):
    li = read_table(spark, sf, "lineitem", ["l_orderkey", "l_returnflag", "l_linestatus", "l_quantity"])
    return M.weight_pivots(li, ["l_orderkey"], [("l_returnflag", _FLAGS), ("l_linestatus", _STATUSES)],
                           {"qty": F.col("l_quantity"), "n": None})


_TYPES = ["view", "click", "purchase", "signup", "error"]


@register("status_dates", "SELECT user_id, " + ", ".join(
    f"CAST(max(CASE WHEN event_type = '{t}' THEN ts END) AS DATE) AS {t}_date, "
    f"strftime(max(CASE WHEN event_type = '{t}' THEN ts END), '%H:%M:%S') AS {t}_time" for t in _TYPES)
    + " FROM events GROUP BY user_id")
def q_status_dates(spark, sf):
    ev = read_table(spark, sf, "events", ["user_id", "event_type", "ts"])
    return M.status_dates(ev, "user_id", "event_type", "ts", _TYPES)


@register("child_counts", """
WITH a AS (SELECT l_orderkey, count(*) AS n_lines, count(DISTINCT l_partkey) AS n_parts,
                  count(CASE WHEN l_returnflag = 'R' THEN 1 END) AS n_returned FROM lineitem GROUP BY l_orderkey)
SELECT o.o_orderkey, o.o_orderstatus, c.c_name, COALESCE(a.n_lines, 0) AS n_lines, COALESCE(a.n_parts, 0) AS n_parts,
       COALESCE(a.n_returned, 0) AS n_returned
FROM orders o LEFT JOIN customer c ON c.c_custkey = o.o_custkey LEFT JOIN a ON a.l_orderkey = o.o_orderkey
""")
def q_child_counts(spark, sf):
    o = read_table(spark, sf, "orders", ["o_orderkey", "o_orderstatus", "o_custkey"])
    c = read_table(spark, sf, "customer", ["c_custkey", "c_name"])
    li = read_table(spark, sf, "lineitem", ["l_orderkey", "l_partkey", "l_returnflag"])
    parents = o.join(c, o.o_custkey == c.c_custkey, "left").select("o_orderkey", "o_orderstatus", "c_name")
    return M.child_counts(parents, "o_orderkey", li, "l_orderkey", {
        "n_lines": F.count(F.lit(1)), "n_parts": F.count_distinct("l_partkey"),
        "n_returned": F.count(F.when(F.col("l_returnflag") == "R", 1))})


@register("obligation_balance", """
WITH l AS (SELECT l.*, p.p_brand, CAST(year(l_shipdate) AS INTEGER) AS year FROM lineitem l JOIN part p ON p.p_partkey = l.l_partkey),
ob AS (SELECT l_suppkey, p_brand, year, sum(l_quantity) AS required FROM l WHERE l_linestatus = 'O' GROUP BY ALL),
cr AS (SELECT l_suppkey, p_brand, year,
              sum(CASE WHEN l_returnflag = 'A' THEN l_quantity ELSE 0.0 END) AS accepted,
              sum(CASE WHEN l_returnflag = 'N' THEN l_quantity ELSE 0.0 END) AS awaiting
       FROM l WHERE l_linestatus = 'F' GROUP BY ALL),
x AS (SELECT COALESCE(ob.l_suppkey, cr.l_suppkey) AS l_suppkey, COALESCE(ob.p_brand, cr.p_brand) AS p_brand,
             COALESCE(ob.year, cr.year) AS year, round(COALESCE(required, 0.0), 2) AS required,
             round(COALESCE(accepted, 0.0), 2) AS accepted, round(COALESCE(awaiting, 0.0), 2) AS awaiting
      FROM ob FULL JOIN cr ON ob.l_suppkey = cr.l_suppkey AND ob.p_brand = cr.p_brand AND ob.year = cr.year)
SELECT *, round(required - accepted - awaiting, 2) AS remaining,
       CASE WHEN round(required - accepted - awaiting, 2) <= 0 THEN 'Met' ELSE 'Not Met' END AS status FROM x
""")
def q_obligation_balance(spark, sf):
    li = read_table(spark, sf, "lineitem", ["l_partkey", "l_suppkey", "l_shipdate", "l_quantity",
                                            "l_returnflag", "l_linestatus"])
    p = read_table(spark, sf, "part", ["p_partkey", "p_brand"])
    rows = li.filter(F.col("l_linestatus").isin("O", "F")).withColumn("year", F.year("l_shipdate"))
    keys = ["l_suppkey", "p_brand", "year"]
    # lines hardly ever share part, supplier and year: no aggregate before the join, and one by key on partitions of a bounded size after it
    x = dealt(rows.join(p, F.col("l_partkey") == F.col("p_partkey")), li.count(), *keys)
    q = lambda status, flag=None: F.when((F.col("l_linestatus") == status) & (F.lit(flag is None) | (F.col("l_returnflag") == flag)), F.col("l_quantity"))
    return M.obligation_balance(x, keys, q("O"), q("F", "A"), q("F", "N"))


@register("obligation_newest", """
WITH x AS (SELECT *, CAST(year(o_orderdate) AS INTEGER) AS year,
                  row_number() OVER (PARTITION BY o_custkey, year(o_orderdate), o_orderstatus ORDER BY o_orderdate DESC, o_orderkey DESC) AS rn
           FROM orders),
a AS (SELECT o_custkey, year, round(COALESCE(max(CASE WHEN o_orderstatus = 'O' AND rn = 1 THEN o_totalprice END), 0.0), 2) AS required,
             round(COALESCE(max(CASE WHEN o_orderstatus = 'F' AND rn = 1 THEN o_totalprice END), 0.0), 2) AS accepted
      FROM x GROUP BY o_custkey, year)
SELECT *, round(required - accepted - 0.0, 2) AS remaining, CASE WHEN round(required - accepted - 0.0, 2) <= 0 THEN 'Met' ELSE 'Not Met' END AS status FROM a
""")
def q_obligation_newest(spark, sf):
    o = read_table(spark, sf, "orders", ["o_custkey", "o_orderkey", "o_orderdate", "o_orderstatus", "o_totalprice"])
    return M.newest_balance(o.withColumn("year", F.year("o_orderdate")), ["o_custkey", "year"], ["o_orderdate", "o_orderkey"],
                            F.col("o_orderstatus") == "O", F.col("o_orderstatus") == "F", F.col("o_totalprice"))


@register("hierarchy_rollup", """
WITH c AS (SELECT c.c_custkey, c.c_nationkey, n.n_regionkey, COALESCE(o.rev, 0.0) AS rev
           FROM customer c JOIN nation n ON n.n_nationkey = c.c_nationkey
           LEFT JOIN (SELECT o_custkey, sum(o_totalprice) AS rev FROM orders GROUP BY o_custkey) o ON o.o_custkey = c.c_custkey),
p AS (SELECT 'region' AS level, CAST(n_regionkey AS BIGINT) AS node_id, rev FROM c
      UNION ALL SELECT 'nation', CAST(c_nationkey AS BIGINT), rev FROM c
      UNION ALL SELECT 'customer', c_custkey, rev FROM c)
SELECT level, node_id, round(sum(rev), 2) AS total_revenue, count(*) AS n_customers FROM p GROUP BY level, node_id
""")
def q_hierarchy_rollup(spark, sf):
    c = read_table(spark, sf, "customer", ["c_custkey", "c_nationkey"])
    n = read_table(spark, sf, "nation", ["n_nationkey", "n_regionkey"])
    o = read_table(spark, sf, "orders", ["o_custkey", "o_totalprice"])
    rev = o.groupBy("o_custkey").agg(F.sum("o_totalprice").alias("rev"))
    x = (c.join(n, c.c_nationkey == n.n_nationkey)
          .join(rev, c.c_custkey == rev.o_custkey, "left")
          .withColumn("rev", F.coalesce("rev", F.lit(0.0))))
    out = M.hierarchy_rollup(x, [("region", "n_regionkey"), ("nation", "c_nationkey"), ("customer", "c_custkey")],
                             {"total_revenue": F.sum("rev"), "n_customers": F.count(F.lit(1))})
    return out.withColumn("total_revenue", F.round("total_revenue", 2))


@register("compliance_report", f"""
WITH x AS (SELECT *, CAST(year(o_orderdate) AS INTEGER) AS year FROM orders),
a AS (SELECT o_custkey, year, min(o_orderdate) AS first_date, max(o_orderdate) AS latest_date, count(*) AS n_orders,
             CASE WHEN bool_or(o_orderpriority IN ('1-URGENT', '2-HIGH')) THEN 'large' ELSE 'small' END AS size
      FROM x GROUP BY o_custkey, year),
l AS (SELECT o_custkey, year, o_orderstatus AS latest_status FROM (
        SELECT *, row_number() OVER (PARTITION BY o_custkey, year ORDER BY o_orderdate DESC, o_orderkey DESC) rn FROM x)
      WHERE rn = 1),
cal AS ({CALENDAR_SQL})
SELECT a.o_custkey, a.year, a.first_date, a.latest_date, l.latest_status, a.n_orders, a.size, cal.deadline,
       a.first_date < cal.deadline AS on_time
FROM a JOIN l ON a.o_custkey = l.o_custkey AND a.year = l.year
LEFT JOIN cal ON cal.size = a.size AND cal.year = a.year
""")
def q_compliance_report(spark, sf):
    o = read_table(spark, sf, "orders", ["o_custkey", "o_orderkey", "o_orderdate", "o_orderstatus", "o_orderpriority"])
    x = o.withColumn("year", F.year("o_orderdate"))
    a = x.groupBy("o_custkey", "year").agg(
        F.min("o_orderdate").alias("first_date"), F.max("o_orderdate").alias("latest_date"),
        F.max_by("o_orderstatus", F.struct("o_orderdate", "o_orderkey")).alias("latest_status"),
        F.count(F.lit(1)).alias("n_orders"),
        F.when(F.max(F.col("o_orderpriority").isin("1-URGENT", "2-HIGH")), F.lit("large"))
         .otherwise(F.lit("small")).alias("size"))
    out = a.withColumn("deadline", size_deadline(F.col("size"), F.col("year"), 1998))
    return out.withColumn("on_time", F.col("first_date") < F.col("deadline")).select(
        "o_custkey", "year", "first_date", "latest_date", "latest_status", "n_orders", "size", "deadline", "on_time")


@register("concat_labels", """
SELECT user_id, string_agg(DISTINCT event_type, ',' ORDER BY event_type) AS event_types FROM events GROUP BY user_id
""")
def q_concat_labels(spark, sf):
    ev = read_table(spark, sf, "events", ["user_id", "event_type"])
    return M.concat_labels(ev, ["user_id"], "event_type", "event_types")


@register("share_of_total", """
WITH g AS (SELECT l_orderkey, l_returnflag, sum(l_extendedprice) AS revenue FROM lineitem GROUP BY ALL)
SELECT l_orderkey, l_returnflag, round(revenue, 2) AS revenue,
       round(sum(revenue) OVER (PARTITION BY l_orderkey), 2) AS revenue_total,
       round(revenue / sum(revenue) OVER (PARTITION BY l_orderkey), 4) AS share
FROM g
""")
def q_share_of_total(spark, sf):
    li = read_table(spark, sf, "lineitem", ["l_orderkey", "l_returnflag", "l_extendedprice"])
    return M.share_of_total(li, ["l_orderkey"], "l_returnflag", F.col("l_extendedprice"), "revenue")


@register("obligation_lines", """
WITH rev AS (SELECT 'customer-' || o_custkey AS org, sum(o_totalprice) AS amt FROM orders GROUP BY o_custkey),
edges AS (SELECT 'nation-' || c_nationkey AS p, 'customer-' || c_custkey AS c FROM customer),
tot AS (SELECT e.p AS org, round(COALESCE(sum(r.amt), 0.0), 2) AS obligation
        FROM edges e LEFT JOIN rev r ON r.org = e.c GROUP BY e.p),
cr AS (SELECT 'nation-' || s_nationkey AS org, sum(s_acctbal) AS credit FROM supplier GROUP BY s_nationkey),
lines AS (SELECT t.org AS parent_id, 'parent' AS line_type, t.org AS org_id, t.obligation FROM tot t
          UNION ALL SELECT p, 'child', c, 0.0 FROM edges)
SELECT l.*, CASE WHEN line_type = 'parent' THEN round(COALESCE(cr.credit, 0.0), 2) ELSE 0.0 END AS credit,
       CASE WHEN line_type = 'parent' THEN round(obligation - round(COALESCE(cr.credit, 0.0), 2), 2) ELSE 0.0 END AS remaining
FROM lines l LEFT JOIN cr ON cr.org = l.parent_id
""")
def q_obligation_lines(spark, sf):
    c = read_table(spark, sf, "customer", ["c_custkey", "c_nationkey"])
    o = read_table(spark, sf, "orders", ["o_custkey", "o_totalprice"])
    s = read_table(spark, sf, "supplier", ["s_nationkey", "s_acctbal"])

    def org_id(kind, col):
        return F.concat(F.lit(f"{kind}-"), F.col(col).cast("string"))
    edges = c.select(org_id("nation", "c_nationkey").alias("parent"), org_id("customer", "c_custkey").alias("child"))
    amounts = o.groupBy(org_id("customer", "o_custkey").alias("org")).agg(F.sum("o_totalprice").alias("amount"))
    credits = s.groupBy(org_id("nation", "s_nationkey").alias("org")).agg(F.sum("s_acctbal").alias("credit"))
    return M.obligation_lines(edges, "parent", "child", amounts, "org", "amount", credits, "credit")
