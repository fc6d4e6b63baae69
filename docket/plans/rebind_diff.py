"""Rebinds: comparison (O-51 .. O-57)."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from docket.functions.text import ci
from docket.operators import diff as D
from docket.operators.breakdown import breakdown_cube, read_drill, write_drill
from docket.operators.latest import latest_per_key
from docket.functions.times import in_years
from docket.plans.packaging_breakdowns import BREAKDOWNS, DIMS, DRILLS
from docket.plans.registry import register
from docket.session import scratch_path
from docket.sources import read_table


def _year_orders(spark, sf, year):
    o = read_table(spark, sf, "orders", ["o_orderkey", "o_custkey", "o_orderpriority", "o_orderstatus",
                                         "o_totalprice", "o_orderdate"])
    return o.filter(in_years("o_orderdate", year))


def _diff_97_98(spark, sf):
    out = D.diff_measures(_year_orders(spark, sf, 1997), _year_orders(spark, sf, 1998),
                          ["o_custkey", "o_orderpriority"],
                          {"total": F.round(F.sum("o_totalprice"), 2), "n": F.count(F.lit(1))},
                          null_keys="match", key_kinds={"o_custkey": "number"})
    return out.withColumn("total_diff", F.round("total_diff", 2))


DIFF_SQL = """
a AS (SELECT COALESCE(o_custkey, 0) AS o_custkey, COALESCE(o_orderpriority, '') AS o_orderpriority,
             round(sum(o_totalprice), 2) AS total, count(*) AS n
      FROM orders WHERE year(o_orderdate) = 1997 GROUP BY ALL),
b AS (SELECT COALESCE(o_custkey, 0) AS o_custkey, COALESCE(o_orderpriority, '') AS o_orderpriority,
             round(sum(o_totalprice), 2) AS total, count(*) AS n
      FROM orders WHERE year(o_orderdate) = 1998 GROUP BY ALL),
d AS (SELECT COALESCE(a.o_custkey, b.o_custkey) AS o_custkey, COALESCE(a.o_orderpriority, b.o_orderpriority) AS o_orderpriority,
        a.total AS total_1, b.total AS total_2, round(COALESCE(b.total, 0) - COALESCE(a.total, 0), 2) AS total_diff,
        a.n AS n_1, b.n AS n_2, COALESCE(b.n, 0) - COALESCE(a.n, 0) AS n_diff,
        CASE WHEN a.o_custkey IS NULL THEN 'added' WHEN b.o_custkey IS NULL THEN 'removed'
             WHEN a.total IS NOT DISTINCT FROM b.total AND a.n = b.n THEN 'unchanged' ELSE 'changed' END AS change_class
      FROM a FULL JOIN b ON a.o_custkey = b.o_custkey AND a.o_orderpriority = b.o_orderpriority)
"""


@register("diff_measures", "WITH " + DIFF_SQL + " SELECT * FROM d")
def q_diff_measures(spark, sf):
    return _diff_97_98(spark, sf)


@register("diff_breakdowns", "WITH " + DIFF_SQL + """,
r AS (SELECT d.*, c.c_mktsegment, n.n_name FROM d JOIN customer c ON c.c_custkey = d.o_custkey
      JOIN nation n ON n.n_nationkey = c.c_nationkey),
e AS (SELECT 'segment' AS breakdown, c_mktsegment AS dim_value, total_1, total_2 FROM r
      UNION ALL SELECT 'priority', o_orderpriority, total_1, total_2 FROM r
      UNION ALL SELECT 'nation', n_name, total_1, total_2 FROM r
      UNION ALL SELECT 'total', 'ALL', total_1, total_2 FROM r
      UNION ALL SELECT 'urgent_by_segment', c_mktsegment, total_1, total_2 FROM r WHERE o_orderpriority = '1-URGENT'),
g AS (SELECT breakdown, dim_value, sum(COALESCE(total_1, 0.0)) AS s1, sum(COALESCE(total_2, 0.0)) AS s2 FROM e GROUP BY ALL),
sc AS (SELECT DISTINCT 'segment' AS breakdown, c_mktsegment AS dim_value FROM customer
       UNION SELECT DISTINCT 'urgent_by_segment', c_mktsegment FROM customer
       UNION SELECT DISTINCT 'priority', o_orderpriority FROM orders
       UNION SELECT DISTINCT 'nation', n_name FROM nation
       UNION SELECT 'total', 'ALL'),
x AS (SELECT sc.breakdown, sc.dim_value, round(COALESCE(g.s1, 0.0), 2) AS s1, round(COALESCE(g.s2, 0.0), 2) AS s2
      FROM sc LEFT JOIN g ON g.breakdown = sc.breakdown AND g.dim_value = sc.dim_value),
y AS (SELECT *, round(s2 - s1, 2) AS value_change,
             CASE WHEN s1 = 0 OR s2 = 0 OR s1 = s2 THEN 0.0 ELSE round((s2 - s1) / s1 * 100, 2) END AS pct_change FROM x)
SELECT *, CASE WHEN pct_change >= 10 THEN 'up' WHEN pct_change <= -10 THEN 'down' ELSE 'flat' END AS arrow FROM y
""")
def q_diff_breakdowns(spark, sf):
    d = _diff_97_98(spark, sf)
    c = read_table(spark, sf, "customer", ["c_custkey", "c_mktsegment", "c_nationkey"])
    n = read_table(spark, sf, "nation", ["n_nationkey", "n_name"])
    rows = d.join(c, d.o_custkey == c.c_custkey).join(n, c.c_nationkey == n.n_nationkey)
    always = F.lit(True)
    breakdowns = [("segment", always, F.col("c_mktsegment")), ("priority", always, F.col("o_orderpriority")),
                  ("nation", always, F.col("n_name")), ("total", always, F.lit("ALL")),
                  ("urgent_by_segment", F.col("o_orderpriority") == "1-URGENT", F.col("c_mktsegment"))]
    o = read_table(spark, sf, "orders", ["o_orderpriority"])
    seg = c.select(F.col("c_mktsegment").alias("dim_value")).distinct()
    scaffold = (seg.withColumn("breakdown", F.lit("segment"))
                .unionByName(seg.withColumn("breakdown", F.lit("urgent_by_segment")))
                .unionByName(o.select(F.col("o_orderpriority").alias("dim_value")).distinct()
                             .withColumn("breakdown", F.lit("priority")))
                .unionByName(n.select(F.col("n_name").alias("dim_value")).withColumn("breakdown", F.lit("nation")))
                .unionByName(spark.range(1).select(F.lit("ALL").alias("dim_value"), F.lit("total").alias("breakdown"))))
    return D.diff_breakdowns(rows, breakdowns, F.col("total_1"), F.col("total_2"), scaffold,
                             kind="percentage", upper=10.0, lower=-10.0)


def _tier():
    return (F.when(F.col("spend") < 300000, F.lit("small")).when(F.col("spend") < 800000, F.lit("medium"))
            .otherwise(F.lit("large")))


TIER_SQL = "CASE WHEN spend < 300000 THEN 'small' WHEN spend < 800000 THEN 'medium' ELSE 'large' END"


def _tiers(spark, sf, year):
    return (_year_orders(spark, sf, year).groupBy("o_custkey").agg(F.sum("o_totalprice").alias("spend"))
            .withColumn("tier", _tier()))


@register("membership_change", f"""
WITH a AS (SELECT o_custkey, {TIER_SQL} AS tier FROM (SELECT o_custkey, sum(o_totalprice) AS spend FROM orders
           WHERE year(o_orderdate) = 1997 GROUP BY o_custkey)),
b AS (SELECT o_custkey, {TIER_SQL} AS tier FROM (SELECT o_custkey, sum(o_totalprice) AS spend FROM orders
      WHERE year(o_orderdate) = 1998 GROUP BY o_custkey)),
r(t, k) AS (VALUES ('small', 1), ('medium', 2), ('large', 3))
SELECT COALESCE(a.o_custkey, b.o_custkey) AS o_custkey, a.tier AS tier_1, b.tier AS tier_2,
  CASE WHEN a.tier IS NULL THEN 'added' WHEN b.tier IS NULL THEN 'removed'
       WHEN (SELECT k FROM r WHERE t = b.tier) > (SELECT k FROM r WHERE t = a.tier) THEN 'size increased'
       WHEN (SELECT k FROM r WHERE t = b.tier) < (SELECT k FROM r WHERE t = a.tier) THEN 'size decreased'
       ELSE 'no change' END AS change
FROM a FULL JOIN b ON a.o_custkey = b.o_custkey
""")
def q_membership_change(spark, sf):
    return D.membership_change(_tiers(spark, sf, 1997), _tiers(spark, sf, 1998), "o_custkey", "tier",
                               {"small": 1, "medium": 2, "large": 3})


def _snapshot(spark, sf, year):
    o = _year_orders(spark, sf, year)
    last = F.struct("o_orderdate", "o_orderkey")
    return o.groupBy("o_custkey").agg(
        F.count(F.lit(1)).alias("n_orders"),
        F.round(F.sum("o_totalprice"), 2).cast("decimal(18,2)").alias("spend"),
        F.max_by("o_orderpriority", last).alias("last_priority"),
        F.max_by("o_orderstatus", last).alias("last_status"))


SNAP_SQL = """
SELECT o_custkey, CAST(count(*) AS VARCHAR) AS n_orders,
       CAST(CAST(round(sum(o_totalprice), 2) AS DECIMAL(18, 2)) AS VARCHAR) AS spend,
       arg_max(o_orderpriority, o_orderdate::VARCHAR || lpad(o_orderkey::VARCHAR, 20, '0')) AS last_priority,
       arg_max(o_orderstatus, o_orderdate::VARCHAR || lpad(o_orderkey::VARCHAR, 20, '0')) AS last_status
FROM orders WHERE year(o_orderdate) = {y} GROUP BY o_custkey
"""


@register("diff_columns_long", f"""
WITH a AS ({SNAP_SQL.format(y=1997)}), b AS ({SNAP_SQL.format(y=1998)}),
j AS (SELECT COALESCE(a.o_custkey, b.o_custkey) AS o_custkey, a.o_custkey IS NOT NULL AS in_a, b.o_custkey IS NOT NULL AS in_b,
             a.n_orders AS o1, b.n_orders AS n1, a.spend AS o2, b.spend AS n2, a.last_priority AS o3,
             b.last_priority AS n3, a.last_status AS o4, b.last_status AS n4
      FROM a FULL JOIN b ON a.o_custkey = b.o_custkey),
l AS (SELECT o_custkey, in_a, in_b, 'n_orders' AS column_name, 'volume' AS category, o1 AS old_value, n1 AS new_value FROM j
      UNION ALL SELECT o_custkey, in_a, in_b, 'spend', 'volume', o2, n2 FROM j
      UNION ALL SELECT o_custkey, in_a, in_b, 'last_priority', 'profile', o3, n3 FROM j
      UNION ALL SELECT o_custkey, in_a, in_b, 'last_status', 'profile', o4, n4 FROM j)
SELECT o_custkey, column_name, category, old_value, new_value,
  CASE WHEN NOT in_a THEN 'Joiner' WHEN NOT in_b THEN 'Leaver' WHEN old_value IS NOT DISTINCT FROM new_value THEN 'No Change'
       WHEN old_value IS NULL THEN 'Added' WHEN new_value IS NULL THEN 'Removed' ELSE 'Changed' END AS change
FROM l
""")
def q_diff_columns_long(spark, sf):
    cols = ["n_orders", "spend", "last_priority", "last_status"]
    cats = {"n_orders": "volume", "spend": "volume", "last_priority": "profile", "last_status": "profile"}
    return D.diff_columns_long(_snapshot(spark, sf, 1997), _snapshot(spark, sf, 1998), ["o_custkey"], cols, cats)


def _top_supplier(spark, sf, year):
    li = read_table(spark, sf, "lineitem", ["l_orderkey", "l_suppkey", "l_extendedprice", "l_discount"])
    o = _year_orders(spark, sf, year).select("o_orderkey", "o_custkey")
    rev = (li.join(o, li.l_orderkey == o.o_orderkey)
             .groupBy("o_custkey", "l_suppkey")
             .agg(F.round(F.sum(F.col("l_extendedprice") * (1 - F.col("l_discount"))), 2).alias("rev")))
    return latest_per_key(rev, ["o_custkey"], [F.col("rev").desc(), F.col("l_suppkey").asc()])


TOP_SQL = """
SELECT o_custkey, l_suppkey FROM (
  SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY rev DESC, l_suppkey) rn FROM (
    SELECT o.o_custkey, l.l_suppkey, round(sum(l.l_extendedprice * (1 - l.l_discount)), 2) AS rev
    FROM lineitem l JOIN orders o ON o.o_orderkey = l.l_orderkey WHERE year(o.o_orderdate) = {y}
    GROUP BY ALL)) WHERE rn = 1
"""


@register("year_on_year", f"""
WITH a AS ({TOP_SQL.format(y=1997)}), b AS ({TOP_SQL.format(y=1998)}),
x AS (SELECT COALESCE(a.l_suppkey, b.l_suppkey) AS l_suppkey, COALESCE(a.o_custkey, b.o_custkey) AS o_custkey,
             CASE WHEN a.o_custkey IS NULL THEN 'Joiner' WHEN b.o_custkey IS NULL THEN 'Leaver' ELSE 'No change' END AS status
      FROM a FULL JOIN b ON a.l_suppkey IS NOT DISTINCT FROM b.l_suppkey AND a.o_custkey IS NOT DISTINCT FROM b.o_custkey)
SELECT x.*, CASE WHEN x.status = 'Leaver' THEN b.l_suppkey END AS moved_to
FROM x LEFT JOIN (SELECT o_custkey, max(l_suppkey) AS l_suppkey FROM b GROUP BY o_custkey) b ON b.o_custkey = x.o_custkey
""")
def q_year_on_year(spark, sf):
    return D.year_on_year(_top_supplier(spark, sf, 1997), _top_supplier(spark, sf, 1998), "l_suppkey", "o_custkey")


@register("changed_members", """
WITH o AS (SELECT l_orderkey, l_linenumber, l_partkey, l_quantity FROM lineitem WHERE l_returnflag <> 'R'),
n AS (SELECT l_orderkey, l_linenumber, l_partkey, l_quantity FROM lineitem WHERE l_linestatus = 'F' OR l_returnflag <> 'A'),
ch AS (SELECT l_orderkey FROM (SELECT * FROM o EXCEPT SELECT * FROM n)
       UNION SELECT l_orderkey FROM (SELECT * FROM n EXCEPT SELECT * FROM o)),
bo AS (SELECT DISTINCT l_orderkey FROM o WHERE l_orderkey IN (SELECT l_orderkey FROM n)),
m AS (SELECT DISTINCT l_orderkey FROM ch WHERE l_orderkey IN (SELECT l_orderkey FROM bo))
SELECT ord.o_custkey, count(*) AS n_changed_members FROM m JOIN orders ord ON ord.o_orderkey = m.l_orderkey
GROUP BY ord.o_custkey
""")
def q_changed_members(spark, sf):
    li = read_table(spark, sf, "lineitem", ["l_orderkey", "l_linenumber", "l_partkey", "l_quantity",
                                            "l_returnflag", "l_linestatus"])
    cols = ["l_orderkey", "l_linenumber", "l_partkey", "l_quantity"]
    old = li.filter(F.col("l_returnflag") != "R").select(*cols)
    new = li.filter((F.col("l_linestatus") == "F") | (F.col("l_returnflag") != "A")).select(*cols)
    m = D.changed_members(old, new, "l_orderkey")
    o = read_table(spark, sf, "orders", ["o_orderkey", "o_custkey"])
    return (m.join(o, m.l_orderkey == o.o_orderkey).groupBy("o_custkey")
              .agg(F.count(F.lit(1)).alias("n_changed_members")))


@register("cross_validate", """
WITH r AS (SELECT l_orderkey AS o_orderkey, round(sum(l_extendedprice * (1 + l_tax) * (1 - l_discount)), 2) AS reported_total
           FROM lineitem GROUP BY l_orderkey),
x AS (SELECT COALESCE(o.o_orderkey, r.o_orderkey) AS o_orderkey, o.o_totalprice AS declared_total, r.reported_total
      FROM orders o FULL JOIN r ON o.o_orderkey = r.o_orderkey)
SELECT x.*, x.o_orderkey IN (SELECT l_orderkey FROM lineitem WHERE l_returnflag = 'R') AS has_returns,
  CASE WHEN reported_total IS NULL THEN 'declared_only' WHEN declared_total IS NULL THEN 'reported_only'
       WHEN abs(declared_total - reported_total) <= abs(declared_total) * 0.05 THEN 'match' ELSE 'mismatch' END AS status
FROM x
""")
def q_cross_validate(spark, sf):
    o = read_table(spark, sf, "orders", ["o_orderkey", "o_totalprice"]).withColumnRenamed("o_totalprice", "declared_total")
    li = read_table(spark, sf, "lineitem", ["l_orderkey", "l_extendedprice", "l_tax", "l_discount", "l_returnflag"])
    rep = li.groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(
        F.round(F.sum(F.col("l_extendedprice") * (1 + F.col("l_tax")) * (1 - F.col("l_discount"))), 2)
        .alias("reported_total"))
    returns = li.filter(F.col("l_returnflag") == "R").select(F.col("l_orderkey").alias("o_orderkey"))
    return D.cross_validate(o, rep, "o_orderkey", "declared_total", "reported_total", 0.05,
                            {"has_returns": returns})


@register("diff_drill", """
WITH a AS (SELECT o_custkey, o_orderpriority, round(sum(o_totalprice), 2) AS total, count(*) AS n
           FROM orders WHERE year(o_orderdate) = 1997 GROUP BY ALL),
b AS (SELECT o_custkey, o_orderpriority, round(sum(o_totalprice), 2) AS total, count(*) AS n
      FROM orders WHERE year(o_orderdate) = 1998 GROUP BY ALL),
d AS (SELECT COALESCE(a.o_custkey, b.o_custkey) AS o_custkey, COALESCE(a.o_orderpriority, b.o_orderpriority) AS o_orderpriority,
             a.total AS total_1, b.total AS total_2, round(COALESCE(b.total, 0) - COALESCE(a.total, 0), 2) AS total_diff,
             a.n AS n_1, b.n AS n_2, COALESCE(b.n, 0) - COALESCE(a.n, 0) AS n_diff,
             CASE WHEN a.o_custkey IS NULL THEN 'added' WHEN b.o_custkey IS NULL THEN 'removed'
                  WHEN a.total IS NOT DISTINCT FROM b.total AND a.n = b.n THEN 'unchanged' ELSE 'changed' END AS change_class
      FROM a FULL JOIN b ON a.o_custkey = b.o_custkey AND a.o_orderpriority = b.o_orderpriority)
SELECT d.*, c.c_mktsegment FROM d JOIN customer c ON c.c_custkey = d.o_custkey
WHERE d.o_orderpriority = '1-URGENT' AND c.c_mktsegment = 'BUILDING'
""")
def q_diff_drill(spark, sf):
    d = D.diff_measures(_year_orders(spark, sf, 1997), _year_orders(spark, sf, 1998),
                        ["o_custkey", "o_orderpriority"],
                        {"total": F.round(F.sum("o_totalprice"), 2), "n": F.count(F.lit(1))}, null_keys="distinct")
    d = d.withColumn("total_diff", F.round("total_diff", 2))
    c = read_table(spark, sf, "customer", ["c_custkey", "c_mktsegment"])
    rows = d.join(c, d.o_custkey == c.c_custkey).drop("c_custkey")
    breakdowns = [("segment", F.lit(True), F.col("c_mktsegment")),
                  ("urgent_by_segment", F.col("o_orderpriority") == "1-URGENT", F.col("c_mktsegment"))]
    return D.drill_down(rows, breakdowns, "urgent_by_segment", "BUILDING")


# Test columns in the roles of the packaging columns. Spellings differ in case here and there (T1).
_PACK = {
    "packaging_type": ("l_partkey % 9", ["Self-managed consumer waste", "Self-managed organisation waste", "Total Household packaging",
                                         "Total Non-Household packaging", "Household drinks containers", "Non-Household drinks containers",
                                         "Reusable packaging", "Public Binned", "total household packaging"]),
    "packaging_class": ("l_suppkey % 7", ["Primary packaging", "Public Bin", "Shipment packaging", "Online marketplace total", "Secondary packaging",
                                          "Tertiary packaging", "primary packaging"]),
    "packaging_material": ("l_linenumber % 5", ["Glass", "Paper", "", "Steel", "GLASS"]),
    "packaging_activity": ("l_orderkey % 5", ["Brand Owner", "Packer / Filler", "Imported", "Sold as empty", "Hired or loaned"]),
    "from_nation": ("l_orderkey % 5", ["EN", "NI", "SC", "WS", ""]),
    "to_nation": ("l_partkey % 4", ["", "EN", "SC", ""]),
    "relative_move": ("l_suppkey % 3", ["EN to SC", "", "NI to WS"]),
}
_PACK_SQL = ", ".join(f"list_extract([{', '.join(repr(v) for v in vs)}], CAST({e} AS INTEGER) + 1) AS {n}" for n, (e, vs) in _PACK.items())
_PACK_ROWS = f"""
SELECT l_orderkey, l_linenumber, l_suppkey AS org_id, CASE WHEN l_linenumber % 2 = 0 THEN 'S' || l_returnflag END AS subsidiary_id, {_PACK_SQL},
       CASE WHEN year(l_shipdate) = 1997 THEN l_quantity ELSE 0.0 END AS q1, CASE WHEN year(l_shipdate) = 1998 THEN l_quantity END AS q2 FROM lineitem
"""


def _pack_rows(spark, sf):
    li = read_table(spark, sf, "lineitem", ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_shipdate", "l_returnflag"])
    year = F.year("l_shipdate")
    return li.select("l_orderkey", "l_linenumber", F.col("l_suppkey").alias("org_id"),
                     F.when(F.col("l_linenumber") % 2 == 0, F.concat(F.lit("S"), "l_returnflag")).alias("subsidiary_id"),
                     *[F.element_at(F.array(*[F.lit(v) for v in vs]), F.expr(e).cast("int") + 1).alias(n) for n, (e, vs) in _PACK.items()],
                     F.when(year == 1997, F.col("l_quantity")).otherwise(0.0).alias("q1"), F.when(year == 1998, F.col("l_quantity")).alias("q2"))


# Written out from the specification of each breakdown, not from the rules that the query uses.
_CUBE_SQL = f"""
WITH raw AS ({_PACK_ROWS}),
r AS (SELECT org_id AS o, subsidiary_id AS s, lower(packaging_type) AS t, lower(packaging_class) AS c, lower(packaging_material) AS m, lower(packaging_activity) AS a,
             lower(from_nation) AS fn, lower(to_nation) AS tn, lower(relative_move) AS rm, sum(q1) AS q1, sum(coalesce(q2, 0)) AS q2 FROM raw GROUP BY ALL),
e(f, o, s, m, fn, rm, c, a, q1, q2) AS (
  SELECT 'smcw_pm_fn', o, s, m, fn, NULL, NULL, NULL, q1, q2 FROM r WHERE t = 'self-managed consumer waste' AND fn <> '' AND tn = ''
  UNION ALL SELECT 'smcw_pm_rm', o, s, m, NULL, rm, NULL, NULL, q1, q2 FROM r WHERE t = 'self-managed consumer waste' AND rm <> '' AND m <> ''
  UNION ALL SELECT 'smow_pm_fn', o, s, m, fn, NULL, NULL, NULL, q1, q2 FROM r WHERE t = 'self-managed organisation waste' AND fn <> '' AND tn = '' AND m <> ''
  UNION ALL SELECT 'smow_pm_rm', o, s, m, NULL, rm, NULL, NULL, q1, q2 FROM r WHERE t = 'self-managed organisation waste' AND tn <> '' AND m <> ''
  UNION ALL SELECT 'all_pm_hh_pc', o, s, m, NULL, NULL, c, NULL, q1, q2 FROM r WHERE t = 'total household packaging' AND m <> ''
    AND c IN ('primary packaging', 'public bin', 'shipment packaging', 'online marketplace total')
  UNION ALL SELECT 'all_pm_non_hh_pc', o, s, m, NULL, NULL, c, NULL, q1, q2 FROM r WHERE t = 'total non-household packaging' AND m <> ''
    AND c IN ('online marketplace total', 'primary packaging', 'secondary packaging', 'shipment packaging', 'tertiary packaging')
  UNION ALL SELECT 'all_pm_hh_drinks', o, s, m, NULL, NULL, NULL, NULL, q1, q2 FROM r WHERE t = 'household drinks containers' AND m <> ''
  UNION ALL SELECT 'all_pm_non_hh_drinks', o, s, m, NULL, NULL, NULL, NULL, q1, q2 FROM r WHERE t = 'non-household drinks containers' AND m <> ''
  UNION ALL SELECT 'all_pm_drinks', o, s, m, NULL, NULL, NULL, NULL, q1, q2 FROM r WHERE t LIKE '%household drinks containers' AND m <> ''
  UNION ALL SELECT 'all_pm_reusable', o, s, m, NULL, NULL, c, NULL, q1, q2 FROM r WHERE t = 'reusable packaging' AND m <> ''
  UNION ALL SELECT 'all_pm_TReusable', o, s, m, NULL, NULL, NULL, NULL, q1, q2 FROM r WHERE t = 'reusable packaging' AND m <> ''
  UNION ALL SELECT 'all_pm_TP', o, s, m, NULL, NULL, NULL, NULL, q1, q2 FROM r WHERE t NOT LIKE 'self-managed%' AND m <> ''
  UNION ALL SELECT 'all_pm_Thh', o, s, m, NULL, NULL, NULL, NULL, q1, q2 FROM r WHERE t = 'total household packaging' AND m <> ''
  UNION ALL SELECT 'all_pm_Tnhh', o, s, m, NULL, NULL, NULL, NULL, q1, q2 FROM r WHERE t = 'total non-household packaging' AND m <> ''
  UNION ALL SELECT 'all_pm_hh_pa', o, s, m, NULL, NULL, c, a, q1, q2 FROM r WHERE t = 'total household packaging' AND m <> ''
    AND c IN ('primary packaging', 'shipment packaging')
  UNION ALL SELECT 'all_pm_pb_pa', o, s, m, NULL, NULL, c, a, q1, q2 FROM r WHERE t = 'public binned' AND c = 'public bin' AND m <> ''
  UNION ALL SELECT 'all_public_binned', o, s, m, NULL, NULL, c, NULL, q1, q2 FROM r WHERE t = 'public binned' AND c = 'public bin' AND m <> ''
  UNION ALL SELECT 'all_pm_tnh_pa', o, s, m, NULL, NULL, c, a, q1, q2 FROM r WHERE t = 'total non-household packaging' AND m <> ''
  UNION ALL SELECT 'all_pm_pa_HH_drinks', o, s, m, NULL, NULL, NULL, a, q1, q2 FROM r WHERE t = 'household drinks containers' AND m <> ''
  UNION ALL SELECT 'all_pm_pa_nHH_drinks', o, s, m, NULL, NULL, NULL, a, q1, q2 FROM r WHERE t = 'non-household drinks containers' AND m <> ''
  UNION ALL SELECT 'all_pm_pa_all_drinks', o, s, m, NULL, NULL, NULL, a, q1, q2 FROM r WHERE t LIKE '%household drinks containers' AND m <> ''
  UNION ALL SELECT 'all_pm_pa_reusable', o, s, m, NULL, NULL, c, a, q1, q2 FROM r WHERE t = 'reusable packaging' AND m <> ''
  UNION ALL SELECT 'all_pm_pa_total_reusable', o, s, m, NULL, NULL, NULL, a, q1, q2 FROM r WHERE t = 'reusable packaging' AND m <> ''
  UNION ALL SELECT 'all_pm_pa_tp', o, s, m, NULL, NULL, NULL, a, q1, q2 FROM r WHERE t NOT LIKE 'self-managed%' AND m <> ''
  UNION ALL SELECT 'all_pm_pa_total_hh', o, s, m, NULL, NULL, NULL, a, q1, q2 FROM r WHERE t = 'total household packaging' AND m <> ''
  UNION ALL SELECT 'all_pm_pa_total_nonhh', o, s, m, NULL, NULL, NULL, a, q1, q2 FROM r WHERE t = 'total non-household packaging' AND m <> ''
  UNION ALL SELECT 'all_pm_online', o, s, m, NULL, NULL, c, NULL, q1, q2 FROM r WHERE t = 'total household packaging' AND c = 'online marketplace total' AND m <> ''
  UNION ALL SELECT 'all_pm_online_non', o, s, m, NULL, NULL, c, NULL, q1, q2 FROM r WHERE t = 'total non-household packaging' AND c = 'online marketplace total' AND m <> ''
),
ms AS (SELECT DISTINCT m FROM r WHERE m <> ''), fns AS (SELECT DISTINCT fn FROM r WHERE fn <> ''), rms AS (SELECT DISTINCT rm FROM r WHERE rm <> ''),
cs AS (SELECT DISTINCT c FROM r WHERE c <> ''), acts AS (SELECT DISTINCT a FROM r WHERE a <> ''),
z(f, m, fn, rm, c, a) AS (
  SELECT f, m, fn, NULL, NULL, NULL FROM ms, fns, (VALUES ('smcw_pm_fn'), ('smow_pm_fn')) v(f)
  UNION ALL SELECT f, m, NULL, rm, NULL, NULL FROM ms, rms, (VALUES ('smcw_pm_rm'), ('smow_pm_rm')) v(f)
  UNION ALL SELECT f, m, NULL, NULL, NULL, NULL FROM ms, (VALUES ('all_pm_hh_drinks'), ('all_pm_non_hh_drinks'), ('all_pm_drinks'), ('all_pm_TReusable'),
    ('all_pm_TP'), ('all_pm_Thh'), ('all_pm_Tnhh')) v(f)
  UNION ALL SELECT f, m, NULL, NULL, NULL, a FROM ms, acts, (VALUES ('all_pm_pa_HH_drinks'), ('all_pm_pa_nHH_drinks'), ('all_pm_pa_all_drinks'), ('all_pm_pa_tp'),
    ('all_pm_pa_total_hh'), ('all_pm_pa_total_nonhh'), ('all_pm_pa_total_reusable')) v(f)
  UNION ALL SELECT 'all_pm_reusable', m, NULL, NULL, c, NULL FROM ms, cs
  UNION ALL SELECT 'all_pm_hh_pc', m, NULL, NULL, c, NULL FROM ms, cs WHERE c IN ('primary packaging', 'public bin', 'shipment packaging', 'online marketplace total')
  UNION ALL SELECT 'all_pm_non_hh_pc', m, NULL, NULL, c, NULL FROM ms, cs WHERE c <> 'public bin'
  UNION ALL SELECT f, m, NULL, NULL, c, NULL FROM ms, cs, (VALUES ('all_pm_online'), ('all_pm_online_non')) v(f) WHERE c = 'online marketplace total'
  UNION ALL SELECT 'all_public_binned', m, NULL, NULL, c, NULL FROM ms, cs WHERE c = 'public bin'
  UNION ALL SELECT 'all_pm_pb_pa', m, NULL, NULL, c, a FROM ms, cs, acts WHERE c = 'public bin'
  UNION ALL SELECT 'all_pm_hh_pa', m, NULL, NULL, c, a FROM ms, cs, acts WHERE c IN ('primary packaging', 'shipment packaging')
  UNION ALL SELECT f, m, NULL, NULL, c, a FROM ms, cs, acts, (VALUES ('all_pm_tnh_pa'), ('all_pm_pa_reusable')) v(f)
),
x AS (
  SELECT 'member' AS level, f, o, s, m, fn, rm, c, a, round(sum(q1), 2) AS s1, round(sum(q2), 2) AS s2 FROM e GROUP BY ALL
  UNION ALL SELECT 'scaffold', f, NULL, NULL, m, fn, rm, c, a, 0, 0 FROM z
  UNION ALL SELECT 'total', f, NULL, NULL, m, fn, rm, c, a, round(sum(q1), 2), round(sum(q2), 2)
    FROM (SELECT f, m, fn, rm, c, a, q1, q2 FROM e UNION ALL SELECT *, 0, 0 FROM z) GROUP BY ALL
),
d AS (SELECT lower(v) AS k, min(v) AS v FROM (SELECT unnest([packaging_material, packaging_activity, packaging_class, from_nation, relative_move]) AS v FROM raw) GROUP BY 1),
y AS (
  SELECT level, f AS breakdown, o AS org_id, s AS subsidiary_id, dm.v AS packaging_material, df.v AS from_nation, dr.v AS relative_move, dc.v AS packaging_class,
         da.v AS packaging_activity, s1, s2
  FROM x LEFT JOIN d dm ON dm.k = m LEFT JOIN d df ON df.k = fn LEFT JOIN d dr ON dr.k = rm LEFT JOIN d dc ON dc.k = c LEFT JOIN d da ON da.k = a
)
"""


def _arrow_sql(kind: str) -> str:
    change = "round((s2 - s1) / s1 * 100, 2)" if kind == "percentage" else "round(s2 - s1, 2)"
    zero = "s1 = 0 OR s2 = 0" if kind == "percentage" else "level = 'total' AND (s1 = 0 OR s2 = 0)"
    return f"""SELECT *, CASE WHEN change >= 10 THEN 'up' WHEN change <= -10 THEN 'down' ELSE 'flat' END AS arrow
               FROM (SELECT *, CASE WHEN {zero} THEN 0.0 ELSE {change} END AS change FROM y)"""


def _pack_cube(spark, sf, kind):
    return breakdown_cube(_pack_rows(spark, sf), BREAKDOWNS, ["org_id", "subsidiary_id"], DIMS, F.col("q1"), F.col("q2"), kind)


@register("packaging_breakdowns", _CUBE_SQL + _arrow_sql("percentage"))
def q_packaging_breakdowns(spark, sf):
    return _pack_cube(spark, sf, "percentage")


@register("packaging_totals", _CUBE_SQL + f"SELECT * EXCLUDE (level, org_id, subsidiary_id) FROM ({_arrow_sql('value')}) WHERE level = 'total'")
def q_packaging_totals(spark, sf):
    return _pack_cube(spark, sf, "value").filter("level = 'total'").drop("level", "org_id", "subsidiary_id")


# Each drill's condition as the specification has it; an activity's eleven measures differ in that activity alone.
_DRILL_SQL = f"""
WITH raw AS ({_PACK_ROWS}),
r AS (SELECT *, lower(packaging_type) AS t, lower(packaging_activity) AS act, lower(packaging_material) AS m, lower(packaging_class) AS c,
             lower(from_nation) AS fn, lower(relative_move) AS rm FROM raw WHERE packaging_material <> ''),
acts(suffix, act) AS (VALUES ('', 'brand owner'), ('_pack', 'packer / filler'), ('_Imported', 'imported'), ('_sold', 'sold as empty'), ('_hired', 'hired or loaned')),
x AS (
  SELECT 'relative_move' AS drill, m, rm AS v, q1, q2 FROM r WHERE t = 'self-managed consumer waste'
  UNION ALL SELECT 'from_nation', m, fn, q1, q2 FROM r WHERE t = 'self-managed consumer waste'
  UNION ALL SELECT 'from_org', m, fn, q1, q2 FROM r WHERE t = 'self-managed organisation waste'
  UNION ALL SELECT 'relative_move_org', m, rm, q1, q2 FROM r WHERE t = 'self-managed organisation waste'
  UNION ALL SELECT unnest(['hp_all', 'all_pm_online']), m, c, q1, q2 FROM r WHERE t = 'total household packaging'
  UNION ALL SELECT unnest(['nhp_all', 'all_pm_tnh_pa_online', 'all_pm_online_non']), m, c, q1, q2 FROM r WHERE t = 'total non-household packaging'
  UNION ALL SELECT 'hdc_all', m, NULL, q1, q2 FROM r WHERE t = 'household drinks containers'
  UNION ALL SELECT 'nhdc_all', m, NULL, q1, q2 FROM r WHERE t = 'non-household drinks containers'
  UNION ALL SELECT 'drinks_all', m, NULL, q1, q2 FROM r WHERE t LIKE '%household drinks containers'
  UNION ALL SELECT 'rp_all', m, c, q1, q2 FROM r WHERE t = 'reusable packaging'
  UNION ALL SELECT 'rp_all_total', m, NULL, q1, q2 FROM r WHERE t = 'reusable packaging'
  UNION ALL SELECT 'tp_all', m, NULL, q1, q2 FROM r WHERE t NOT LIKE 'self-managed%'
  UNION ALL SELECT 'hp_all_total', m, NULL, q1, q2 FROM r WHERE t = 'total household packaging'
  UNION ALL SELECT 'nhp_all_total', m, NULL, q1, q2 FROM r WHERE t = 'total non-household packaging'
  UNION ALL SELECT 'all_public_binned', m, c, q1, q2 FROM r WHERE t = 'public binned'
  UNION ALL SELECT 'all_pm_hh_pa' || suffix, m, c, q1, q2 FROM r JOIN acts USING (act) WHERE t = 'total household packaging'
  UNION ALL SELECT 'all_pm_pb_pa' || suffix, m, c, q1, q2 FROM r JOIN acts USING (act) WHERE t = 'public binned'
  UNION ALL SELECT 'all_pm_tnh_pa' || suffix, m, c, q1, q2 FROM r JOIN acts USING (act) WHERE t = 'total non-household packaging'
  UNION ALL SELECT 'all_pm_pa_HH_drinks' || suffix, m, NULL, q1, q2 FROM r JOIN acts USING (act) WHERE t = 'household drinks containers'
  UNION ALL SELECT 'all_pm_pa_nHH_drinks' || suffix, m, NULL, q1, q2 FROM r JOIN acts USING (act) WHERE t = 'non-household drinks containers'
  UNION ALL SELECT 'all_pm_pa_all_drinks' || suffix, m, NULL, q1, q2 FROM r JOIN acts USING (act) WHERE t LIKE '%household drinks containers'
  UNION ALL SELECT 'all_pm_pa_reusable' || suffix, m, c, q1, q2 FROM r JOIN acts USING (act) WHERE t = 'reusable packaging'
  UNION ALL SELECT 'all_pm_pa_tp' || suffix, m, NULL, q1, q2 FROM r JOIN acts USING (act) WHERE t NOT LIKE 'self-managed%'
  UNION ALL SELECT 'all_pm_pa_total_hh' || suffix, m, NULL, q1, q2 FROM r JOIN acts USING (act) WHERE t = 'total household packaging'
  UNION ALL SELECT 'all_pm_pa_total_nonhh' || suffix, m, NULL, q1, q2 FROM r JOIN acts USING (act) WHERE t = 'total non-household packaging'
  UNION ALL SELECT 'all_pm_pa_total_reusable' || suffix, m, NULL, q1, q2 FROM r JOIN acts USING (act) WHERE t = 'reusable packaging'
)
SELECT drill, m AS material, v AS value, count(*) AS n, round(sum(q1), 2) AS s1, round(sum(coalesce(q2, 0)), 2) AS s2 FROM x GROUP BY ALL
"""


def _drill_index(spark, sf):
    path = scratch_path(spark, "drill", uuid.uuid4().hex)
    write_drill(_pack_rows(spark, sf), DRILLS, path)
    return path


@register("packaging_drills", _DRILL_SQL)
def q_packaging_drills(spark, sf):
    """Every drill, by its material and the value it asks for, from the index of rows by rule."""
    asked = F.lit(None).cast("string")
    for d in (r for r in DRILLS if len(r.by) > 1):
        asked = F.when(F.col("rule") == d.name, ci(d.by[1])).otherwise(asked)
    rows = spark.read.parquet(_drill_index(spark, sf)).withColumn("value", asked)
    return rows.groupBy(F.col("rule").alias("drill"), ci("packaging_material").alias("material"), "value").agg(
        F.count(F.lit(1)).alias("n"), F.round(F.sum("q1"), 2).alias("s1"), F.round(F.sum(F.coalesce("q2", F.lit(0.0))), 2).alias("s2"))


@register("packaging_drill_rows", f"""
SELECT l_orderkey, l_linenumber, org_id, subsidiary_id, packaging_class, q1, q2 FROM ({_PACK_ROWS})
WHERE lower(packaging_type) = 'total household packaging' AND lower(packaging_material) = 'glass' AND lower(packaging_class) = 'primary packaging'
  AND lower(packaging_activity) = 'packer / filler'
""")
def q_packaging_drill_rows(spark, sf):
    """The rows behind one cell, from one folder of the index."""
    rows = read_drill(spark, _drill_index(spark, sf), "all_pm_hh_pa_pack", packaging_material="Glass", packaging_class="Primary packaging")
    return rows.select("l_orderkey", "l_linenumber", "org_id", "subsidiary_id", "packaging_class", "q1", "q2")
