"""Rebinds: serving extracts (O-58, O-59, O-65 .. O-68)."""

from __future__ import annotations

from pyspark.sql import functions as F

from docket.functions.scan import KeyedScan
from docket.operators import serve as V
from docket.operators.latest import latest_per_key
from docket.plans.registry import register
from docket.sources import read_table

PAGE_OVERRIDES = '[{"key": "5", "status": "O"}, {"key": "12", "status": "O"}, {"key": "5", "status": "F"}]'


@register("filter_page", """
WITH ov(k, s) AS (VALUES (5, 'F'), (12, 'O')),
x AS (SELECT o.o_orderkey, o.o_custkey, COALESCE(ov.s, o.o_orderstatus) AS o_orderstatus, o.o_orderdate, o.o_orderpriority
      FROM orders o LEFT JOIN ov ON ov.k = o.o_orderkey
      WHERE lower(rtrim(o.o_orderpriority)) IN ('1-urgent', '2-high', '3-medium')),
y AS (SELECT *, CAST(CASE o_orderstatus WHEN 'O' THEN 1 WHEN 'F' THEN 2 WHEN 'P' THEN 3 ELSE 4 END AS INTEGER) AS status_rank
      FROM x WHERE o_orderstatus IN ('O', 'F'))
SELECT *, count(*) OVER () AS total_count, 3 AS page FROM y
ORDER BY status_rank, o_orderdate DESC, o_orderkey LIMIT 25 OFFSET 50
""")
def q_filter_page(spark, sf):
    o = read_table(spark, sf, "orders", ["o_orderkey", "o_custkey", "o_orderstatus", "o_orderdate", "o_orderpriority"])
    return V.filter_page(spark, o, "o_orderkey", "o_orderstatus", {"O": 1, "F": 2, "P": 3},
                         [F.col("o_orderdate").desc()], page=3, size=25,
                         filters=V.text_filters("o_orderpriority", any_of=["1-URGENT", "2-HIGH", "3-MEDIUM"]),
                         statuses=["O", "F"], overrides_json=PAGE_OVERRIDES)


_WINDOW = ("1998-01-01", "1998-03-31")
_IN_WINDOW_SQL = "CAST(o_orderdate AS DATE) BETWEEN DATE '1998-01-01' AND DATE '1998-03-31'"


def _in_window():
    return F.col("o_orderdate").cast("date").between(F.lit(_WINDOW[0]).cast("date"), F.lit(_WINDOW[1]).cast("date"))


@register("delta_extract", f"""
SELECT o_orderkey, o_custkey, o_orderdate, 'registered' AS change_type FROM orders WHERE {_IN_WINDOW_SQL} AND o_orderstatus = 'F'
UNION ALL
SELECT o_orderkey, o_custkey, o_orderdate, 'deleted' FROM orders WHERE {_IN_WINDOW_SQL} AND o_orderstatus = 'P'
UNION ALL
SELECT o_orderkey, o_custkey, o_orderdate, 'scheme_added' FROM orders
WHERE {_IN_WINDOW_SQL} AND o_orderstatus = 'O' AND o_orderpriority = '1-URGENT'
UNION ALL
SELECT o_orderkey, o_custkey, o_orderdate, 'scheme_deleted' FROM orders
WHERE {_IN_WINDOW_SQL} AND o_orderstatus = 'O' AND o_orderpriority = '5-LOW'
""")
def q_delta_extract(spark, sf):
    o = read_table(spark, sf, "orders", ["o_orderkey", "o_custkey", "o_orderdate", "o_orderstatus", "o_orderpriority"])
    w = o.filter(_in_window())
    cols = ["o_orderkey", "o_custkey", "o_orderdate"]
    return V.delta_extract([
        ("registered", w.filter(F.col("o_orderstatus") == "F").select(*cols)),
        ("deleted", w.filter(F.col("o_orderstatus") == "P").select(*cols)),
        ("scheme_added", w.filter((F.col("o_orderstatus") == "O") & (F.col("o_orderpriority") == "1-URGENT")).select(*cols)),
        ("scheme_deleted", w.filter((F.col("o_orderstatus") == "O") & (F.col("o_orderpriority") == "5-LOW")).select(*cols)),
    ])


@register("delta_refresh", f"""
SELECT o_orderkey, o_custkey, o_orderdate, o_orderstatus FROM orders
WHERE o_custkey IN (SELECT o_custkey FROM orders WHERE {_IN_WINDOW_SQL} AND o_orderstatus = 'F')
""")
def q_delta_refresh(spark, sf):
    o = read_table(spark, sf, "orders", ["o_orderkey", "o_custkey", "o_orderdate", "o_orderstatus"])
    touched = o.filter(_in_window() & (F.col("o_orderstatus") == "F"))
    return V.delta_refresh(o, touched, "o_custkey")


@register("public_register", """
WITH x AS (SELECT *, CAST(year(o_orderdate) AS INTEGER) AS year FROM orders),
l AS (SELECT o_custkey, year, o_orderkey AS latest_file, o_orderstatus AS latest_status FROM (
        SELECT *, row_number() OVER (PARTITION BY o_custkey, year ORDER BY o_orderdate DESC, o_orderkey DESC) rn FROM x)
      WHERE rn = 1),
a AS (SELECT o_custkey, year, o_orderkey AS acc FROM (
        SELECT *, row_number() OVER (PARTITION BY o_custkey, year ORDER BY o_orderdate DESC, o_orderkey DESC) rn
        FROM x WHERE o_orderstatus = 'F') WHERE rn = 1),
r AS (SELECT l.*, CASE WHEN l.latest_status = 'P' THEN a.acc ELSE l.latest_file END AS ref
      FROM l LEFT JOIN a ON a.o_custkey = l.o_custkey AND a.year = l.year)
SELECT r.o_custkey, r.year, r.latest_file, r.latest_status,
       CASE WHEN r.ref IS NOT NULL THEN 'REG-' || CAST(r.o_custkey AS VARCHAR) || '-' || CAST(r.ref AS VARCHAR) END AS register_ref,
       trim(c.c_name) AS c_name, n.n_name, rg.r_name
FROM r LEFT JOIN customer c ON c.c_custkey = r.o_custkey LEFT JOIN nation n ON n.n_nationkey = c.c_nationkey
LEFT JOIN region rg ON rg.r_regionkey = n.n_regionkey
""")
def q_public_register(spark, sf):
    o = read_table(spark, sf, "orders", ["o_orderkey", "o_custkey", "o_orderdate", "o_orderstatus"]) \
        .withColumn("year", F.year("o_orderdate"))
    reg = V.public_register(o, ["o_custkey", "year"], ["o_orderdate", "o_orderkey"], "o_orderkey", "o_orderstatus",
                            accepted="F", cancelled="P", ref_prefix="REG-")
    c = read_table(spark, sf, "customer", ["c_custkey", "c_name", "c_nationkey"])
    n = read_table(spark, sf, "nation", ["n_nationkey", "n_name", "n_regionkey"])
    r = read_table(spark, sf, "region", ["r_regionkey", "r_name"])
    x = (reg.join(c, reg.o_custkey == c.c_custkey, "left").join(n, F.col("c_nationkey") == n.n_nationkey, "left")
            .join(r, F.col("n_regionkey") == r.r_regionkey, "left"))
    return x.select("o_custkey", "year", "latest_file", "latest_status", "register_ref",
                    F.trim("c_name").alias("c_name"), "n_name", "r_name")


@register("landing_list", """
WITH org AS (SELECT o_custkey, CAST(year(o_orderdate) AS INTEGER) AS year,
                    concat_ws(' - ', lpad(CAST(o_custkey AS VARCHAR), 8, '0'), strftime(o_orderdate, '%d/%m/%Y'), o_orderpriority) AS org_label
             FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey, year(o_orderdate) ORDER BY o_orderdate DESC, o_orderkey DESC) rn
                   FROM orders) WHERE rn = 1),
dat AS (SELECT o_custkey, year, concat_ws(' - ', lpad(CAST(l_orderkey AS VARCHAR), 10, '0'), CAST(l_linenumber AS VARCHAR),
                                         strftime(l_shipdate, '%Y%m%d')) AS data_label
        FROM (SELECT o.o_custkey, CAST(year(l.l_shipdate) AS INTEGER) AS year, l.l_orderkey, l.l_linenumber, l.l_shipdate,
                     row_number() OVER (PARTITION BY o.o_custkey, year(l.l_shipdate)
                                        ORDER BY l.l_shipdate DESC, l.l_orderkey DESC, l.l_linenumber DESC) rn
              FROM lineitem l JOIN orders o ON o.o_orderkey = l.l_orderkey) WHERE rn = 1)
SELECT COALESCE(org.o_custkey, dat.o_custkey) AS o_custkey, COALESCE(org.year, dat.year) AS year, org.org_label, dat.data_label
FROM org FULL JOIN dat ON org.o_custkey = dat.o_custkey AND org.year = dat.year
""")
def q_landing_list(spark, sf):
    o = read_table(spark, sf, "orders", ["o_orderkey", "o_custkey", "o_orderdate", "o_orderpriority"]) \
        .withColumn("year", F.year("o_orderdate"))
    org = latest_per_key(o, ["o_custkey", "year"], [F.col("o_orderdate").desc(), F.col("o_orderkey").desc()]) \
        .select("o_custkey", "year", V.file_label([F.lpad(F.col("o_custkey").cast("string"), 8, "0"),
                                                   F.date_format("o_orderdate", "dd/MM/yyyy"),
                                                   F.col("o_orderpriority")]).alias("org_label"))
    li = read_table(spark, sf, "lineitem", ["l_orderkey", "l_linenumber", "l_shipdate"])
    lo = li.join(o.select("o_orderkey", "o_custkey"), li.l_orderkey == o.o_orderkey) \
        .withColumn("year", F.year("l_shipdate"))
    dat = latest_per_key(lo, ["o_custkey", "year"], [F.col("l_shipdate").desc(), F.col("l_orderkey").desc(),
                                                     F.col("l_linenumber").desc()]) \
        .select("o_custkey", "year", V.file_label([F.lpad(F.col("l_orderkey").cast("string"), 10, "0"),
                                                   F.col("l_linenumber").cast("string"),
                                                   F.date_format("l_shipdate", "yyyyMMdd")]).alias("data_label"))
    return V.landing_pairs(org, dat, ["o_custkey", "year"])


@register("summary_view", """
WITH ls AS (SELECT l_orderkey, count(*) AS n_lines, string_agg(DISTINCT l_returnflag, ',' ORDER BY l_returnflag) AS flags
            FROM lineitem GROUP BY l_orderkey),
p AS (SELECT o_orderkey, o_custkey,
             COALESCE(count(*) OVER w, 0) AS n_prior_orders,
             COALESCE(sum(CASE WHEN o_orderstatus = 'P' THEN 1 ELSE 0 END) OVER w, 0) AS n_prior_p
      FROM orders WINDOW w AS (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey
                               ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING))
SELECT p.o_orderkey, p.o_custkey, c.c_name, COALESCE(ls.n_lines, 0) AS n_lines, ls.flags, p.n_prior_orders,
       CASE WHEN p.n_prior_p > 0 THEN 'resubmission' ELSE 'original' END AS kind
FROM p LEFT JOIN customer c ON c.c_custkey = p.o_custkey LEFT JOIN ls ON ls.l_orderkey = p.o_orderkey
""")
def q_summary_view(spark, sf):
    o = read_table(spark, sf, "orders", ["o_orderkey", "o_custkey", "o_orderdate", "o_orderstatus"])
    li = read_table(spark, sf, "lineitem", ["l_orderkey", "l_returnflag"])
    c = read_table(spark, sf, "customer", ["c_custkey", "c_name"])
    scan = KeyedScan(["o_custkey"], ["o_orderdate", "o_orderkey"])
    p = scan.finish(scan.run(scan.prepare(o), counts={"n_prior_orders": F.lit(True),
                                                      "n_prior_p": F.col("o_orderstatus") == "P"}))
    # one pass for both; the set is bounded by the flag's domain
    ls = li.groupBy("l_orderkey").agg(F.count(F.lit(1)).alias("n_lines"),
                                      F.array_join(F.array_sort(F.collect_set("l_returnflag")), ",").alias("flags"))
    x = p.join(c, p.o_custkey == c.c_custkey, "left").join(ls, p.o_orderkey == ls.l_orderkey, "left")
    return x.select("o_orderkey", "o_custkey", "c_name", F.coalesce("n_lines", F.lit(0)).alias("n_lines"), "flags",
                    "n_prior_orders",
                    F.when(F.col("n_prior_p") > 0, F.lit("resubmission")).otherwise(F.lit("original")).alias("kind"))


@register("file_trace", """
WITH t AS (SELECT l.l_orderkey, count(*) AS n_lines, max(l.l_shipdate) AS last_ship,
                  string_agg(DISTINCT s.s_name, ',' ORDER BY s.s_name) AS suppliers
           FROM lineitem l LEFT JOIN supplier s ON s.s_suppkey = l.l_suppkey GROUP BY l.l_orderkey)
SELECT o.o_orderkey, o.o_custkey, COALESCE(t.n_lines, 0) AS n_lines, t.suppliers, t.last_ship,
       o.o_orderstatus <> 'P' AS processed
FROM orders o LEFT JOIN t ON t.l_orderkey = o.o_orderkey
""")
def q_file_trace(spark, sf):
    o = read_table(spark, sf, "orders", ["o_orderkey", "o_custkey", "o_orderstatus"])
    li = read_table(spark, sf, "lineitem", ["l_orderkey", "l_suppkey", "l_shipdate"])
    s = read_table(spark, sf, "supplier", ["s_suppkey", "s_name"])
    # lines per (order, supplier) first, so that names are joined and gathered once each; a file's
    # list holds its own suppliers only
    per = li.groupBy("l_orderkey", "l_suppkey").agg(F.count(F.lit(1)).alias("n"), F.max("l_shipdate").alias("ship"))
    ls = per.join(s, per.l_suppkey == s.s_suppkey, "left")
    t = ls.groupBy("l_orderkey").agg(F.sum("n").alias("n_lines"), F.max("ship").alias("last_ship"),
                                     F.array_join(F.array_sort(F.collect_set("s_name")), ",").alias("suppliers"))
    x = o.join(t, o.o_orderkey == t.l_orderkey, "left")
    return x.select("o_orderkey", "o_custkey", F.coalesce("n_lines", F.lit(0)).alias("n_lines"), "suppliers",
                    "last_ship", (F.col("o_orderstatus") != "P").alias("processed"))


@register("filter_page_names", """
WITH x AS (SELECT o.o_orderkey, o.o_custkey, c.c_name, o.o_orderstatus, o.o_orderdate
           FROM orders o JOIN customer c ON c.c_custkey = o.o_custkey
           WHERE contains(lower(rtrim(c.c_name)), '#0000001') OR contains(lower(rtrim(c.c_name)), '#0000002')),
y AS (SELECT *, CAST(CASE o_orderstatus WHEN 'O' THEN 1 WHEN 'F' THEN 2 WHEN 'P' THEN 3 ELSE 4 END AS INTEGER) AS status_rank FROM x)
SELECT *, count(*) OVER () AS total_count, 2 AS page FROM y
ORDER BY status_rank, o_orderdate DESC, o_orderkey LIMIT 30 OFFSET 30
""")
def q_filter_page_names(spark, sf):
    o = read_table(spark, sf, "orders", ["o_orderkey", "o_custkey", "o_orderstatus", "o_orderdate"])
    c = read_table(spark, sf, "customer", ["c_custkey", "c_name"])
    x = o.join(c, o.o_custkey == c.c_custkey).select("o_orderkey", "o_custkey", "c_name", "o_orderstatus",
                                                     "o_orderdate")
    return V.filter_page(spark, x, "o_orderkey", "o_orderstatus", {"O": 1, "F": 2, "P": 3},
                         [F.col("o_orderdate").desc()], page=2, size=30,
                         filters=[V.names_filter("c_name", ["#0000001", "#0000002"], mode="any")])


@register("filter_page_exact", """
WITH x AS (SELECT *, CAST(CASE o_orderstatus WHEN 'O' THEN 1 WHEN 'F' THEN 2 WHEN 'P' THEN 3 ELSE 4 END AS INTEGER) AS status_rank
           FROM (SELECT o_orderkey, o_custkey, o_orderpriority, o_orderstatus, o_orderdate FROM orders)
           WHERE contains(lower(rtrim(o_orderpriority)), 'e') OR contains(lower(rtrim(o_orderpriority)), 'low')),
n AS (SELECT *, count(*) OVER () AS total_count,
             row_number() OVER (ORDER BY CASE WHEN o_orderkey % 7 = 0 THEN 0 ELSE 1 END, status_rank, o_orderdate DESC, o_orderkey) AS rn FROM x),
p AS (SELECT *, CAST(least(120, greatest(1, ceil(total_count / 25.0))) AS INTEGER) AS page FROM n)
SELECT * EXCLUDE (rn) FROM p WHERE rn > (page - 1) * 25 AND rn <= page * 25
""")
def q_filter_page_exact(spark, sf):
    """A deep page with exact matches first."""
    o = read_table(spark, sf, "orders", ["o_orderkey", "o_custkey", "o_orderpriority", "o_orderstatus", "o_orderdate"])
    return V.filter_page(spark, o, "o_orderkey", "o_orderstatus", {"O": 1, "F": 2, "P": 3}, [F.col("o_orderdate").desc()],
                         page=120, size=25, filters=[V.names_filter("o_orderpriority", ["e", "low"])], exact_first=F.col("o_orderkey") % 7 == 0)
