"""Rebinds: enrichment and shaping (O-28 .. O-34)."""

from __future__ import annotations

from pyspark.sql import functions as F

from docket.operators import shape as S
from docket.operators.measures import weight_pivots
from docket.functions.periods import year_quarter, year_quarters
from docket.plans.registry import register
from docket.sources import read_table


def _nation_region(spark, sf, prefix):
    n = read_table(spark, sf, "nation", ["n_nationkey", "n_name", "n_regionkey"])
    r = read_table(spark, sf, "region", ["r_regionkey", "r_name"])
    return (n.join(r, n.n_regionkey == r.r_regionkey, "left")
             .select(F.col("n_nationkey").alias(f"{prefix}_nk"), F.col("n_name").alias(f"{prefix}_nation"),
                     F.col("r_name").alias(f"{prefix}_region")))


@register("flatten_entities", """
WITH nr AS (SELECT n_nationkey, n_name, r_name FROM nation LEFT JOIN region ON n_regionkey = r_regionkey)
SELECT COALESCE(c.c_custkey, s.s_suppkey) AS party_id, c.c_name, s.s_name, cn.n_name AS c_nation, sn.n_name AS s_nation,
       cn.r_name AS c_region, sn.r_name AS s_region,
       CASE WHEN c.c_custkey IS NOT NULL AND s.s_suppkey IS NOT NULL THEN 'both'
            WHEN c.c_custkey IS NOT NULL THEN 'customer only' ELSE 'supplier only' END AS role
FROM customer c FULL JOIN supplier s ON c.c_custkey = s.s_suppkey
LEFT JOIN nr cn ON cn.n_nationkey = c.c_nationkey LEFT JOIN nr sn ON sn.n_nationkey = s.s_nationkey
""")
def q_flatten_entities(spark, sf):
    c = read_table(spark, sf, "customer", ["c_custkey", "c_name", "c_nationkey"])
    s = read_table(spark, sf, "supplier", ["s_suppkey", "s_name", "s_nationkey"])
    cn, sn = _nation_region(spark, sf, "c"), _nation_region(spark, sf, "s")
    out = S.flatten_entities(c, s, "c_custkey", "s_suppkey",
                             [(cn, F.col("c_nationkey") == F.col("c_nk")), (sn, F.col("s_nationkey") == F.col("s_nk"))],
                             roles=("customer", "supplier"))
    return out.select("party_id", "c_name", "s_name", "c_nation", "s_nation", "c_region", "s_region", "role")


def _scoped_lines(spark, sf):
    li = read_table(spark, sf, "lineitem", ["l_orderkey", "l_linenumber", "l_suppkey"])
    o = read_table(spark, sf, "orders", ["o_orderkey", "o_custkey"])
    c = read_table(spark, sf, "customer", ["c_custkey", "c_nationkey"])
    s = read_table(spark, sf, "supplier", ["s_suppkey", "s_nationkey"])
    x = (li.join(o, li.l_orderkey == o.o_orderkey).join(c, F.col("o_custkey") == c.c_custkey)
           .join(s, F.col("l_suppkey") == s.s_suppkey, "left"))
    return S.expand_row_scope(x, ["l_orderkey", "l_linenumber", "l_suppkey"],
                              {"c_nationkey": "customer", "s_nationkey": "supplier"})


SCOPE_SQL = """
x AS (SELECT l.l_orderkey, l.l_linenumber, l.l_suppkey, c.c_nationkey, s.s_nationkey
      FROM lineitem l JOIN orders o ON o.o_orderkey = l.l_orderkey JOIN customer c ON c.c_custkey = o.o_custkey
      LEFT JOIN supplier s ON s.s_suppkey = l.l_suppkey),
e AS (SELECT l_orderkey, l_linenumber, l_suppkey, 'customer' AS scope_role, c_nationkey AS scope FROM x WHERE c_nationkey IS NOT NULL
      UNION ALL
      SELECT l_orderkey, l_linenumber, l_suppkey, 'supplier', s_nationkey FROM x WHERE s_nationkey IS NOT NULL)
"""


@register("expand_row_scope", "WITH " + SCOPE_SQL + " SELECT * FROM e")
def q_expand_row_scope(spark, sf):
    return _scoped_lines(spark, sf)


@register("row_scope", "WITH " + SCOPE_SQL + """
SELECT * FROM e WHERE scope IN (SELECT n_nationkey FROM nation JOIN region ON n_regionkey = r_regionkey
                                WHERE r_name = 'EUROPE')
""")
def q_row_scope(spark, sf):
    n = read_table(spark, sf, "nation", ["n_nationkey", "n_regionkey"])
    r = read_table(spark, sf, "region", ["r_regionkey", "r_name"]).filter(F.col("r_name") == "EUROPE")
    visible = n.join(r, n.n_regionkey == r.r_regionkey, "left_semi")
    return S.row_scope(_scoped_lines(spark, sf), "scope", visible, "n_nationkey")


@register("multi_path_lookup", """
WITH lo AS (SELECT o.o_custkey, l.l_suppkey FROM lineitem l JOIN orders o ON o.o_orderkey = l.l_orderkey)
SELECT DISTINCT * FROM (
  SELECT c_custkey, c_nationkey AS n_nationkey, 'home' AS path FROM customer
  UNION ALL
  SELECT lo.o_custkey, s.s_nationkey, 'supplier' FROM lo JOIN supplier s ON s.s_suppkey = lo.l_suppkey
  UNION ALL
  SELECT c_custkey, CAST(NULL AS INTEGER), 'none' FROM customer c
  WHERE NOT EXISTS (SELECT 1 FROM lo WHERE lo.o_custkey = c.c_custkey))
""")
def q_multi_path_lookup(spark, sf):
    c = read_table(spark, sf, "customer", ["c_custkey", "c_nationkey"])
    li = read_table(spark, sf, "lineitem", ["l_orderkey", "l_suppkey"])
    o = read_table(spark, sf, "orders", ["o_orderkey", "o_custkey"])
    s = read_table(spark, sf, "supplier", ["s_suppkey", "s_nationkey"])
    pairs = (li.join(o, li.l_orderkey == o.o_orderkey).select(F.col("o_custkey").alias("c_custkey"), "l_suppkey").distinct()
               .withColumn("ordered", F.lit(True)))
    rows = c.withColumn("known", F.lit(True)).join(pairs, "c_custkey", "full_outer").join(s, F.col("l_suppkey") == s.s_suppkey, "left")
    key = F.col("c_custkey")
    return S.multi_path_lookup(rows, [
        ("home", F.col("known"), {"c_custkey": key, "n_nationkey": F.col("c_nationkey")}),
        ("supplier", F.col("s_suppkey").isNotNull(), {"c_custkey": key, "n_nationkey": F.col("s_nationkey")}),
        ("none", F.col("ordered").isNull(), {"c_custkey": key, "n_nationkey": F.lit(None).cast("int")})])


@register("attach_optional_children", """
SELECT o.o_orderkey, o.o_orderstatus, l.l_linenumber AS r_linenumber, l.l_quantity AS r_quantity,
       CAST(NULL AS INTEGER) AS a_linenumber, CAST(NULL AS DOUBLE) AS a_quantity
FROM orders o JOIN lineitem l ON l.l_orderkey = o.o_orderkey AND l.l_returnflag = 'R'
UNION ALL
SELECT o.o_orderkey, o.o_orderstatus, NULL, NULL, l.l_linenumber, l.l_quantity
FROM orders o JOIN lineitem l ON l.l_orderkey = o.o_orderkey AND l.l_returnflag = 'A'
UNION ALL
SELECT o_orderkey, o_orderstatus, NULL, NULL, NULL, NULL FROM orders o
WHERE NOT EXISTS (SELECT 1 FROM lineitem l WHERE l.l_orderkey = o.o_orderkey AND l.l_returnflag IN ('R', 'A'))
""")
def q_attach_optional_children(spark, sf):
    o = read_table(spark, sf, "orders", ["o_orderkey", "o_orderstatus"])
    li = read_table(spark, sf, "lineitem", ["l_orderkey", "l_linenumber", "l_quantity", "l_returnflag"])
    # both kinds of child come from one pass over the lines
    cols = [F.when(F.col("l_returnflag") == f, F.col(f"l_{c}")).alias(f"{f.lower()}_{c}") for f in "RA" for c in ("linenumber", "quantity")]
    return S.attach_optional_children(o, "o_orderkey", [(li.filter(F.col("l_returnflag").isin("R", "A")).select("l_orderkey", *cols), "l_orderkey")])


@register("role_views", """
WITH lo AS (SELECT l.*, o.o_custkey, o.o_orderstatus FROM lineitem l JOIN orders o ON o.o_orderkey = l.l_orderkey)
SELECT 'Direct' AS role, o_custkey AS entity_id, count(*) AS n_lines,
       round(sum(l_extendedprice * (1 - l_discount)), 2) AS revenue FROM lo GROUP BY o_custkey
UNION ALL
SELECT 'Operator', l_suppkey, count(*), round(sum(l_extendedprice * (1 - l_discount)), 2) FROM lo GROUP BY l_suppkey
UNION ALL
SELECT 'Member', CAST(c.c_nationkey AS BIGINT), count(*), round(sum(l_extendedprice * (1 - l_discount)), 2)
FROM lo JOIN customer c ON c.c_custkey = lo.o_custkey
WHERE lo.l_orderkey NOT IN (SELECT o_orderkey FROM orders WHERE o_orderstatus = 'P' AND o_orderkey IS NOT NULL)
GROUP BY c.c_nationkey
""")
def q_role_views(spark, sf):
    li = read_table(spark, sf, "lineitem", ["l_orderkey", "l_suppkey", "l_extendedprice", "l_discount"])
    o = read_table(spark, sf, "orders", ["o_orderkey", "o_custkey", "o_orderstatus"])
    c = read_table(spark, sf, "customer", ["c_custkey", "c_nationkey"])
    lo = li.join(o, li.l_orderkey == o.o_orderkey)
    rows = lo.join(c, F.col("o_custkey") == c.c_custkey, "left").withColumn("rev", F.col("l_extendedprice") * (1 - F.col("l_discount")))
    member = F.col("c_custkey").isNotNull() & ~F.coalesce(F.col("o_orderstatus") == "P", F.lit(False))
    return S.role_views(rows, [("Direct", F.lit(True), F.col("o_custkey")), ("Operator", F.lit(True), F.col("l_suppkey")),
                               ("Member", member, F.col("c_nationkey"))],
                        {"n_lines": F.count(F.lit(1)), "revenue": F.round(F.sum("rev"), 2)})


@register("entity_extract", """
SELECT DISTINCT o.o_orderkey, c.c_name, n.n_name, p.p_type, l.l_returnflag
FROM lineitem l JOIN orders o ON o.o_orderkey = l.l_orderkey JOIN customer c ON c.c_custkey = o.o_custkey
JOIN nation n ON n.n_nationkey = c.c_nationkey JOIN part p ON p.p_partkey = l.l_partkey
""")
def q_entity_extract(spark, sf):
    li = read_table(spark, sf, "lineitem", ["l_orderkey", "l_partkey", "l_returnflag"])
    o = read_table(spark, sf, "orders", ["o_orderkey", "o_custkey"])
    c = read_table(spark, sf, "customer", ["c_custkey", "c_name", "c_nationkey"])
    n = read_table(spark, sf, "nation", ["n_nationkey", "n_name"])
    p = read_table(spark, sf, "part", ["p_partkey", "p_type"])
    # customer and nation are looked up once an order, not once a line
    orders = o.join(c, F.col("o_custkey") == F.col("c_custkey")).join(n, F.col("c_nationkey") == F.col("n_nationkey"))
    return S.entity_extract(li, [(p, F.col("l_partkey") == F.col("p_partkey"), "inner"),
                                 (orders, F.col("l_orderkey") == F.col("o_orderkey"), "inner")],
                            ["o_orderkey", "c_name", "n_name", "p_type", "l_returnflag"], "l_orderkey")


@register("extract_recent", """
WITH f AS (SELECT o_custkey AS c_custkey, CAST(year(o_orderdate) * 10 + quarter(o_orderdate) AS INTEGER) AS quarter, o_orderkey, o_orderdate, o_orderstatus
           FROM orders),
yr AS (SELECT min(year(o_orderdate)) AS lo, max(year(o_orderdate)) AS hi FROM orders),
pr AS (SELECT y * 10 + q AS p FROM yr, range(lo, hi + 1) a(y), range(1, 5) b(q)),
g AS (SELECT c_custkey, CAST(p AS INTEGER) AS quarter FROM (SELECT DISTINCT c_custkey FROM customer), pr),
cnt AS (SELECT c_custkey, quarter, count(*) AS n FROM f GROUP BY ALL),
grid AS (SELECT g.*, COALESCE(cnt.n, 0) AS n_facts, COALESCE(cnt.n, 0) > 0 AS present FROM g
         LEFT JOIN cnt ON cnt.c_custkey = g.c_custkey AND cnt.quarter = g.quarter),
grid2 AS (SELECT *, CAST(sum(CAST(present AS INTEGER)) OVER (PARTITION BY c_custkey) AS BIGINT) AS n_present,
                 sum(CASE WHEN present THEN 1 ELSE 0 END) OVER (PARTITION BY c_custkey) = (SELECT count(*) FROM pr) AS all_present FROM grid),
r AS (SELECT *, row_number() OVER (PARTITION BY c_custkey, quarter ORDER BY o_orderdate, o_orderkey) AS r1,
             row_number() OVER (PARTITION BY c_custkey, quarter ORDER BY o_orderdate DESC, o_orderkey DESC) AS r2 FROM f),
fl AS (SELECT a.c_custkey, a.quarter, a.o_orderkey AS first_file, b.o_orderkey AS latest_file, b.o_orderstatus AS latest_status
       FROM r a JOIN r b ON a.c_custkey = b.c_custkey AND a.quarter = b.quarter AND a.r1 = 1 AND b.r2 = 1),
pm AS (SELECT l_orderkey, round(COALESCE(sum(CASE WHEN l_returnflag = 'A' THEN l_quantity END), 0.0), 2) AS qty_A,
              round(COALESCE(sum(CASE WHEN l_returnflag = 'N' THEN l_quantity END), 0.0), 2) AS qty_N,
              round(COALESCE(sum(CASE WHEN l_returnflag = 'R' THEN l_quantity END), 0.0), 2) AS qty_R
       FROM lineitem GROUP BY l_orderkey)
SELECT grid2.*, fl.first_file, fl.latest_file, fl.latest_status, pm.qty_A, pm.qty_N, pm.qty_R
FROM grid2 LEFT JOIN fl ON fl.c_custkey = grid2.c_custkey AND fl.quarter = grid2.quarter
LEFT JOIN pm ON pm.l_orderkey = fl.latest_file
""")
def q_extract_recent(spark, sf):
    c = read_table(spark, sf, "customer", ["c_custkey"])
    o = read_table(spark, sf, "orders", ["o_orderkey", "o_custkey", "o_orderdate", "o_orderstatus"]) \
        .select(F.col("o_custkey").alias("c_custkey"), year_quarter("o_orderdate").alias("quarter"),
                "o_orderkey", "o_orderdate", "o_orderstatus")
    li = read_table(spark, sf, "lineitem", ["l_orderkey", "l_returnflag", "l_quantity"])
    pm = weight_pivots(li, ["l_orderkey"], [("l_returnflag", ["A", "N", "R"])], {"qty": F.col("l_quantity")})
    return S.extract_recent(c, "c_custkey", o, "quarter", year_quarters(o, "o_orderdate"), ["o_orderdate", "o_orderkey"],
                            "o_orderkey", "o_orderstatus", pm, "l_orderkey")


@register("flatten_contacts", """
WITH pe AS (SELECT o_custkey AS c_custkey, CASE o_orderstatus WHEN 'O' THEN 'Primary' WHEN 'F' THEN 'Director' ELSE 'Agent' END AS role, o_orderkey AS person, o_orderdate AS since FROM orders),
r AS (SELECT *, row_number() OVER (PARTITION BY c_custkey, role ORDER BY since DESC, person DESC) AS rn FROM pe),
co AS (SELECT c_custkey, max(CASE WHEN role = 'Primary' THEN person END) AS primary_person, max(CASE WHEN role = 'Primary' THEN since END) AS primary_since,
              max(CASE WHEN role = 'Director' THEN person END) AS director_person, max(CASE WHEN role = 'Director' THEN since END) AS director_since
       FROM r WHERE rn = 1 GROUP BY c_custkey),
en AS (SELECT o_custkey AS c_custkey, count(*) AS n_enrolments, count(CASE WHEN o_orderpriority = '1-URGENT' THEN 1 END) AS n_approved FROM orders GROUP BY o_custkey)
SELECT c.c_custkey, c.c_name, co.* EXCLUDE (c_custkey), n.n_name AS scheme, COALESCE(en.n_enrolments, 0) AS n_enrolments, COALESCE(en.n_approved, 0) AS n_approved
FROM customer c LEFT JOIN co ON co.c_custkey = c.c_custkey LEFT JOIN nation n ON n.n_nationkey = c.c_nationkey LEFT JOIN en ON en.c_custkey = c.c_custkey
""")
def q_flatten_contacts(spark, sf):
    c = read_table(spark, sf, "customer", ["c_custkey", "c_name", "c_nationkey"])
    o = read_table(spark, sf, "orders", ["o_orderkey", "o_custkey", "o_orderdate", "o_orderstatus", "o_orderpriority"])
    n = read_table(spark, sf, "nation", ["n_nationkey", "n_name"])
    status = F.col("o_orderstatus")
    people = o.select(F.col("o_custkey").alias("c_custkey"), F.when(status == "O", "Primary").when(status == "F", "Director").otherwise("Agent").alias("role"),
                      F.col("o_orderkey").alias("person"), F.col("o_orderdate").alias("since"))
    contacts = S.role_columns(people, "c_custkey", "role", ["Primary", "Director"], ["since", "person"], ["person", "since"])
    schemes = c.join(n, c.c_nationkey == n.n_nationkey).select("c_custkey", F.col("n_name").alias("scheme"))
    enrolments = o.select(F.col("o_custkey").alias("c_custkey"), F.when(F.col("o_orderpriority") == "1-URGENT", "Approved").otherwise("Pending").alias("state"))
    return S.flatten_contacts(c.select("c_custkey", "c_name"), "c_custkey", contacts, schemes, enrolments, "state")


@register("one_user_per_file", """
SELECT o_orderkey, max(CASE WHEN rn = 1 THEN l_suppkey END) AS user_l_suppkey, max(CASE WHEN rn = 1 THEN l_shipdate END) AS user_l_shipdate
FROM (SELECT l_orderkey AS o_orderkey, l_suppkey, l_shipdate, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_shipdate DESC, l_suppkey DESC) AS rn FROM lineitem)
GROUP BY o_orderkey
""")
def q_one_user_per_file(spark, sf):
    li = read_table(spark, sf, "lineitem", ["l_orderkey", "l_suppkey", "l_shipdate"]).withColumnRenamed("l_orderkey", "o_orderkey")
    return S.one_user_per_file(li, "o_orderkey", ["l_shipdate", "l_suppkey"], ["l_suppkey", "l_shipdate"])
