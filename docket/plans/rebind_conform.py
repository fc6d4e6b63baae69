"""Rebinds: conform and clean (O-08 .. O-12), sources (O-04, O-05)."""

from __future__ import annotations

from pyspark.sql import functions as F

from docket.operators import conform as C
from docket.plans.registry import register
from docket.sources import read_table
from docket.sources.control import split_processed, sync_status


@register("active_rows", """
SELECT o_orderkey, o_custkey, o_orderstatus, o_orderpriority FROM orders WHERE o_orderstatus <> 'F'
UNION
SELECT o_orderkey, o_custkey, o_orderstatus, o_orderpriority FROM orders WHERE o_orderstatus = 'F' AND o_orderpriority = '1-URGENT'
""")
def q_active_rows(spark, sf):
    o = read_table(spark, sf, "orders", ["o_orderkey", "o_custkey", "o_orderstatus", "o_orderpriority"])
    return C.active_rows(o, F.col("o_orderstatus") == "F", rescue=F.col("o_orderpriority") == "1-URGENT")


# Code table used by the decode rebind (code, type, text).
LINE_CODES = [
    ("A", "returnflag", "Accepted"), ("N", "returnflag", "Not returned"), ("R", "returnflag", "Returned"),
    ("F", "linestatus", "Fulfilled"), ("O", "linestatus", "Open"),
    ("1-URGENT", "priority", "Urgent"), ("2-HIGH", "priority", "High"), ("3-MEDIUM", "priority", "Medium"),
    ("5-LOW", "priority", "Low"),
]


@register("decode_codes", """
WITH codes(code, type, text) AS (VALUES ('A', 'returnflag', 'Accepted'), ('N', 'returnflag', 'Not returned'),
  ('R', 'returnflag', 'Returned'), ('F', 'linestatus', 'Fulfilled'), ('O', 'linestatus', 'Open'),
  ('1-URGENT', 'priority', 'Urgent'), ('2-HIGH', 'priority', 'High'), ('3-MEDIUM', 'priority', 'Medium'),
  ('5-LOW', 'priority', 'Low'))
SELECT l.l_orderkey, l.l_linenumber, a.text AS l_returnflag_text, b.text AS l_linestatus_text,
       c.text AS o_orderpriority_text
FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey
LEFT JOIN codes a ON a.type = 'returnflag' AND a.code = l.l_returnflag
LEFT JOIN codes b ON b.type = 'linestatus' AND b.code = l.l_linestatus
LEFT JOIN codes c ON c.type = 'priority' AND c.code = o.o_orderpriority
""")
def q_decode_codes(spark, sf):
    li = read_table(spark, sf, "lineitem", ["l_orderkey", "l_linenumber", "l_returnflag", "l_linestatus"])
    o = read_table(spark, sf, "orders", ["o_orderkey", "o_orderpriority"])
    x = li.join(o, li.l_orderkey == o.o_orderkey)
    x = C.decode_codes(x, LINE_CODES, {"l_returnflag": "returnflag", "l_linestatus": "linestatus",
                                       "o_orderpriority": "priority"})
    return x.select("l_orderkey", "l_linenumber", "l_returnflag_text", "l_linestatus_text", "o_orderpriority_text")


# Report order of part types.
TYPE_RANK = {"ECONOMY": 1, "STANDARD": 2, "SMALL": 3, "MEDIUM": 4, "LARGE": 5}


@register("ordered_dimension", """
WITH d AS (SELECT DISTINCT p_type, p_brand FROM part)
SELECT p_type, p_brand,
       CAST(CASE p_type WHEN 'ECONOMY' THEN 1 WHEN 'STANDARD' THEN 2 WHEN 'SMALL' THEN 3 WHEN 'MEDIUM' THEN 4
            WHEN 'LARGE' THEN 5 ELSE 6 END AS INTEGER) AS sort_rank,
       concat_ws(' / ', p_type, p_brand) AS label
FROM d
""")
def q_ordered_dimension(spark, sf):
    p = read_table(spark, sf, "part", ["p_type", "p_brand"])
    return C.ordered_dimension(p, ["p_type", "p_brand"], "p_type", TYPE_RANK)


@register("dedupe_latest", """
SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, l_quantity, l_extendedprice, l_discount, l_tax,
       l_returnflag, l_linestatus, l_shipdate FROM (
  SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY l_shipdate DESC, l_partkey DESC,
         l_suppkey DESC, l_quantity DESC, l_extendedprice DESC, l_discount DESC, l_tax DESC, l_returnflag DESC,
         l_linestatus DESC) rn FROM lineitem) WHERE rn = 1
""")
def q_dedupe_latest(spark, sf):
    li = read_table(spark, sf, "lineitem")
    return C.dedupe_latest(li, ["l_orderkey", "l_linenumber"], ["l_shipdate"])


@register("purge_ambiguous", """
WITH bad AS (SELECT DISTINCT l_orderkey FROM lineitem GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1)
SELECT l_orderkey, l_linenumber, l_partkey FROM lineitem WHERE l_orderkey NOT IN (SELECT l_orderkey FROM bad)
""")
def q_purge_ambiguous(spark, sf):
    li = read_table(spark, sf, "lineitem", ["l_orderkey", "l_linenumber", "l_partkey"])
    return C.purge_ambiguous(li, ["l_orderkey", "l_linenumber"], "l_orderkey")


@register("split_processed", """
SELECT DISTINCT o_orderkey, o_custkey,
       NOT EXISTS (SELECT 1 FROM orders e WHERE e.o_orderstatus = 'P' AND e.o_orderkey = o.o_orderkey
                   AND e.o_custkey = o.o_custkey) AS processed
FROM orders o
""")
def q_split_processed(spark, sf):
    o = read_table(spark, sf, "orders", ["o_orderkey", "o_custkey", "o_orderstatus"])
    return split_processed(o, o.filter(F.col("o_orderstatus") == "P"), ["o_orderkey", "o_custkey"])


@register("sync_status", """
SELECT max(ts) AS high_water, count(*) AS n_rows, count(CASE WHEN user_id = 42 THEN 1 END) > 0 AS arrived FROM events
""")
def q_sync_status(spark, sf):
    ev = read_table(spark, sf, "events", ["ts", "user_id"])
    return sync_status(ev, "ts", F.col("user_id") == 42)
