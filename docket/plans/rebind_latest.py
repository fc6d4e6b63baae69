"""Rebinds: latest-state selection (O-14 .. O-19) and period/time/text functions."""

from __future__ import annotations

from pyspark.sql import functions as F

from docket.functions.periods import normalise_period
from docket.functions.text import scrub_placeholders
from docket.functions.times import parse_event_time
from docket.operators import latest as L
from docket.plans.registry import register
from docket.sources import read_table


@register("latest_per_key", """
SELECT user_id, event_type, event_id, ts, value FROM (
  SELECT *, row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts DESC, event_id DESC) AS rn
  FROM events) WHERE rn = 1
""")
def q_latest_per_key(spark, sf):
    ev = read_table(spark, sf, "events", ["user_id", "event_type", "event_id", "ts", "value"])
    return L.latest_per_key(ev, ["user_id", "event_type"], [F.col("ts").desc(), F.col("event_id").desc()])


@register("first_and_latest", """
WITH r AS (SELECT *, CASE o_orderstatus WHEN 'F' THEN 1 WHEN 'O' THEN 2 WHEN 'P' THEN 3 END AS r FROM orders),
best AS (SELECT o_custkey, min(r) AS br FROM r WHERE r IS NOT NULL GROUP BY o_custkey),
c AS (SELECT r.* FROM r JOIN best b ON r.o_custkey = b.o_custkey AND r.r = b.br),
f AS (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey, o_totalprice) AS rn1,
               row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC, o_totalprice DESC) AS rn2
      FROM c)
SELECT a.o_custkey, a.o_orderstatus AS chosen_class,
       a.o_orderdate AS first_o_orderdate, a.o_orderkey AS first_o_orderkey, a.o_totalprice AS first_o_totalprice,
       b.o_orderdate AS latest_o_orderdate, b.o_orderkey AS latest_o_orderkey, b.o_totalprice AS latest_o_totalprice
FROM f a JOIN f b ON a.o_custkey = b.o_custkey AND a.rn1 = 1 AND b.rn2 = 1
""")
def q_first_and_latest(spark, sf):
    o = read_table(spark, sf, "orders", ["o_custkey", "o_orderstatus", "o_orderdate", "o_orderkey", "o_totalprice"])
    return L.first_and_latest(o, ["o_custkey"], "o_orderstatus", ["F", "O", "P"],
                              ["o_orderdate", "o_orderkey"], ["o_totalprice"])


@register("latest_flag", """
SELECT o_orderkey, o_custkey, CAST(date_trunc('month', o_orderdate) AS DATE) AS order_month,
       COALESCE(date_trunc('month', o_orderdate) = max(date_trunc('month', o_orderdate)) OVER (PARTITION BY o_custkey), false) AS is_latest
FROM orders
""")
def q_latest_flag(spark, sf):
    o = read_table(spark, sf, "orders", ["o_orderkey", "o_custkey", "o_orderdate"])
    o = o.withColumn("order_month", F.trunc(F.col("o_orderdate").cast("date"), "month")).drop("o_orderdate")
    return L.latest_flag(o, ["o_custkey"], F.col("order_month"))


@register("latest_with_fallback", """
WITH acc AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) rn
                            FROM orders WHERE o_orderstatus = 'F') WHERE rn = 1),
anyo AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) rn
                        FROM orders) WHERE rn = 1)
SELECT y.o_custkey,
       CASE WHEN a.o_custkey IS NOT NULL THEN a.o_orderkey ELSE y.o_orderkey END AS o_orderkey,
       CASE WHEN a.o_custkey IS NOT NULL THEN a.o_orderdate ELSE y.o_orderdate END AS o_orderdate,
       CASE WHEN a.o_custkey IS NOT NULL THEN a.o_orderstatus ELSE y.o_orderstatus END AS o_orderstatus,
       CASE WHEN a.o_custkey IS NOT NULL THEN a.o_totalprice ELSE y.o_totalprice END AS o_totalprice,
       CASE WHEN a.o_custkey IS NOT NULL THEN 'accepted' ELSE 'submitted' END AS source
FROM anyo y LEFT JOIN acc a ON a.o_custkey = y.o_custkey
""")
def q_latest_with_fallback(spark, sf):
    o = read_table(spark, sf, "orders", ["o_custkey", "o_orderkey", "o_orderdate", "o_orderstatus", "o_totalprice"])
    return L.latest_with_fallback(o, ["o_custkey"], F.col("o_orderstatus") == "F",
                                  ["o_orderdate", "o_orderkey"],
                                  ["o_orderkey", "o_orderdate", "o_orderstatus", "o_totalprice"])


@register("collapse_repeats", """
SELECT event_id, user_id, ts, event_type FROM (
  SELECT *, lead(event_type) OVER w AS nt, lead(props) OVER w AS np
  FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id))
WHERE NOT COALESCE(nt = event_type AND np <> props, false)
""")
def q_collapse_repeats(spark, sf):
    ev = read_table(spark, sf, "events", ["event_id", "user_id", "ts", "event_type", "props"])
    out = L.collapse_repeats(ev, ["user_id"], ["ts", "event_id"], "event_type", "props")
    return out.select("event_id", "user_id", "ts", "event_type")


@register("source_preference_latest", """
WITH a AS (SELECT o.o_custkey, CAST(year(l.l_shipdate) AS INTEGER) AS yr, 'lineitem' AS src, l.l_shipdate AS event_ts,
                  l.l_orderkey AS ref, 1 AS source_rank
           FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey),
b AS (SELECT o_custkey, CAST(year(o_orderdate) AS INTEGER) AS yr, 'orders' AS src, o_orderdate AS event_ts, o_orderkey AS ref,
             2 AS source_rank FROM orders),
u AS (SELECT * FROM a UNION ALL SELECT * FROM b)
SELECT o_custkey, yr, src, event_ts, ref, source_rank FROM (
  SELECT *, row_number() OVER (PARTITION BY o_custkey, yr ORDER BY source_rank, event_ts DESC, ref DESC) rn FROM u)
WHERE rn = 1
""")
def q_source_preference_latest(spark, sf):
    li = read_table(spark, sf, "lineitem", ["l_orderkey", "l_shipdate"])
    o = read_table(spark, sf, "orders", ["o_orderkey", "o_custkey", "o_orderdate"])
    a = (li.join(o, li.l_orderkey == o.o_orderkey)
         .select("o_custkey", F.year("l_shipdate").alias("yr"), F.lit("lineitem").alias("src"),
                 F.col("l_shipdate").alias("event_ts"), F.col("l_orderkey").alias("ref")))
    b = o.select("o_custkey", F.year("o_orderdate").alias("yr"), F.lit("orders").alias("src"),
                 F.col("o_orderdate").alias("event_ts"), F.col("o_orderkey").alias("ref"))
    return L.source_preference_latest([(a, 1), (b, 2)], ["o_custkey", "yr"],
                                      [F.col("event_ts").desc(), F.col("ref").desc()])


def _period_label():
    half = F.month("o_orderdate") <= 6
    short = F.concat(F.when(half, F.lit("Jan to Jun ")).otherwise(F.lit("Jul to Dec ")),
                     F.date_format("o_orderdate", "yy"))
    full = F.concat(F.when(half, F.lit("January to June ")).otherwise(F.lit("July to December ")),
                    F.date_format("o_orderdate", "yyyy"))
    return F.when(F.col("o_orderstatus") == "O", short).otherwise(full)


@register("normalise_period", r"""
WITH l AS (
  SELECT o_orderkey, o_orderstatus,
    CASE WHEN o_orderstatus = 'O'
         THEN (CASE WHEN month(o_orderdate) <= 6 THEN 'Jan to Jun ' ELSE 'Jul to Dec ' END) || strftime(o_orderdate, '%y')
         ELSE (CASE WHEN month(o_orderdate) <= 6 THEN 'January to June ' ELSE 'July to December ' END) || strftime(o_orderdate, '%Y')
    END AS period_label FROM orders),
p AS (
  SELECT *, CAST(regexp_extract(trim(period_label), '([0-9]+)$', 1) AS INTEGER) AS ytok,
         rtrim(regexp_replace(trim(period_label), '[0-9]+$', '')) AS head FROM l),
c AS (
  SELECT *, regexp_replace(regexp_replace(regexp_replace(regexp_replace(regexp_replace(regexp_replace(head,
            '\bJan\b', 'January'), '\bJun\b', 'June'), '\bDec\b', 'December'), '\bMar\b', 'March'),
            '\bApr\b', 'April'), '\bJul\b', 'July') || ' ' || CAST(CASE WHEN ytok < 2000 THEN ytok + 2000 ELSE ytok END AS VARCHAR)
         AS canonical_period,
         CASE WHEN regexp_matches(right(rtrim(period_label), 4), '^[0-9]{4}$') THEN CAST(right(rtrim(period_label), 4) AS INTEGER)
              WHEN regexp_matches(right(rtrim(period_label), 2), '^[0-9]{2}$') THEN CAST(right(rtrim(period_label), 2) AS INTEGER) + 2000
         END AS period_year
  FROM p),
d AS (
  SELECT DISTINCT canonical_period, CAST(regexp_extract(canonical_period, '([0-9]+)$', 1) AS INTEGER) AS ry,
         2 * (CAST(regexp_extract(canonical_period, '([0-9]+)$', 1) AS INTEGER) - 1995)
         + CASE WHEN canonical_period LIKE 'January to June %' THEN 1 ELSE 2 END AS ord
  FROM c WHERE regexp_full_match(canonical_period, '(January to June|July to December) [0-9]{4}'))
SELECT c.o_orderkey, c.period_label, c.canonical_period, c.period_year,
       CAST(COALESCE(d.ord, 0) AS INTEGER) AS period_ordinal, CAST(COALESCE(d.ry, 0) AS INTEGER) AS reporting_year,
       c.period_year + CASE WHEN c.o_orderstatus = 'F' THEN 1 ELSE 0 END AS relevant_year
FROM c LEFT JOIN d ON c.canonical_period = d.canonical_period
""")
def q_normalise_period(spark, sf):
    o = read_table(spark, sf, "orders", ["o_orderkey", "o_orderstatus", "o_orderdate"])
    o = o.withColumn("period_label", _period_label())
    out = normalise_period(o, "period_label", 1995,
                           shift=F.when(F.col("o_orderstatus") == "F", 1).otherwise(0))
    return out.select("o_orderkey", "period_label", "canonical_period", "period_year", "period_ordinal",
                      "reporting_year", "relevant_year")


@register("parse_event_time", """
WITH t AS (SELECT event_id, strftime(ts, '%Y-%m-%dT%H:%M:%S.%fZ') AS ts_text FROM events)
SELECT event_id, ts_text,
       strptime(substr(replace(ts_text, 'T', ' '), 1, 23), '%Y-%m-%d %H:%M:%S.%g') AS parsed_millis,
       strptime(ts_text, '%Y-%m-%dT%H:%M:%S.%fZ') AS parsed_utc
FROM t
""")
def q_parse_event_time(spark, sf):
    ev = read_table(spark, sf, "events", ["event_id", "ts"])
    ev = ev.withColumn("ts_text", F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'"))
    return ev.select("event_id", "ts_text", parse_event_time("ts_text", "millis").alias("parsed_millis"),
                     parse_event_time("ts_text", "utc").alias("parsed_utc"))


@register("scrub_placeholders", """
SELECT o_orderkey,
       CASE WHEN trim(split_part(o_orderpriority, '-', 2)) = ''
              OR upper(trim(split_part(o_orderpriority, '-', 2))) IN ('N/A', 'NA', 'NONE', 'NULL', '-', 'NOT APPLICABLE', 'NOT SPECIFIED')
            THEN NULL ELSE trim(split_part(o_orderpriority, '-', 2)) END AS priority_clean
FROM orders
""")
def q_scrub_placeholders(spark, sf):
    from docket.functions.text import DEFAULT_PLACEHOLDERS
    o = read_table(spark, sf, "orders", ["o_orderkey", "o_orderpriority"])
    part = F.split_part(F.col("o_orderpriority"), F.lit("-"), F.lit(2))
    return o.select("o_orderkey", scrub_placeholders(part, DEFAULT_PLACEHOLDERS + ["NOT SPECIFIED"])
                    .alias("priority_clean"))


def _raw_status():
    return (F.when(F.col("o_orderstatus") == "F", F.lit("Granted"))
            .when((F.col("o_orderstatus") == "O") & (F.col("o_orderpriority") == "3-MEDIUM"), F.lit(" queried "))
            .when(F.col("o_orderstatus") == "O", F.lit(None).cast("string"))
            .otherwise(F.lit("Rejected")))


@register("submission_first_latest", """
WITH x AS (
  SELECT o_custkey, CAST(year(o_orderdate) AS INTEGER) AS year, o_orderdate AS t, o_orderkey AS f,
         upper(trim(COALESCE(CASE WHEN o_orderstatus = 'F' THEN 'Granted'
                                  WHEN o_orderstatus = 'O' AND o_orderpriority = '3-MEDIUM' THEN ' queried '
                                  WHEN o_orderstatus = 'O' THEN NULL ELSE 'Rejected' END, 'PENDING'))) AS s,
         o_orderpriority = '1-URGENT' AS resub
  FROM orders),
c AS (SELECT *, CASE WHEN s = 'QUERIED' THEN 'PENDING' WHEN s IN ('GRANTED', 'REFUSED', 'CANCELLED', 'APPROVED')
                     THEN 'ACCEPTED' ELSE s END AS cls FROM x),
pa0 AS (SELECT * FROM c WHERE cls IN ('PENDING', 'ACCEPTED') AND NOT resub),
nw AS (SELECT o_custkey, year, s AS newest FROM (
         SELECT *, row_number() OVER (PARTITION BY o_custkey, year ORDER BY t DESC, f DESC) rn FROM pa0) WHERE rn = 1),
pa1 AS (SELECT pa0.* FROM pa0 JOIN nw USING (o_custkey, year) WHERE pa0.s <> 'QUERIED' OR nw.newest = 'QUERIED'),
pa2 AS (SELECT *, lead(s) OVER w AS ns, lead(f) OVER w AS nf FROM pa1
        WINDOW w AS (PARTITION BY o_custkey, year ORDER BY t, f)),
pa AS (SELECT * FROM pa2 WHERE NOT (s = 'QUERIED' AND COALESCE(ns = 'QUERIED' AND nf <> f, false))),
rej AS (SELECT * FROM c WHERE cls = 'REJECTED' AND NOT resub),
rej_r AS (SELECT * FROM c WHERE cls = 'REJECTED' AND resub),
pa_r AS (SELECT * FROM c WHERE cls IN ('PENDING', 'ACCEPTED') AND resub),
keys AS (SELECT DISTINCT o_custkey, year FROM c),
firsts AS (
  SELECT k.o_custkey, k.year,
         COALESCE((SELECT min((t, f, s)) FROM pa WHERE pa.o_custkey = k.o_custkey AND pa.year = k.year),
                  (SELECT max((t, f, s)) FROM rej WHERE rej.o_custkey = k.o_custkey AND rej.year = k.year)) AS fr
  FROM keys k),
cands AS (
  SELECT o_custkey, year, t, f, s FROM pa
  UNION ALL SELECT r.o_custkey, r.year, r.t, r.f, r.s FROM rej_r r
    WHERE NOT EXISTS (SELECT 1 FROM pa_r p WHERE p.o_custkey = r.o_custkey AND p.year = r.year)
  UNION ALL SELECT o_custkey, year, t, f, s FROM pa_r),
lat AS (SELECT o_custkey, year, t, f, s FROM (
          SELECT *, row_number() OVER (PARTITION BY o_custkey, year ORDER BY t DESC, f DESC) rn FROM cands) WHERE rn = 1)
SELECT k.o_custkey, k.year, k.fr[1] AS first_time, k.fr[2] AS first_file, k.fr[3] AS first_status,
       lat.t AS latest_time, lat.f AS latest_file, lat.s AS latest_status
FROM firsts k LEFT JOIN lat ON lat.o_custkey = k.o_custkey AND lat.year = k.year
""")
def q_submission_first_latest(spark, sf):
    o = read_table(spark, sf, "orders", ["o_custkey", "o_orderkey", "o_orderdate", "o_orderstatus", "o_orderpriority"])
    o = o.withColumn("year", F.year("o_orderdate")).withColumn("raw_status", _raw_status())
    return L.submission_first_latest(o, ["o_custkey", "year"], "o_orderdate", "o_orderkey", "raw_status",
                                     F.col("o_orderpriority") == "1-URGENT").select(
            "o_custkey", "year", "first_time", "first_file", "first_status", "latest_time", "latest_file",
            "latest_status")
