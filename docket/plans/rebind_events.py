"""Rebinds: event reconciliation (O-20 .. O-27)."""

from __future__ import annotations

from pyspark.sql import functions as F

from docket.functions.periods import year_quarter
from docket.operators import events as E
from docket.operators.rules import journey_cutoff
from docket.plans.registry import ORACLES, register
from docket.sources import read_table


@register("asof_attribute", """
SELECT p.user_id, p.event_id, p.ts, v.event_id AS anchor_event_id, v.ts AS anchor_ts
FROM (SELECT * FROM events WHERE event_type = 'purchase') p
LEFT JOIN LATERAL (
  SELECT e.event_id, e.ts FROM events e
  WHERE e.event_type = 'view' AND e.user_id = p.user_id AND e.ts < p.ts
  ORDER BY e.ts DESC, e.event_id DESC LIMIT 1) v ON true
""")
def q_asof_attribute(spark, sf):
    ev = read_table(spark, sf, "events", ["event_id", "user_id", "ts", "event_type"])
    purchases = ev.filter(F.col("event_type") == "purchase")
    views = ev.filter(F.col("event_type") == "view")
    return E.asof_attribute(purchases, views, ["user_id"], "ts", "ts", ["event_id", "ts"],
                            ["ts", "event_id"], strict=True)


@register("asof_attribute_forward", """
SELECT p.user_id, p.event_id, p.ts, v.event_id AS anchor_event_id, v.ts AS anchor_ts
FROM (SELECT * FROM events WHERE event_type = 'error') p
LEFT JOIN LATERAL (
  SELECT e.event_id, e.ts FROM events e
  WHERE e.event_type = 'signup' AND e.user_id = p.user_id AND e.ts >= p.ts
  ORDER BY e.ts, e.event_id LIMIT 1) v ON true
""")
def q_asof_attribute_forward(spark, sf):
    ev = read_table(spark, sf, "events", ["event_id", "user_id", "ts", "event_type"])
    errors = ev.filter(F.col("event_type") == "error")
    signups = ev.filter(F.col("event_type") == "signup")
    return E.asof_attribute(errors, signups, ["user_id"], "ts", "ts", ["event_id", "ts"],
                            ["ts", "event_id"], strict=False, direction="forward")


@register("event_state", """
WITH d AS (SELECT user_id, ts, event_id, CASE WHEN value >= 25 THEN 'Granted' ELSE 'Refused' END AS word
           FROM events WHERE event_type = 'error'),
ld AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) rn FROM d) WHERE rn = 1),
s AS (SELECT user_id, min(ts) AS first_submit_ts, max(ts) AS latest_submit_ts, count(*) AS n_submits
      FROM events WHERE event_type = 'purchase' GROUP BY user_id),
dc AS (SELECT user_id, count(*) AS n_decisions, min(CASE WHEN word = 'Granted' THEN ts END) AS first_granted_ts
       FROM d GROUP BY user_id),
r AS (SELECT user_id, max(ts) AS latest_resubmit_ts FROM events WHERE event_type = 'signup' GROUP BY user_id),
u AS (SELECT DISTINCT user_id FROM events)
SELECT u.user_id, s.first_submit_ts, s.latest_submit_ts, COALESCE(s.n_submits, 0) AS n_submits,
       ld.ts AS latest_decision_ts, ld.word AS latest_decision, COALESCE(dc.n_decisions, 0) AS n_decisions,
       dc.first_granted_ts, r.latest_resubmit_ts,
       CASE WHEN ld.ts IS NULL THEN 'Pending' WHEN s.latest_submit_ts > ld.ts THEN 'Pending' ELSE ld.word END AS status,
       CASE WHEN r.latest_resubmit_ts IS NULL THEN NULL WHEN ld.ts >= r.latest_resubmit_ts THEN ld.word
            ELSE 'Pending' END AS resubmission_status
FROM u LEFT JOIN s ON s.user_id = u.user_id LEFT JOIN ld ON ld.user_id = u.user_id
LEFT JOIN dc ON dc.user_id = u.user_id LEFT JOIN r ON r.user_id = u.user_id
""")
def q_event_state(spark, sf):
    ev = read_table(spark, sf, "events", ["event_id", "user_id", "ts", "event_type", "value"])
    decision = F.when(F.col("value") >= 25, F.lit("Accepted")).otherwise(F.lit("Rejected"))
    return E.event_state(ev, "user_id", "ts", "event_id", "event_type", "purchase", "error", "signup", decision)


@register("file_decision_status", """
WITH f AS (SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_shipdate, l_linestatus,
                  CASE WHEN l_returnflag = 'A' THEN 'Accepted'
                       WHEN l_returnflag = 'R' AND l_linestatus = 'F' THEN 'Rejected' END AS dec,
                  (l_returnflag = 'R' AND l_linestatus = 'O') AS cancel
           FROM lineitem),
c AS (SELECT l_orderkey, max(CAST(cancel AS INTEGER)) AS sc FROM f GROUP BY l_orderkey),
nd AS (SELECT l_orderkey, dec AS sd FROM (
         SELECT *, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_shipdate DESC, dec DESC) rn
         FROM f WHERE dec IS NOT NULL) WHERE rn = 1),
x AS (SELECT f.*, c.sc, COALESCE(f.dec, nd.sd) AS eff FROM f JOIN c USING (l_orderkey) LEFT JOIN nd USING (l_orderkey))
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey,
       CASE WHEN sc = 1 THEN 'Cancelled'
            WHEN eff IS NOT NULL THEN
              CASE WHEN eff = 'Accepted' AND year(l_shipdate) >= 1999 THEN 'Granted'
                   WHEN eff = 'Rejected' AND year(l_shipdate) >= 1999 THEN 'Refused' ELSE eff END
            WHEN l_linestatus = 'O' THEN 'Pending' ELSE 'Uploaded' END AS status
FROM x
""")
def q_file_decision_status(spark, sf):
    li = read_table(spark, sf, "lineitem", ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey",
                                            "l_shipdate", "l_linestatus", "l_returnflag"])
    decision = (F.when(F.col("l_returnflag") == "A", F.lit("Accepted"))
                .when((F.col("l_returnflag") == "R") & (F.col("l_linestatus") == "F"), F.lit("Rejected")))
    cancel = (F.col("l_returnflag") == "R") & (F.col("l_linestatus") == "O")
    out = E.file_decision_status(li, "l_orderkey", decision, "l_shipdate", cancel,
                                 F.col("l_linestatus") == "O", F.year("l_shipdate"), 1999)
    return out.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "status")


@register("prior_stats", """
SELECT event_id, user_id, event_type, n_prior_decisions, n_prior_accepted, last_rejection_value FROM (
  SELECT event_id, user_id, event_type, ts,
         CAST(COALESCE(sum(CASE WHEN event_type = 'error' THEN 1 ELSE 0 END) OVER w, 0) AS BIGINT) AS n_prior_decisions,
         CAST(COALESCE(sum(CASE WHEN event_type = 'error' AND value >= 25 THEN 1 ELSE 0 END) OVER w, 0) AS BIGINT) AS n_prior_accepted,
         last_value(CASE WHEN event_type = 'error' AND value < 25 THEN value END IGNORE NULLS) OVER w AS last_rejection_value,
         max(ts) OVER (PARTITION BY user_id) AS mx
  FROM events
  WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING))
WHERE event_type <> 'view' OR ts = mx
""")
def q_prior_stats(spark, sf):
    ev = read_table(spark, sf, "events", ["event_id", "user_id", "ts", "event_type", "value"])
    is_err = F.col("event_type") == "error"
    out = E.prior_stats(ev, ["user_id"], ["ts", "event_id"],
                        counts={"n_prior_decisions": is_err,
                                "n_prior_accepted": is_err & (F.col("value") >= 25)},
                        lasts={"last_rejection_value": (is_err & (F.col("value") < 25), F.col("value"))},
                        pending=F.col("event_type") == "view", newest=F.col("ts"))
    return out.select("event_id", "user_id", "event_type", "n_prior_decisions", "n_prior_accepted",
                      "last_rejection_value")


@register("resubmission_split", """
WITH m AS (SELECT user_id, min(ts) AS fm FROM events WHERE event_type = 'signup' GROUP BY user_id)
SELECT e.event_id, e.user_id, e.ts,
       CASE WHEN m.fm IS NOT NULL AND e.ts > m.fm THEN 'resubmission' ELSE 'original' END AS kind
FROM events e LEFT JOIN m ON e.user_id = m.user_id WHERE e.event_type = 'purchase'
""")
def q_resubmission_split(spark, sf):
    ev = read_table(spark, sf, "events", ["event_id", "user_id", "ts", "event_type"])
    return E.resubmission_split(ev, "user_id", "ts", "event_type", "signup", "purchase") \
        .select("event_id", "user_id", "ts", "kind")


@register("audit_history", """
WITH v AS (SELECT user_id, ts, event_id, json_extract_string(props, '$.k') AS value FROM events),
h AS (SELECT user_id, value, min(ts) AS first_seen, max(ts) AS last_seen, count(*) AS n_versions
      FROM v WHERE value IS NOT NULL GROUP BY user_id, value),
c AS (SELECT user_id, value AS cur FROM (
        SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) rn
        FROM v WHERE value IS NOT NULL) WHERE rn = 1)
SELECT h.*, h.value = c.cur AS is_current FROM h LEFT JOIN c ON h.user_id = c.user_id
""")
def q_audit_history(spark, sf):
    ev = read_table(spark, sf, "events", ["event_id", "user_id", "ts", "props"])
    return E.audit_history(ev, "user_id", "ts", "event_id", "props", "$.k")


def order_size():
    return F.when(F.col("o_orderpriority").isin("1-URGENT", "2-HIGH"), F.lit("large")).otherwise(F.lit("small"))
ORDER_SIZE_SQL = "CASE WHEN o_orderpriority IN ('1-URGENT', '2-HIGH') THEN 'large' ELSE 'small' END"
CALENDAR_SQL = """
SELECT 'small' AS size, y AS year, make_date(y, 4, 2) AS deadline FROM (SELECT DISTINCT year(o_orderdate)::INTEGER AS y FROM orders) t
UNION ALL
SELECT 'large', y, CASE WHEN y >= 1998 THEN make_date(y - 1, 10, 2) ELSE make_date(y, 4, 2) END FROM (SELECT DISTINCT year(o_orderdate)::INTEGER AS y FROM orders) t
"""


@register("deadline_flags", f"""
WITH f AS (SELECT o_custkey, {ORDER_SIZE_SQL} AS size, CAST(year(o_orderdate) AS INTEGER) AS year, min(o_orderdate) AS first_submission
           FROM orders GROUP BY ALL),
cal AS ({CALENDAR_SQL})
SELECT f.o_custkey, f.size, f.year, f.first_submission, cal.deadline, f.first_submission >= cal.deadline AS is_late
FROM f LEFT JOIN cal ON f.size = cal.size AND f.year = cal.year
""")
def q_deadline_flags(spark, sf):
    o = read_table(spark, sf, "orders", ["o_custkey", "o_orderdate", "o_orderpriority"])
    out = E.deadline_flags(o, ["o_custkey"], "o_orderdate", order_size(), 1998)
    return out.select("o_custkey", "size", "year", "first_submission", "deadline", "is_late")


@register("upload_bundle", """
WITH lo AS (SELECT o_custkey, o_orderkey FROM (
    SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) rn FROM orders)
  WHERE rn = 1),
b AS (SELECT lo.o_custkey, lo.o_orderkey,
        count(CASE WHEN l_returnflag = 'A' THEN 1 END) AS n_A, round(sum(CASE WHEN l_returnflag = 'A' THEN l_quantity END), 2) AS sum_A,
        count(CASE WHEN l_returnflag = 'N' THEN 1 END) AS n_N, round(sum(CASE WHEN l_returnflag = 'N' THEN l_quantity END), 2) AS sum_N,
        count(CASE WHEN l_returnflag = 'R' THEN 1 END) AS n_R, round(sum(CASE WHEN l_returnflag = 'R' THEN l_quantity END), 2) AS sum_R,
        string_agg(DISTINCT l_returnflag, ',' ORDER BY l_returnflag) AS member_types
      FROM lo JOIN lineitem l ON l.l_orderkey = lo.o_orderkey GROUP BY lo.o_custkey, lo.o_orderkey)
SELECT lo.o_custkey, lo.o_orderkey, COALESCE(b.n_A, 0) AS n_A, b.sum_A, COALESCE(b.n_N, 0) AS n_N, b.sum_N,
       COALESCE(b.n_R, 0) AS n_R, b.sum_R, b.member_types
FROM lo LEFT JOIN b ON lo.o_custkey = b.o_custkey AND lo.o_orderkey = b.o_orderkey
""")
def q_upload_bundle(spark, sf):
    o = read_table(spark, sf, "orders", ["o_custkey", "o_orderkey", "o_orderdate"])
    li = read_table(spark, sf, "lineitem", ["l_orderkey", "l_returnflag", "l_quantity"]) \
        .withColumnRenamed("l_orderkey", "o_orderkey")
    return E.upload_bundle(o, li, "o_custkey", "o_orderkey", [F.col("o_orderdate").desc(), F.col("o_orderkey").desc()],
                           "l_returnflag", ["A", "N", "R"], "l_quantity")


@register("registration_state", """
WITH e AS (
  SELECT user_id, event_id, ts, event_type,
         CASE WHEN event_type = 'view' OR (event_type = 'error' AND value > 40)
              THEN json_extract_string(props, '$.k') END AS file_id,
         CASE WHEN event_type = 'error' AND value >= 5 THEN (CASE WHEN value >= 25 THEN 'Accepted' ELSE 'Rejected' END)
         END AS decision,
         COALESCE(event_type = 'purchase' AND CAST(json_extract_string(props, '$.k') AS INTEGER) >= 50, false) AS resub
  FROM events),
up AS (SELECT * FROM e WHERE event_type = 'view'),
o AS (SELECT e.*, a.file_id AS afile FROM e LEFT JOIN LATERAL (
        SELECT u.file_id FROM up u WHERE u.user_id = e.user_id AND u.ts < e.ts ORDER BY u.ts DESC, u.event_id DESC,
               u.file_id DESC LIMIT 1) a ON true
      WHERE e.event_type IN ('purchase', 'error')),
apps AS (SELECT * FROM o WHERE event_type = 'purchase'),
regd AS (SELECT *, CASE WHEN trim(decision) = 'Accepted' THEN 'Granted' WHEN trim(decision) = 'Rejected' THEN 'Refused'
                        WHEN decision IS NULL THEN 'Pending' ELSE decision END AS w
         FROM o WHERE event_type = 'error' AND file_id IS NULL),
resd AS (SELECT *, COALESCE(decision, 'Pending') AS w FROM o WHERE event_type = 'error' AND file_id IS NOT NULL),
k AS (SELECT DISTINCT user_id FROM o),
fa AS (SELECT user_id, ts, afile FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) rn
                                       FROM apps WHERE NOT resub) WHERE rn = 1),
ia AS (SELECT user_id, ts, afile FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) rn
                                       FROM apps WHERE NOT resub) WHERE rn = 1),
ra AS (SELECT user_id, ts, afile FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) rn
                                       FROM apps WHERE resub) WHERE rn = 1),
ld AS (SELECT user_id, ts, w FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) rn
                                   FROM regd) WHERE rn = 1),
gr AS (SELECT user_id, max(ts) AS granted_time FROM regd WHERE w = 'Granted' GROUP BY user_id),
la AS (SELECT user_id, max(ts) AS t FROM apps GROUP BY user_id),
rd AS (SELECT user_id, file_id, w FROM (SELECT *, row_number() OVER (PARTITION BY user_id, file_id ORDER BY ts DESC, event_id DESC) rn
                                        FROM resd) WHERE rn = 1)
SELECT k.user_id, fa.ts AS first_application_time, fa.afile AS first_application_file,
       ia.ts AS initial_application_time, ia.afile AS initial_application_file,
       ra.ts AS resubmission_time, ra.afile AS resubmission_file,
       ld.ts AS latest_decision_time, ld.w AS latest_decision, gr.granted_time,
       CASE WHEN la.t > ld.ts THEN 'Pending' WHEN ld.w IS NOT NULL THEN ld.w
            WHEN gr.granted_time IS NOT NULL THEN 'Granted' ELSE 'Pending' END AS status,
       CASE WHEN ra.user_id IS NULL THEN NULL WHEN rd.w IS NOT NULL THEN rd.w ELSE 'Pending' END AS resubmission_status
FROM k LEFT JOIN fa ON fa.user_id = k.user_id LEFT JOIN ia ON ia.user_id = k.user_id
LEFT JOIN ra ON ra.user_id = k.user_id LEFT JOIN ld ON ld.user_id = k.user_id LEFT JOIN gr ON gr.user_id = k.user_id
LEFT JOIN la ON la.user_id = k.user_id LEFT JOIN rd ON rd.user_id = k.user_id AND rd.file_id = ra.afile
""")
def q_registration_state(spark, sf):
    ev = registration_log(read_table(spark, sf, "events", ["event_id", "user_id", "ts", "event_type", "value", "props"]))
    return registration_fold(ev)


def registration_log(ev):
    """Events as a registration log: each row by itself, so that a stream can be prepared alike."""
    k = F.get_json_object("props", "$.k")
    return ev.select(
        "user_id", "event_id", "ts", "event_type",
        F.when((F.col("event_type") == "view") | ((F.col("event_type") == "error") & (F.col("value") > 40)), k)
         .alias("file_id"),
        F.when((F.col("event_type") == "error") & (F.col("value") >= 5),
               F.when(F.col("value") >= 25, F.lit("Accepted")).otherwise(F.lit("Rejected"))).alias("decision"),
        F.coalesce((F.col("event_type") == "purchase") & (k.cast("int") >= 50), F.lit(False)).alias("resub"))


def registration_fold(ev, **more):
    return E.registration_state(ev, "user_id", "ts", "event_id", "event_type", "file_id", "decision", F.col("resub"),
                                "view", "purchase", "error", **more)


_YEAR_SQL = "2023 + user_id % 4"


@register("registration_details", f"""
WITH state AS ({ORACLES["registration_state"]}),
e AS (
  SELECT user_id, event_id, ts, event_type,
         CASE WHEN event_type = 'view' OR (event_type = 'error' AND value > 40) THEN json_extract_string(props, '$.k') END AS file_id,
         COALESCE(event_type = 'purchase' AND CAST(json_extract_string(props, '$.k') AS INTEGER) >= 50, false) AS resub,
         CASE WHEN event_id % 3 <> 0 THEN 'u' || (event_id % 11) END AS who, CASE WHEN event_id % 2 = 0 THEN 'note ' || event_id END AS note
  FROM events),
ia AS (SELECT * FROM e WHERE event_type = 'purchase' AND NOT resub QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) = 1),
ra AS (SELECT * FROM e WHERE event_type = 'purchase' AND resub QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) = 1),
ld AS (SELECT * FROM e WHERE event_type = 'error' AND file_id IS NULL QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) = 1),
rd AS (SELECT e.* FROM e JOIN state s ON s.user_id = e.user_id AND e.file_id = s.resubmission_file WHERE event_type = 'error'
       QUALIFY row_number() OVER (PARTITION BY e.user_id ORDER BY ts DESC, event_id DESC) = 1),
c AS (SELECT user_id, CASE WHEN user_id % 5 = 0 THEN 'DirectLargeProducer' WHEN user_id % 5 = 1 THEN 'CsoSmallProducer' END AS journey,
             CASE user_id % 3 WHEN 0 THEN 'L' WHEN 1 THEN 'S' END AS size, user_id % 2 = 0 AS scheme,
             make_date({_YEAR_SQL}, 4, 2) AS small, CASE WHEN {_YEAR_SQL} >= 2024 THEN make_date({_YEAR_SQL} - 1, 10, 2) ELSE make_date({_YEAR_SQL}, 4, 2) END AS large
      FROM state),
k AS (SELECT user_id, CASE WHEN journey = 'DirectLargeProducer' THEN large WHEN journey = 'CsoSmallProducer' THEN small
                           WHEN size = 'L' THEN large WHEN size = 'S' THEN small WHEN scheme THEN large END AS cutoff FROM c)
SELECT s.*, COALESCE(s.resubmission_file, s.initial_application_file) AS current_file,
       COALESCE(ra.who, ia.who) AS producer_user, COALESCE(rd.who, ld.who) AS regulator_user,
       ia.note AS application_comment, ra.note AS resubmission_comment, COALESCE(rd.note, ld.note) AS regulator_comment,
       COALESCE(s.first_application_time >= k.cutoff, false) AS late, COALESCE(s.resubmission_time >= k.cutoff, false) AS resubmission_late
FROM state s LEFT JOIN k ON k.user_id = s.user_id LEFT JOIN ia ON ia.user_id = s.user_id LEFT JOIN ra ON ra.user_id = s.user_id
LEFT JOIN ld ON ld.user_id = s.user_id LEFT JOIN rd ON rd.user_id = s.user_id
""")
def q_registration_details(spark, sf):
    ev = read_table(spark, sf, "events", ["event_id", "user_id", "ts", "event_type", "value", "props"])
    i, u = F.col("event_id"), F.col("user_id")
    log = registration_log(ev).withColumn("who", F.when(i % 3 != 0, F.concat(F.lit("u"), (i % 11).cast("string")))) \
                              .withColumn("note", F.when(i % 2 == 0, F.concat(F.lit("note "), i.cast("string"))))
    year = (2023 + u % 4).cast("int")
    journey = F.when(u % 5 == 0, "DirectLargeProducer").when(u % 5 == 1, "CsoSmallProducer")
    size = F.when(u % 3 == 0, "L").when(u % 3 == 1, "S")
    cutoff = journey_cutoff(journey, size, u % 2 == 0, E.size_deadline(F.lit("large"), year, 2024), E.size_deadline(F.lit("small"), year, 2024))
    cutoffs = ev.select("user_id").distinct().select("user_id", cutoff.alias("cutoff"))
    return registration_fold(log, user="who", comment="note", cutoffs=cutoffs)


@register("audit_versions", """
WITH p AS (SELECT CASE WHEN event_id % 3 <> 0 THEN '{"user":' || user_id || ',"level":' || (event_id % 4) || '}' END AS o,
                  CASE WHEN event_id % 5 <> 0 THEN '{"user":' || user_id || ',"level":' || (event_id % 6) || '}' END AS n FROM events)
SELECT DISTINCT json_extract_string(v, '$.user') AS entity, json_extract_string(v, '$.level') AS level
FROM (SELECT o AS v FROM p UNION ALL SELECT n FROM p) WHERE v IS NOT NULL
""")
def q_audit_versions(spark, sf):
    ev = read_table(spark, sf, "events", ["event_id", "user_id"])
    text = lambda m: F.concat(F.lit('{"user":'), F.col("user_id").cast("string"), F.lit(',"level":'), (F.col("event_id") % m).cast("string"), F.lit("}"))
    log = ev.select(F.when(F.col("event_id") % 3 != 0, text(4)).alias("old"), F.when(F.col("event_id") % 5 != 0, text(6)).alias("new"))
    return E.audit_versions(log, "old", "new", {"entity": "$.user", "level": "$.level"})


@register("latest_actor", """
WITH a AS (SELECT user_id, CASE WHEN event_type <> 'view' THEN CAST(event_id % 30 AS INTEGER) END AS actor, ts, event_id FROM events),
r AS (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS rn FROM a WHERE actor IS NOT NULL)
SELECT r.user_id, r.actor, COALESCE(trim(n.n_name), '') AS actor_name FROM r LEFT JOIN nation n ON n.n_nationkey = r.actor WHERE rn = 1
""")
def q_latest_actor(spark, sf):
    ev = read_table(spark, sf, "events", ["event_id", "user_id", "ts", "event_type"])
    log = ev.withColumn("actor", F.when(F.col("event_type") != "view", (F.col("event_id") % 30).cast("int")))
    people = read_table(spark, sf, "nation", ["n_nationkey", "n_name"])
    return E.latest_actor(log, "user_id", ["ts", "event_id"], "actor", people, "n_nationkey", ["n_name"])


@register("upload_files", """
WITH f AS (SELECT o_custkey, CAST(year(o_orderdate) * 10 + quarter(o_orderdate) AS INTEGER) AS period, l_orderkey, l_returnflag, l_linenumber, l_partkey, o_orderdate
           FROM lineitem JOIN orders ON o_orderkey = l_orderkey),
s AS (SELECT o_custkey, period, l_orderkey, o_orderdate, max(l_linenumber::BIGINT * 1000000000 + l_partkey) AS n, string_agg(DISTINCT l_returnflag, ',' ORDER BY l_returnflag) AS types,
             arg_max(l_partkey, l_linenumber::BIGINT * 1000000000 + l_partkey) FILTER (l_returnflag = 'A') AS a_l_partkey, arg_max(l_partkey, l_linenumber::BIGINT * 1000000000 + l_partkey) FILTER (l_returnflag = 'N') AS n_l_partkey
      FROM f GROUP BY o_custkey, period, l_orderkey, o_orderdate),
r AS (SELECT *, row_number() OVER (PARTITION BY o_custkey, period ORDER BY o_orderdate DESC, n DESC, l_orderkey DESC) AS rn FROM s)
SELECT o_custkey, period, l_orderkey, types, a_l_partkey, n_l_partkey FROM r WHERE rn = 1
""")
def q_upload_files(spark, sf):
    o = read_table(spark, sf, "orders", ["o_orderkey", "o_custkey", "o_orderdate"])
    li = read_table(spark, sf, "lineitem", ["l_orderkey", "l_linenumber", "l_returnflag", "l_partkey"])
    x = li.join(o, li.l_orderkey == o.o_orderkey).withColumn("period", year_quarter("o_orderdate"))
    return E.upload_files(x, ["o_custkey", "period"], "l_orderkey", ["o_orderdate", "l_linenumber", "l_partkey"], "l_returnflag", ["A", "N"], ["l_partkey"])
