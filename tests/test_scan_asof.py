"""Bucketed keyed scans and the as-of join vs brute force, with a hot key
(a third of all rows) spread over many buckets and deliberate time ties."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from docket.functions.scan import KeyedScan
from docket.operators.events import asof_attribute

BASE = dt.datetime(2024, 1, 1)


def make_log(n=900, seed=7):
    rnd = random.Random(seed)
    rows = []
    for i in range(n):
        key = 0 if i % 3 == 0 else rnd.randint(1, 25)           # key 0 holds a third of the rows
        ts = BASE + dt.timedelta(hours=rnd.randint(0, 24 * 40))  # hour grain -> many exact ties
        rows.append((i, key, ts, rnd.choice(["a", "b"]), round(rnd.uniform(0, 50), 2)))
    return rows


@pytest.fixture(scope="module")
def log(spark):
    rows = make_log()
    return rows, spark.createDataFrame(rows, "id long, k long, ts timestamp_ntz, kind string, v double")


def brute_asof(rows, strict, forward):
    out = {}
    for (i, k, t, kind, _) in rows:
        if kind != "a":
            continue
        cands = [(t2, i2) for (i2, k2, t2, kind2, _) in rows if kind2 == "b" and k2 == k and
                 ((t2 < t if strict else t2 <= t) if not forward else (t2 > t if strict else t2 >= t))]
        best = (min(cands) if forward else max(cands)) if cands else (None, None)
        out[i] = best[1]
    return out


@pytest.mark.parametrize("strict,forward", [(True, False), (False, False), (True, True), (False, True)])
def test_asof_matches_brute_force(log, strict, forward):
    rows, df = log
    ev, an = df.filter("kind = 'a'"), df.filter("kind = 'b'")
    got = asof_attribute(ev, an, ["k"], "ts", "ts", ["id"], ["ts", "id"], strict=strict,
                         direction="forward" if forward else "backward")
    res = {r.id: r.anchor_id for r in got.collect()}
    assert res == brute_asof(rows, strict, forward)


def test_scan_counts_lasts_and_lead(log):
    rows, df = log
    scan = KeyedScan(["k"], ["ts", "id"])
    x = scan.prepare(df)
    x = scan.count_before(x, F.col("kind") == "b", "nb")
    x = scan.last_before(x, F.col("kind") == "b", F.col("v"), "last_b")
    x = scan.next_value(x, F.col("id"), "next_id")
    got = {r.id: (r.nb, r.last_b, r.next_id) for r in scan.finish(x).collect()}
    by_key = {}
    for r in sorted(rows, key=lambda r: (r[1], r[2], r[0])):
        by_key.setdefault(r[1], []).append(r)
    want = {}
    for k, rs in by_key.items():
        nb, last = 0, None
        for j, (i, _, _, kind, v) in enumerate(rs):
            nxt = rs[j + 1][0] if j + 1 < len(rs) else None
            want[i] = (nb, last, nxt)
            if kind == "b":
                nb, last = nb + 1, v
    assert got == want


def test_latest_window_has_partial_group_limit(spark, sf_small):
    from docket.plans import all_queries
    plan = all_queries()["latest_per_key"](spark, sf_small)._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan


def test_hot_key_and_burst_are_split(spark):
    """A key with most rows, most of them at one time: ranges stay even and the answer is the plain window's."""
    df = spark.range(0, 4000).select(F.when(F.col("id") < 3000, 1).otherwise(F.col("id") % 50).alias("k"),
                                     F.when(F.col("id") < 2500, 7).otherwise(F.col("id") % 100).alias("t"), "id")
    scan = KeyedScan(["k"], ["t", "id"])
    x = scan.prepare(df)
    sizes = [r["count"] for r in x.groupBy(scan.bucket_col).count().collect()]
    assert max(sizes) <= 2 * 4000 / int(spark.conf.get("spark.sql.shuffle.partitions"))
    got = {r.id: r.n for r in scan.finish(scan.count_before(x, F.col("id") % 3 == 0, "n")).collect()}
    seen, want = {}, {}
    for r in sorted(df.collect(), key=lambda r: (r.k, r.t, r.id)):
        want[r.id] = seen.get(r.k, 0)
        seen[r.k] = want[r.id] + (r.id % 3 == 0)
    assert got == want


def test_null_keys_and_null_times(spark):
    rows = [(1, None, 5), (2, None, 6), (3, 1, None), (4, 1, 3), (5, 1, 4), (6, None, None)]
    df = spark.createDataFrame(rows, "id int, k int, t int")
    scan = KeyedScan(["k"], ["t", "id"])
    got = {r.id: (r.n, r.last) for r in scan.finish(scan.run(scan.prepare(df), counts={"n": F.lit(True)}, lasts={"last": (F.lit(True), F.col("id"))})).collect()}
    assert got == {6: (0, None), 1: (1, 6), 2: (2, 1), 3: (0, None), 4: (1, 3), 5: (2, 4)}


def test_asof_ignores_anchors_and_events_without_a_time(spark):
    anchors = spark.createDataFrame([("a", None, 1), ("a", 10, 2), ("b", None, 3)], "k string, t int, aid int")
    events = spark.createDataFrame([("a", 5, 1), ("a", 20, 2), ("a", None, 3), ("b", 9, 4)], "k string, t int, eid int")
    for direction, want in (("backward", {1: None, 2: 2, 3: None, 4: None}), ("forward", {1: 2, 2: None, 3: None, 4: None})):
        got = asof_attribute(events, anchors, ["k"], "t", "t", ["eid"], ["aid"], direction=direction)
        assert {r.eid: r.anchor_aid for r in got.collect()} == want


def test_json_payload_pages_hot_group(spark):
    from docket.operators.measures import json_payload
    import json
    df = spark.range(0, 2500).select((F.when(F.col("id") < 2000, 0).otherwise(F.col("id") % 7 + 1)).alias("g"),
                                     (F.col("id") % 1500).alias("m"))  # some members twice
    out = json_payload(df, ["g"], ["m"], "js", page_size=300).collect()
    hot = sorted((r for r in out if r.g == 0), key=lambda r: r.page)
    assert [r.page for r in hot] == list(range(7)) and [r.n_members for r in hot] == [300] * 6 + [200]
    assert [x["m"] for r in hot for x in json.loads(r.js)] == sorted(k % 1500 for k in range(2000))
    assert all(r.page == 0 for r in out if r.g != 0)
