"""Measure how a hot key is spread over tasks, from Spark's event log.

Derives a skewed log from the events table (replicated, with one user
holding a third of all rows) and compares, per plan, the largest task's share
of the shuffle records read by the stage that feeds the key-ordered work:

* naive   : window partitioned by user only (running count)
* scan    : the KeyedScan over even ranges (same running count)
* latest  : latest_per_key (partial WindowGroupLimit before the shuffle)

usage: python tools/skew_check.py [--sf DIR] [--copies N]
"""

from __future__ import annotations

import argparse
import glob
import json
import os
import sys
import tempfile

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def main():
    ap = argparse.ArgumentParser()
    ap.add_argument("--sf", default="/root/testdata/sf0.1")
    ap.add_argument("--copies", type=int, default=20)
    a = ap.parse_args()
    logdir = tempfile.mkdtemp(prefix="docket-eventlog-")
    from pyspark.sql import Window
    from pyspark.sql import functions as F

    from docket.functions.scan import KeyedScan
    from docket.operators.latest import latest_per_key
    from docket.session import build_session
    from docket.sources import read_table
    spark = build_session(master="local[8]", shuffle_partitions=64, app="docket-skew",
                          extra={"spark.eventLog.enabled": "true", "spark.eventLog.dir": logdir, "spark.eventLog.compress": "false",
                                 "spark.sql.adaptive.coalescePartitions.enabled": "false"})
    ev = read_table(spark, a.sf, "events", ["event_id", "user_id", "ts", "event_type"])
    big = (ev.withColumn("copy", F.explode(F.sequence(F.lit(0), F.lit(a.copies - 1)).cast("array<long>"))).select(
        (F.col("event_id") * a.copies + F.col("copy")).alias("event_id"),
        F.when(F.pmod(F.col("event_id") * a.copies + F.col("copy"), F.lit(3)) == 0, F.lit(0))
         .otherwise(F.col("user_id") + 1).alias("user_id"),
        "ts", "event_type"))
    jobs = {}

    def run(name, df):
        spark.sparkContext.setJobGroup(name, name)
        df.write.format("noop").mode("overwrite").save()
        jobs[name] = True

    w = Window.partitionBy("user_id").orderBy("ts", "event_id").rowsBetween(Window.unboundedPreceding, -1)
    run("naive", big.withColumn("n_before", F.count(F.when(F.col("event_type") == "error", 1)).over(w)))
    scan = KeyedScan(["user_id"], ["ts", "event_id"])
    run("scan", scan.finish(scan.run(scan.prepare(big), counts={"n_before": F.col("event_type") == "error"})))
    run("latest", latest_per_key(big, ["user_id"], [F.col("ts").desc(), F.col("event_id").desc()]))
    spark.stop()

    # parse the event log: job group -> stages -> per-task shuffle records read
    stage_group, tasks = {}, {}
    for path in glob.glob(os.path.join(logdir, "**", "*"), recursive=True):
        if os.path.isdir(path) or os.path.basename(path).startswith("appstatus"):
            continue
        with open(path) as f:
            for line in f:
                e = json.loads(line)
                ev_name = e.get("Event")
                if ev_name == "SparkListenerJobStart":
                    g = (e.get("Properties") or {}).get("spark.jobGroup.id")
                    for sid in e.get("Stage IDs", []):
                        stage_group[sid] = g
                elif ev_name == "SparkListenerTaskEnd":
                    m = e.get("Task Metrics") or {}
                    rd = (m.get("Shuffle Read Metrics") or {}).get("Total Records Read", 0)
                    if rd:
                        tasks.setdefault(e["Stage ID"], []).append(rd)
    out = {}
    for sid, recs in tasks.items():
        g = stage_group.get(sid)
        if g is None:
            continue
        share = max(recs) / sum(recs)
        best = out.get(g)
        if best is None or sum(recs) > best["records"]:
            out[g] = {"stage": sid, "tasks": len(recs), "records": sum(recs), "max_task_share": round(share, 3)}
    print(json.dumps({"rows": "events x %d, one user = 1/3" % a.copies, "event_log": logdir, "stages": out},
                     indent=1))


if __name__ == "__main__":
    main()
