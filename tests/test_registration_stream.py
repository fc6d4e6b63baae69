"""The registration fold kept by a stream: equal to the batch fold whatever the order of arrival."""

import datetime as dt
import random

from pyspark.sql import functions as F

from docket.operators.events import registration_state
from docket.streaming.registration import FoldedLog, stream_fold

LOG = "k string, id long, t timestamp_ntz, ty string, f string, d string, rs boolean"


def fold(df):
    return registration_state(df, "k", "t", "id", "ty", "f", "d", F.col("rs"), "up", "app", "dec")


def a_log(rng):
    """Events of a hot key, some others and a NULL key; NULL times; newer copies that say something else."""
    keys, rows = ["hot"] * 6 + ["a", "b", "c", None], []
    for i in range(120):
        ty = rng.choice(["up", "app", "app", "dec", "other"])
        for copy in range(rng.choice((1, 1, 2))):
            at = None if rng.random() < 0.05 else dt.datetime(2024, 1, 1, 0, rng.randrange(40)) + dt.timedelta(days=copy)
            f = f"F{rng.randrange(4)}" if ty == "up" or (ty == "dec" and rng.random() < 0.5) else None
            rows.append((keys[i % 10], i, at, ty, f, rng.choice(("Accepted", "Rejected", None)), ty == "app" and rng.random() < 0.4))
    return rows


def as_set(df):
    return sorted(map(str, df.collect()))


def test_any_order_of_arrival_equals_the_batch_fold(spark, scratch):
    rng = random.Random(8)
    rows = a_log(rng)
    frame = spark.createDataFrame(rows, LOG)
    want = as_set(fold(frame))
    log = FoldedLog(spark, f"{scratch}/log", frame.schema, ["k"], ["id"], fold, buckets=4)
    sent = rows + rng.sample(rows, 25)
    rng.shuffle(sent)
    cuts = [sent[:70], sent[70:75], [], sent[75:]]
    for i, part in enumerate(cuts):
        log.apply(spark.createDataFrame(part, LOG), i)
        if i == 1:
            assert as_set(log.read()) == as_set(fold(spark.createDataFrame(sent[:75], LOG)))
            assert log.compact() == 0
    assert as_set(log.read()) == want
    log.apply(spark.createDataFrame(cuts[3], LOG), 3)     # replayed after a lost commit
    assert as_set(log.read()) == want
    assert log.compact() == 2
    log.apply(spark.createDataFrame(cuts[3], LOG), 3)     # and once more after compaction
    log.apply(spark.createDataFrame(cuts[0], LOG), 4)     # a producer that sends old events again
    assert as_set(log.read()) == want and as_set(fold(log.events())) == want


def test_a_batch_rewrites_its_buckets_only(spark, scratch):
    frame = spark.createDataFrame([(f"k{i}", i, dt.datetime(2024, 1, 1), "app", None, None, False) for i in range(200)], LOG)
    log = FoldedLog(spark, f"{scratch}/log", frame.schema, ["k"], ["id"], fold, buckets=16)
    log.apply(frame, 0)
    before = log.state.manifest(1)
    log.apply(spark.createDataFrame([("k7", 500, dt.datetime(2024, 2, 1), "app", None, None, True)], LOG), 1)
    after = log.state.manifest(2)
    assert len(before) == 16 and sum(before[b].folder != after[b].folder for b in before) == 1
    got = {r.k: r for r in log.read().collect()}
    assert len(got) == 200 and got["k7"].resubmission_time == dt.datetime(2024, 2, 1) and got["k7"].resubmission_status == "Pending"


def test_stream_restarts_where_it_stopped(spark, scratch):
    rows = a_log(random.Random(3))
    frame = spark.createDataFrame(rows, LOG)
    log = FoldedLog(spark, f"{scratch}/log", frame.schema, ["k"], ["id"], fold, buckets=4)
    spark.createDataFrame(rows[90:], LOG).coalesce(1).write.parquet(f"{scratch}/in/one")   # the newest part first
    run = lambda: stream_fold(f"{scratch}/in/*", frame.schema, lambda df: df, log, f"{scratch}/ckpt", 1)
    run()
    spark.createDataFrame(rows[:90], LOG).coalesce(1).write.parquet(f"{scratch}/in/two")
    run()
    assert as_set(log.read()) == as_set(fold(frame))
    assert {r[0] for r in spark.read.parquet(f"{scratch}/log/log").select("__batch").distinct().collect()} == {0, 1}


def test_late_and_coalesced_items(spark):
    d = lambda n: dt.datetime(2024, 1, n)
    cols = LOG + ", who string, note string"
    rows = [("s", 1, d(1), "up", "F1", None, False, "p0", None), ("s", 2, d(2), "app", None, None, False, "p1", "n1"),
            ("s", 3, d(3), "dec", None, "Accepted", False, "r1", "ok"), ("s", 4, d(4), "up", "F2", None, False, "p0", None),
            ("s", 5, d(5), "app", None, None, True, None, "n2"), ("s", 6, d(6), "dec", "F2", "Queried", False, "r2", None),
            ("p", 1, d(2), "app", None, None, False, "p9", None)]
    cut = spark.createDataFrame([("s", d(3)), ("p", d(2))], "k string, cutoff timestamp_ntz")
    out = {r.k: r for r in registration_state(spark.createDataFrame(rows, cols), "k", "t", "id", "ty", "f", "d", F.col("rs"),
                                              "up", "app", "dec", user="who", comment="note", cutoffs=cut).collect()}
    s, p = out["s"], out["p"]
    assert (s.current_file, s.producer_user, s.regulator_user) == ("F2", "p1", "r2")          # a NULL user falls to the application's
    assert (s.application_comment, s.resubmission_comment, s.regulator_comment) == ("n1", "n2", "ok")
    assert (s.late, s.resubmission_late) == (False, True)
    assert (p.late, p.resubmission_late, p.current_file, p.regulator_user) == (True, False, None, None)
