"""Resume after failure, backups, snapshots and stream replay."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from docket.plans import materialise as P
from docket.sources import TABLE_SCHEMAS, read_table
from docket.sources.snapshots import SnapshotTable
from docket.streaming.event_state import stream_latest_state


def test_materialise_resumes_after_failure(spark, scratch):
    calls = []

    def s1(ctx):
        calls.append("s1")
        return ctx.spark.range(10)

    def s2_fail(ctx):
        raise RuntimeError("boom")

    def s2(ctx):
        calls.append("s2")
        return ctx.read("s1").filter("id % 2 = 0")

    with pytest.raises(RuntimeError):
        P.materialise(spark, scratch, [P.Step("s1", s1), P.Step("s2", s2_fail)], run_id="r1")
    P.materialise(spark, scratch, [P.Step("s1", s1), P.Step("s2", s2)], run_id="r1")
    assert calls == ["s1", "s2"]                                      # s1 not recomputed
    audit = {(r.step, r.status): r.rows for r in P.read_audit(spark, scratch, "r1").collect()}
    assert audit[("s1", "done")] == 10 and audit[("s2", "done")] == 5 and ("s2", "failed") in audit


def test_snapshot_versions_and_backup(spark, scratch, sf_small):
    tbl = SnapshotTable(spark, f"{scratch}/t")
    assert tbl.read() is None
    tbl.commit(spark.range(3))
    tbl.commit(spark.range(5))
    assert tbl.versions() == [1, 2] and tbl.read().count() == 5 and tbl.read(1).count() == 3
    path = P.backup_snapshot(read_table(spark, sf_small, "nation"), scratch, "nation", dt.datetime(2024, 1, 31))
    assert path.endswith("nation_backup_20240131_1706659200")


def test_stream_replay_in_two_arrivals_equals_batch(spark, scratch, sf_small):
    ev = read_table(spark, sf_small, "events")
    cut = F.lit("2024-01-15 00:00:00").cast("timestamp_ntz")
    late = ev.filter(F.col("ts") < cut)               # older events arrive after newer ones
    early = ev.filter(F.col("ts") >= cut)
    early.repartition(3).write.parquet(f"{scratch}/in/part1")
    args = (TABLE_SCHEMAS["events"], ["user_id", "event_type"], ["ts", "event_id"], ["value"],
            f"{scratch}/state", f"{scratch}/ckpt")
    stream_latest_state(spark, f"{scratch}/in/*", *args, max_files_per_trigger=1)
    late.repartition(2).write.parquet(f"{scratch}/in/part2")     # late arrivals, older event times included
    state = stream_latest_state(spark, f"{scratch}/in/*", *args, max_files_per_trigger=1)
    cols = ["user_id", "event_type", "ts", "event_id", "value"]
    got = sorted(tuple(r) for r in state.read().select(*cols).collect())
    from docket.operators.latest import latest_per_key
    want = sorted(tuple(r) for r in latest_per_key(ev, ["user_id", "event_type"],
                                                   [F.col("ts").desc(), F.col("event_id").desc()]).select(*cols).collect())
    assert got == want
    state.compact()                                              # fold changes into a snapshot
    assert sorted(tuple(r) for r in state.read().select(*cols).collect()) == want
    state.write_changes(ev.limit(0).select("user_id", "event_type", "ts", "event_id", "value"), 10**6)
    assert sorted(tuple(r) for r in state.read().select(*cols).collect()) == want
    # replaying a batch id overwrites its own folder: applying the same change twice changes nothing
    first = spark.read.parquet(f"{scratch}/state/changes").filter("batch_id = 0").drop("batch_id")
    replay = spark.createDataFrame(first.collect(), first.schema)   # a replay arrives from the source, not the folder
    state.write_changes(replay, 0)
    assert sorted(tuple(r) for r in state.read().select(*cols).collect()) == want


def test_keep_schema_commit(spark, scratch):
    tbl = SnapshotTable(spark, f"{scratch}/k")
    tbl.commit(spark.createDataFrame([(1, "a")], "id long, v string"))
    tbl.commit(spark.createDataFrame([("x", 2, "b")], "extra string, id int, v string"), keep_schema=True)
    df = tbl.read()
    assert df.columns == ["id", "v"] and dict(df.dtypes)["id"] == "bigint" and df.collect()[0].v == "b"


def test_compaction_is_one_commit_and_expires_folded_changes(spark, scratch):
    from docket.streaming.event_state import LatestState
    state = LatestState(spark, f"{scratch}/c", ["k"], ["t", "v"])
    batch = lambda *rows: spark.createDataFrame(rows, "k int, t int, v string")
    for i, row in enumerate([(1, 1, "a"), (2, 1, "b"), (1, 2, "c"), (1, 1, "late")]):
        state.write_changes(batch(row), i)
        if i:
            state.compact()
    assert sorted(map(tuple, state.read().select("k", "t", "v").collect())) == [(1, 2, "c"), (2, 1, "b")]
    left = {r.batch_id for r in spark.read.parquet(f"{scratch}/c/changes").select("batch_id").collect()}
    assert left == {3}  # what the snapshot before already held is gone
    v = state.snapshots.current_version()
    assert state.compact() == v  # nothing new


def test_second_refresh_audits_what_it_did(spark, sf_small):
    from docket.plans import materialise as P
    from docket.plans.rebind_pipeline import two_refreshes
    root, run = two_refreshes(spark, sf_small)
    rows = {r.step: r.rows for r in P.read_audit(spark, root, run).collect()}
    from docket.plans.rebind_pipeline import _version
    one, two = ({r.o_orderkey: r.o_orderstatus for r in _version(spark, sf_small, v).collect()} for v in (1, 2))
    assert set(two) == {r.o_orderkey for r in read_table(spark, sf_small, "orders").collect()}  # the whole table
    assert two.keys() - one.keys() and one.keys() - two.keys()
    want = {"inserted": len(two.keys() - one.keys()), "deleted": len(one.keys() - two.keys()),
            "updated": sum(one[k] != two[k] for k in one.keys() & two.keys()), "unchanged": sum(one[k] == two[k] for k in one.keys() & two.keys())}
    assert {a: rows.get(f"details:{a}", 0) for a in want} == want
    assert rows["details"] == rows["summaries"] == rows["file_status"] == len(two)
    assert [s for s in ("purged", "details", "counts", "organisations", "parameters", "file_status", "events", "reference_events", "summaries") if s not in rows] == []
