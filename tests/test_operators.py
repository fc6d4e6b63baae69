"""Fixtures for state, diff, dedupe, upsert and gaps operators."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from docket.operators import conform as C
from docket.operators import diff as D
from docket.operators import events as E
from docket.operators import upsert as U
from docket.operators.latest import first_and_latest, latest_with_fallback

T0 = dt.datetime(2025, 1, 1)


def t(h):
    return T0 + dt.timedelta(hours=h)


def fold(spark, rows):
    df = spark.createDataFrame(rows, "sub string, id long, ts timestamp_ntz, type string, dec string")
    out = E.event_state(df, "sub", "ts", "id", "type", "submit", "decision", "resubmit", F.col("dec"))
    return {r.sub: r for r in out.collect()}


def test_event_state_transitions(spark):
    rows = [
        ("pending", 1, t(1), "submit", None),
        ("granted", 2, t(1), "submit", None), ("granted", 3, t(2), "decision", "Accepted"),
        ("again", 4, t(1), "submit", None), ("again", 5, t(2), "decision", "Accepted"), ("again", 6, t(3), "submit", None),
        ("refused_then_granted", 7, t(1), "submit", None), ("refused_then_granted", 8, t(2), "decision", "Rejected"),
        ("refused_then_granted", 9, t(3), "decision", "Accepted"),
        ("decision_first", 10, t(1), "decision", "Rejected"),
        ("resub", 11, t(1), "submit", None), ("resub", 12, t(2), "decision", "Accepted"),
        ("resub", 13, t(3), "resubmit", None),
        ("resub_decided", 14, t(1), "submit", None), ("resub_decided", 15, t(2), "resubmit", None),
        ("resub_decided", 16, t(3), "decision", "Rejected"),
    ]
    s = fold(spark, rows)
    assert s["pending"].status == "Pending" and s["pending"].resubmission_status is None
    assert s["granted"].status == "Granted" and s["granted"].first_granted_ts == t(2)
    assert s["again"].status == "Pending"                      # newer submission after the decision
    assert s["refused_then_granted"].status == "Granted" and s["refused_then_granted"].n_decisions == 2
    assert s["decision_first"].status == "Refused"             # decision before any upload
    assert s["resub"].resubmission_status == "Pending"
    assert s["resub_decided"].resubmission_status == "Refused"


def test_file_status_cancel_propagates_and_siblings_inherit(spark):
    df = spark.createDataFrame([
        (1, 1, "A", t(1), False, False), (1, 2, None, t(2), False, True),      # sibling inherits Accepted
        (2, 1, "A", t(1), False, False), (2, 2, None, t(2), True, False),      # one cancel cancels all
        (3, 1, None, t(1), False, True), (3, 2, None, t(1), False, False),     # undecided
    ], "sub long, f long, d string, at timestamp_ntz, cancel boolean, pend boolean")
    dec = F.when(F.col("d") == "A", F.lit("Accepted"))
    out = E.file_decision_status(df, "sub", dec, "at", F.col("cancel"), F.col("pend"), F.lit(2025), 2026)
    got = {(r.sub, r.f): r.status for r in out.collect()}
    assert got == {(1, 1): "Accepted", (1, 2): "Accepted", (2, 1): "Cancelled", (2, 2): "Cancelled",
                   (3, 1): "Pending", (3, 2): "Uploaded"}


def test_diff_null_keys_and_antisymmetry(spark):
    a = spark.createDataFrame([(None, 1.0), ("x", 2.0), ("y", 5.0)], "k string, v double")
    b = spark.createDataFrame([("", 3.0), ("x", 2.0), ("z", 1.0)], "k string, v double")
    m = {"v": F.sum("v")}
    match = {r.k: (r.v_diff, r.change_class) for r in D.diff_measures(a, b, ["k"], m, "match").collect()}
    assert match == {"": (2.0, "changed"), "x": (0.0, "unchanged"), "y": (-5.0, "removed"), "z": (1.0, "added")}
    distinct = D.diff_measures(a, b, ["k"], m, "distinct").collect()
    assert len(distinct) == 5                                   # NULL never matches ''
    ab = {r.k: r.v_diff for r in D.diff_measures(a, b, ["k"], m).collect()}
    ba = {r.k: r.v_diff for r in D.diff_measures(b, a, ["k"], m).collect()}
    assert ab == {k: -v for k, v in ba.items()}


def test_membership_change_swaps(spark):
    a = spark.createDataFrame([(1, "small"), (2, "large"), (3, "small")], "k long, tier string")
    b = spark.createDataFrame([(1, "large"), (2, "small"), (4, "small")], "k long, tier string")
    r = {"small": 1, "large": 2}
    ab = {x.k: x.change for x in D.membership_change(a, b, "k", "tier", r).collect()}
    ba = {x.k: x.change for x in D.membership_change(b, a, "k", "tier", r).collect()}
    assert ab == {1: "size increased", 2: "size decreased", 3: "removed", 4: "added"}
    assert ba == {1: "size decreased", 2: "size increased", 3: "added", 4: "removed"}


def test_dedupe_idempotent_exact_copies_keep_one(spark):
    df = spark.createDataFrame([(1, None, t(1), "a"), (1, None, t(1), "a"), (1, None, t(2), "b"), (2, 5, t(1), "c")],
                               "id long, sub long, ts timestamp_ntz, x string")
    once = C.dedupe_latest(df, ["id", "sub"], ["ts"])
    twice = C.dedupe_latest(once, ["id", "sub"], ["ts"])
    assert sorted(once.collect()) == sorted(twice.collect())
    assert {(r.id, r.x) for r in once.collect()} == {(1, "b"), (2, "c")}


def test_purge_ambiguous_never_adds_rows(spark):
    df = spark.createDataFrame([(1, 1), (1, 1), (1, 2), (2, 1), (3, 1)], "id long, line long")
    out = C.purge_ambiguous(df, ["id", "line"], "id")
    assert sorted(tuple(r) for r in out.collect()) == [(2, 1), (3, 1)]


def test_upsert_full_sync_semantics(spark):
    tgt = spark.createDataFrame([(1, "a"), (2, "b"), (3, "c")], "k long, v string")
    src = spark.createDataFrame([(2, "B"), (3, "c"), (4, "d")], "k long, v string")
    res, counts = U.upsert_full_sync(tgt, src, ["k"], delete_missing=True)
    assert sorted(res.collect()) == sorted(src.collect())
    assert {r.action: r.rows for r in counts.collect()} == {"deleted": 1, "updated": 1, "unchanged": 1, "inserted": 1}
    keep, _ = U.upsert_full_sync(tgt, src, ["k"], delete_missing=False)
    assert sorted(tuple(r) for r in keep.collect()) == [(1, "a"), (2, "B"), (3, "c"), (4, "d")]
    again, _ = U.upsert_full_sync(keep, src, ["k"], delete_missing=False)
    assert sorted(again.collect()) == sorted(keep.collect())       # idempotent
    dup = spark.createDataFrame([(1, "x"), (1, "y")], "k long, v string")
    with pytest.raises(U.DuplicateKeyError):
        U.upsert_full_sync(tgt, dup, ["k"])


def test_upsert_common_columns_keeps_target_only(spark):
    tgt = spark.createDataFrame([(1, "a", 10.0)], "k long, v string, extra double")
    src = spark.createDataFrame([(1, "A", "s"), (2, "b", "s")], "k long, v string, only_src string")
    res, _ = U.upsert_common_columns(tgt, src, ["k"])
    assert res.columns == ["k", "v", "extra"]
    assert sorted(tuple(r) for r in res.collect()) == [(1, "A", 10.0), (2, "b", None)]


def test_first_and_latest_prefers_class(spark):
    df = spark.createDataFrame([(1, "O", t(1), 10), (1, "F", t(3), 11), (1, "F", t(2), 12), (2, "P", t(1), 20),
                                (2, "P", t(5), 21)], "k long, s string, ts timestamp_ntz, f long")
    got = {r.k: r for r in first_and_latest(df, ["k"], "s", ["F", "O", "P"], ["ts"], ["f"]).collect()}
    assert (got[1].chosen_class, got[1].first_f, got[1].latest_f) == ("F", 12, 11)
    assert (got[2].chosen_class, got[2].first_f, got[2].latest_f) == ("P", 20, 21)


def test_latest_with_fallback_accepted_nulls_win(spark):
    df = spark.createDataFrame([(1, True, t(1), None), (1, False, t(2), "new"), (2, False, t(1), "x")],
                               "k long, acc boolean, ts timestamp_ntz, v string")
    got = {r.k: (r.v, r.source) for r in latest_with_fallback(df, ["k"], F.col("acc"), ["ts"], ["v"]).collect()}
    assert got == {1: (None, "accepted"), 2: ("x", "submitted")}


def test_submission_first_latest_rules(spark):
    from docket.operators.latest import submission_first_latest
    rows = [
        ("A", t(1), 1, "Pending", False), ("A", t(2), 2, "Queried", False), ("A", t(3), 3, "Granted", False),
        ("B", t(1), 1, "QUERIED", False), ("B", t(2), 2, "queried ", False),
        ("C", t(1), 1, "Rejected", False), ("C", t(2), 2, "REJECTED", False),
        ("D", t(1), 1, None, False), ("D", t(2), 2, "Rejected", True),
        ("E", t(1), 1, "Pending", False), ("E", t(3), 3, "Rejected", True), ("E", t(2), 2, "Approved", True),
    ]
    df = spark.createDataFrame(rows, "k string, ts timestamp_ntz, f long, s string, r boolean")
    got = {x.k: (x.first_file, x.first_status, x.latest_file, x.latest_status)
           for x in submission_first_latest(df, ["k"], "ts", "f", "s", F.col("r")).collect()}
    assert got["A"] == (1, "PENDING", 3, "GRANTED")       # stale query dropped
    assert got["B"] == (2, "QUERIED", 2, "QUERIED")       # consecutive queries collapse to the last
    assert got["C"] == (2, "REJECTED", None, None)        # first falls back to the latest rejection
    assert got["D"] == (1, "PENDING", 2, "REJECTED")      # rejected resubmission counts when no other resub
    assert got["E"] == (1, "PENDING", 2, "APPROVED")      # ...but not when a pending/accepted resub exists


def test_registration_state_same_file_rule(spark):
    rows = []
    for sub, rd_file in (("s", "F1"), ("r", "F2")):
        rows += [(sub, 1, t(1), "up", "F1", None, False), (sub, 2, t(2), "app", None, None, False),
                 (sub, 3, t(3), "dec", None, "Accepted", False), (sub, 4, t(4), "up", "F2", None, False),
                 (sub, 5, t(5), "app", None, None, True), (sub, 6, t(6), "dec", rd_file, "Accepted", False),
                 (sub, 6, t(0), "dec", rd_file, "Rejected", False)]       # older copy of event 6
    rows += [("p", 1, t(1), "app", None, None, False)]
    df = spark.createDataFrame(rows, "k string, id long, ts timestamp_ntz, ty string, f string, d string, rs boolean")
    out = {r.k: r for r in E.registration_state(df, "k", "ts", "id", "ty", "f", "d", F.col("rs"),
                                                "up", "app", "dec").collect()}
    assert out["s"].first_application_file == "F1" and out["s"].resubmission_file == "F2"
    assert out["s"].status == "Pending"                 # an application is newer than the decision
    assert out["s"].latest_decision == "Granted" and out["s"].granted_time == t(3)
    assert out["s"].resubmission_status == "Pending"    # decision was on another file
    assert out["r"].resubmission_status == "Accepted"   # decision on the resubmitted file, newest copy
    assert out["p"].first_application_file is None and out["p"].status == "Pending"


def test_names_filter_modes(spark):
    from docket.operators.serve import names_filter
    df = spark.createDataFrame([("Acme Widgets Ltd",), ("acme ltd",), ("Widgets Co",)], "n string")
    anyn = [r.n for r in df.filter(names_filter("n", ["ACME", "widgets"], "any")).collect()]
    alln = [r.n for r in df.filter(names_filter("n", ["ACME", "widgets"], "all")).collect()]
    assert sorted(anyn) == ["Acme Widgets Ltd", "Widgets Co", "acme ltd"] and alln == ["Acme Widgets Ltd"]


def test_drill_down_resolves_one_breakdown(spark):
    rows = spark.createDataFrame([("a", 1), ("b", 2)], "d string, v long")
    bd = [("x", F.col("v") > 1, F.col("d")), ("y", F.lit(True), F.col("d")), ("y", F.lit(True), F.col("d"))]
    assert [r.d for r in D.drill_down(rows, bd, "x").collect()] == ["b"]
    with pytest.raises(KeyError):
        D.drill_down(rows, bd, "y")


def test_pages_cover_filtered_rows_exactly_once(spark):
    from docket.operators.serve import filter_page
    df = spark.createDataFrame([(i, ["O", "F", "P"][i % 3], t(i % 5)) for i in range(47)],
                               "k long, s string, ts timestamp_ntz")
    seen = []
    for page in range(1, 5):
        rows = filter_page(spark, df, "k", "s", {"O": 1, "F": 2}, [F.col("ts").desc()], page, 10,
                           statuses=["O", "F"]).collect()
        assert all(r.total_count == 32 for r in rows)
        seen += [r.k for r in rows]
    assert sorted(seen) == sorted(i for i in range(47) if i % 3 != 2)
    clamped = filter_page(spark, df, "k", "s", {"O": 1, "F": 2}, [F.col("ts").desc()], 99, 10,
                          statuses=["O", "F"]).collect()
    assert [r.k for r in clamped] == seen[30:] and clamped[0].page == 4


def test_full_sync_with_empty_source(spark):
    tgt = spark.createDataFrame([(1, "a"), (2, "b")], "k long, v string")
    empty = tgt.limit(0)
    res, counts = U.upsert_full_sync(tgt, empty, ["k"], delete_missing=True)
    assert res.count() == 0 and {r.action: r.rows for r in counts.collect()} == {"deleted": 2}
    keep, _ = U.upsert_full_sync(tgt, empty, ["k"], delete_missing=False)
    assert sorted(tuple(r) for r in keep.collect()) == [(1, "a"), (2, "b")]


def test_obligation_lines_parent_total_and_first_line_credit(spark):
    from docket.operators.measures import obligation_lines
    edges = spark.createDataFrame([("P", "A"), ("P", "B"), ("Q", "C")], "parent string, child string")
    amounts = spark.createDataFrame([("P", 5.0), ("A", 3.0), ("B", 2.0), ("C", 1.0)], "org string, amount double")
    credits = spark.createDataFrame([("P", 4.0)], "org string, credit double")
    got = {(r.parent_id, r.org_id): (r.line_type, r.obligation, r.credit, r.remaining)
           for r in obligation_lines(edges, "parent", "child", amounts, "org", "amount", credits, "credit").collect()}
    assert got == {("P", "P"): ("parent", 10.0, 4.0, 6.0), ("P", "A"): ("child", 0.0, 0.0, 0.0),
                   ("P", "B"): ("child", 0.0, 0.0, 0.0), ("Q", "Q"): ("parent", 1.0, 0.0, 1.0),
                   ("Q", "C"): ("child", 0.0, 0.0, 0.0)}
