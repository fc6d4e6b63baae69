"""Inputs the test tables lack: NULL keys, NULL sizes, mixed case, several schemes, a DST gap, odd years."""

import pytest
from pyspark.sql import functions as F

from docket.functions.periods import normalise_period
from docket.functions.text import scrub_placeholders
from docket.functions.times import parse_event_time
from docket.operators import conform, diff, events, latest, upsert


def test_prior_stats_and_latest_flag_keep_null_keys(spark):
    df = spark.createDataFrame([(1, None, 1, "p"), (2, None, 2, "p"), (3, 7, 1, "x")], "id int, k int, t int, s string")
    got = events.prior_stats(df, ["k"], ["t", "id"], {"n": F.lit(True)}, {}, pending=F.col("s") == "p").collect()
    assert {r.id: r.n for r in got} == {2: 1, 3: 0}  # the older pending row goes, the newest stays
    got = latest.latest_flag(df, ["k"], F.col("t")).collect()
    assert {r.id: r.is_latest for r in got} == {1: False, 2: True, 3: True}


def test_year_on_year_does_not_fan_out(spark):
    y1 = spark.createDataFrame([("A", 1), ("A", 2), ("B", 3), (None, 4)], "scheme string, m int")
    y2 = spark.createDataFrame([("B", 1, 5, "x"), ("C", 1, 9, "y"), ("A", 2, 1, "z"), ("D", 9, 1, "w"), (None, 4, 1, "v")], "scheme string, m int, t int, a string")
    got = {(r.scheme, r.m, r.status, r.moved_to, r.moved_a) for r in diff.year_on_year(y1, y2, "scheme", "m", newest=["t"], carry=["a"]).collect()}
    assert got == {("A", 1, "Leaver", "C", "y"), ("A", 2, "No change", None, None), ("B", 3, "Leaver", None, None), ("B", 1, "Joiner", None, None),
                   ("C", 1, "Joiner", None, None), ("D", 9, "Joiner", None, None), (None, 4, "No change", None, None)}


def test_membership_change_with_missing_sizes(spark):
    a = spark.createDataFrame([(1, None), (2, None), (3, "L"), (4, "S"), (5, "L"), (6, None)], "m int, size string")
    b = spark.createDataFrame([(1, "L"), (2, "S"), (3, None), (4, "L"), (7, None), (6, None)], "m int, size string")
    got = {r.m: r.change for r in diff.membership_change(a, b, "m", "size", {"S": 1, "L": 2}).collect()}
    assert got == {1: "size increased", 2: "size decreased", 3: "size removed", 4: "size increased", 5: "removed", 6: "no change", 7: "added"}


def test_cross_validate_with_missing_totals(spark):
    d = spark.createDataFrame([(1, None), (2, 10.0), (3, 10.0)], "k int, d double")
    r = spark.createDataFrame([(1, 5.0), (2, None), (4, 1.0)], "k int, r double")
    got = {x.k: x.status for x in diff.cross_validate(d, r, "k", "d", "r", 0.1).collect()}
    assert got == {1: "mismatch", 2: "mismatch", 3: "declared_only", 4: "reported_only"}


def test_diff_columns_takes_null_and_empty_for_one(spark):
    a = spark.createDataFrame([(1, None, "x", "")], "k int, p string, q string, r string")
    b = spark.createDataFrame([(1, "", None, "y")], "k int, p string, q string, r string")
    got = {x.column_name: x.change for x in diff.diff_columns_long(a, b, ["k"], ["p", "q", "r"], {}).collect()}
    assert got == {"p": "No Change", "q": "Removed", "r": "Added"}


def test_codes_and_decisions_in_any_case(spark):
    df = spark.createDataFrame([("LA ",), ("la",), ("xx",)], "c string")
    codes = [("La", "size", "Large")]
    assert [r.c_text for r in conform.decode_codes(df, codes, {"c": "size"}).collect()] == ["Large", "Large", None]
    table = spark.createDataFrame(codes, "code string, type string, text string")
    assert sorted(str(r.c_text) for r in conform.decode_codes_table(df, table, {"c": "size"}).collect()) == ["Large", "Large", "None"]
    ev = spark.createDataFrame([(1, 1, 1, "sub", None), (1, 2, 2, "dec", "accepted "), (2, 1, 3, "sub", None), (2, 2, 4, "dec", "REJECTED")],
                               "k int, t int, id int, ty string, d string")
    got = events.event_state(ev, "k", "t", "id", "ty", "sub", "dec", "res", F.col("d")).collect()
    assert {r.k: r.status for r in got} == {1: "Granted", 2: "Refused"}


def test_utc_times_in_a_dst_gap(spark):
    zone = spark.conf.get("spark.sql.session.timeZone")
    try:
        for z in ("Europe/London", "UTC", "America/New_York"):
            spark.conf.set("spark.sql.session.timeZone", z)
            df = spark.createDataFrame([("2024-03-31T01:30:00Z",), ("2024-03-10T02:30:00.125Z",), ("1960-01-01T00:00:00+02:00",), ("bad",)], "s string")
            got = [str(r[0]) for r in df.select(parse_event_time("s", "utc").cast("string")).collect()]
            assert got == ["2024-03-31 01:30:00", "2024-03-10 02:30:00.125", "1959-12-31 22:00:00", "None"]
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)


def test_periods_and_deadlines_of_any_year(spark):
    df = spark.createDataFrame([("Jan to Jun 50",), ("July to December 2002",), ("January to March 2024",), (None,)], "p string")
    got = [(r.canonical_period, r.period_ordinal, r.reporting_year) for r in normalise_period(df, "p", 2000).collect()]
    assert got == [("January to June 2050", 101, 2050), ("July to December 2002", 6, 2002), ("January to March 2024", 0, 0), (None, 0, 0)]
    df = spark.sql("SELECT 1 k, 'large' s, DATE'1990-05-01' t UNION ALL SELECT 2, 'large', DATE'2050-05-01' UNION ALL SELECT 3, 'small', DATE'2050-04-01'")
    got = {r.k: (str(r.deadline), r.is_late) for r in events.deadline_flags(df, ["k"], "t", F.col("s"), 1998).collect()}
    assert got == {1: ("1990-04-02", True), 2: ("2049-10-02", True), 3: ("2050-04-02", False)}


def test_placeholders(spark):
    df = spark.createDataFrame([("not set",), (" n/a ",), ("-",), ("Null",), (" x ",)], "c string")
    assert [r[0] for r in df.select(scrub_placeholders("c")).collect()] == [None, None, None, "Null", "x"]
    assert df.select(scrub_placeholders("c", extra=("null",)).alias("c")).filter("c IS NULL").count() == 4


def test_upserts_check_columns_and_keys(spark):
    t = spark.createDataFrame([(1, "a", "keep"), (2, "b", "keep")], "k int, v string, own string")
    s = spark.createDataFrame([(1, "z"), (3, "c")], "k int, v string")
    with pytest.raises(ValueError, match="own"):
        upsert.upsert_full_sync(t, s, ["k"])
    with pytest.raises(upsert.DuplicateKeyError):
        upsert.upsert_common_columns(t.union(t), s, ["k"])
    got, _ = upsert.upsert_common_columns(t, s, ["k"])
    assert sorted(map(tuple, got.collect())) == [(1, "z", "keep"), (2, "b", "keep"), (3, "c", None)]


def test_deep_pages_are_those_of_a_full_sort(spark, monkeypatch):
    from docket.operators import serve
    df = spark.range(0, 500).select("id", F.when(F.col("id") % 3 == 0, "O").when(F.col("id") % 3 == 1, "F").alias("s"), (F.col("id") % 11).alias("t"))
    args = ("id", "s", {"O": 1, "F": 2}, [F.col("t").desc()])
    for page in (1, 4, 30, 50, 99):
        seen = []
        for top in (10_000, 0):
            monkeypatch.setattr(serve, "TOP_ROWS", top)
            got = serve.filter_page(spark, df, *args, page=page, size=10, exact_first=F.col("id") == 77).collect()
            seen.append([(r.id, r.page, r.total_count) for r in got])
        assert seen[0] == seen[1] and len(seen[0]) == 10
    assert seen[0][0][1] == 50  # clamped


def test_codes_that_differ_in_case_are_one(spark):
    from docket.operators.conform import decode_codes, decode_codes_table
    codes = [("HH", "size", "Household"), ("hh ", "size", "A household"), ("L", "size", "Large"), ("L", "size", "Large"), (None, "size", "none")]
    df = spark.createDataFrame([(1, "Hh"), (2, "l"), (3, None), (4, "x")], "id int, s string")
    want = [(1, "A household"), (2, "Large"), (3, None), (4, None)]
    table = spark.createDataFrame(codes, "code string, type string, text string")
    for out in (decode_codes(df, codes, {"s": "size"}), decode_codes_table(df, table, {"s": "size"})):
        assert sorted((r.id, r.s_text) for r in out.collect()) == want


def test_rows_under_a_repeated_null_key_are_purged(spark):
    from docket.operators.conform import purge_ambiguous
    df = spark.createDataFrame([(1, None), (2, None), (3, "a"), (None, "b"), (None, "b"), (4, "b2")], "id int, key string")
    assert sorted(r.id for r in purge_ambiguous(df, ["key"], "id").collect()) == [3, 4]
