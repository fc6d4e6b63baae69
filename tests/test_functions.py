"""Semantic traps T1, T2-T4, T6, T12 and the text/time helpers."""

import datetime as dt


from docket.functions.periods import canonical_period, period_year
from docket.functions.text import ci, key_equals, scrub_placeholders
from docket.functions.times import parse_event_time
from docket.sources.control import split_processed


def test_ci_ignores_case_and_trailing_blanks(spark):
    df = spark.createDataFrame([("Accepted  ", "accepted"), (" x", "x")], "a string, b string")
    assert [r.eq for r in df.select((ci("a") == ci("b")).alias("eq")).collect()] == [True, False]


def test_null_key_policies(spark):
    df = spark.createDataFrame([(None, ""), (None, None), ("a", "a")], "a string, b string")
    got = df.select(key_equals("a", "b", "match").alias("m"), key_equals("a", "b", "distinct").alias("d"),
                    key_equals("a", "b", "safe").alias("s")).collect()
    assert [(r.m, r.d, r.s) for r in got] == [(True, None, False), (True, None, True), (True, True, True)]


def test_scrub_placeholders(spark):
    df = spark.createDataFrame([("  N/A ",), ("",), ("-",), (" none",), ("x ",), (None,)], "v string")
    assert [r.c for r in df.select(scrub_placeholders("v").alias("c")).collect()] == [None, None, None, None, "x", None]


def test_period_year_and_label(spark):
    df = spark.createDataFrame([("January to June 2024",), ("Jan to Jun 24",), ("Jul to Dec 23 ",), ("garbage",),
                                ("July to December 2025",)], "p string")
    got = df.select(period_year("p").alias("y"), canonical_period("p").alias("c")).collect()
    assert [r.y for r in got] == [2024, 2024, 2023, None, 2025]
    assert [r.c for r in got] == ["January to June 2024", "January to June 2024", "July to December 2023", None,
                                  "July to December 2025"]


def test_parse_event_time_modes(spark):
    df = spark.createDataFrame([("2024-03-01T10:11:12.3456789Z",), ("2024-03-01T10:11:12.345+01:00",), ("nope",)],
                               "t string")
    got = df.select(parse_event_time("t", "millis").alias("m"), parse_event_time("t", "utc").alias("u")).collect()
    assert got[0].m == dt.datetime(2024, 3, 1, 10, 11, 12, 345000)
    assert got[1].u == dt.datetime(2024, 3, 1, 9, 11, 12, 345000)
    assert got[2].m is None and got[2].u is None


def test_split_processed_not_in_trap(spark):
    files = spark.createDataFrame([(1,), (2,), (3,)], "k long")
    errors = spark.createDataFrame([(2,), (None,)], "k long")
    got = {(r.k, r.processed) for r in split_processed(files, errors, ["k"]).collect()}
    assert got == {(1, True), (2, False), (3, True)}  # NOT IN would have returned nothing
