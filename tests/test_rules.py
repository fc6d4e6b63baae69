"""Rule compositions on named inputs."""

from pyspark.sql import functions as F

from docket.operators import rules


def test_member_late_fee_rules_in_order(spark):
    cols = "name string, size string, resubmitted int, joiner boolean, resub_late boolean, sub_late boolean, latest int, first int, submitted int, joined int"
    rows = [  # cutoffs: large 50, small 80
        ("resubmitted, new joiner", "L", 9, True, True, False, 1, 1, 1, None, True),
        ("resubmitted, others", "L", 9, False, True, False, 60, 60, 60, 1, False),
        ("latest on time", "L ", None, False, False, True, 49, 60, 70, 1, False),
        ("first late", "S", None, False, False, False, 90, 80, 80, None, True),
        ("joined later, dated", "L", None, False, False, False, 60, 10, 70, 5, True),
        ("joined later, undated", "L", None, False, False, True, 60, 10, 70, None, False),
        ("member in time", "S", None, False, False, True, 90, 20, 20, None, False),
        ("dates missing", "L", None, False, False, True, None, None, None, None, False),
        ("no size", None, None, False, False, True, 90, 20, 20, None, True),
    ]
    df = spark.createDataFrame([r[:-1] for r in rows], cols)
    c = F.col
    fee = rules.member_late_fee(c("size"), F.lit(50), F.lit(80), c("resubmitted"), c("joiner"), c("resub_late"), c("sub_late"), c("latest"),
                                c("first"), c("submitted"), c("joined"))
    assert {r.name: r.fee for r in df.select("name", fee.alias("fee")).collect()} == {r[0]: r[-1] for r in rows}


def test_journey_cutoffs(spark):
    df = spark.createDataFrame([("CsoLargeProducer", "S", True, 50), ("DirectSmallProducer", "L", False, 80), (None, "L", False, 50), (None, "S", True, 80),
                                (None, None, True, 50), ("Other", None, False, None)], "j string, s string, scheme boolean, want int")
    got = df.select("want", rules.journey_cutoff(F.col("j"), F.col("s"), F.col("scheme"), F.lit(50), F.lit(80)).alias("got")).collect()
    assert all(r.got == r.want for r in got)


def test_scheme_totals_count_an_organisation_once(spark):
    members = spark.createDataFrame([("s", "a"), ("s", "b"), ("t", "a"), ("s", "a")], "sc string, m string")
    edges = spark.createDataFrame([("a", "x"), ("b", "x"), ("a", "b"), ("z", "y")], "p string, c string")
    amounts = spark.createDataFrame([("s", 1.0), ("a", 10.0), ("b", 100.0), ("x", 1000.0), ("y", 9.0), ("a", 10.0)], "o string, v double")
    got = {r.scheme_id: (r.total, r.n_orgs) for r in rules.scheme_totals(members, "sc", "m", edges, "p", "c", amounts, "o", "v").collect()}
    assert got == {"s": (1121.0, 4), "t": (1120.0, 4)}


def test_next_year_population_matches_null_keys(spark):
    files = spark.createDataFrame([(1, None, 2023, 1, "ok", 1), (1, None, 2023, 2, "no", 2), (2, "c", 2023, 2, "ok", 3)],
                                  "org int, sub string, year int, h int, st string, id int")
    obligations = spark.createDataFrame([(1, None, 2024), (2, "c", 2024), (2, None, 2024), (1, None, 2023)], "org int, sub string, year int")
    got = rules.next_year_population(obligations, files, ["org", "sub"], "year", F.col("h"), F.col("st") == "ok", ["id"]).collect()
    assert {(r.org, r["sub"], r.year): (r.has_h1, r.has_h2) for r in got} == {
        (1, None, 2024): (True, False), (2, "c", 2024): (False, True), (2, None, 2024): (False, False), (1, None, 2023): (False, False)}


def test_flags(spark):
    df = spark.createDataFrame([(True, True, "L", 1.0), (True, True, None, 1.0), (True, True, "S", 60_000.0), (False, False, "S", 50_000.0), (False, True, "L", 1.0)],
                               "liable boolean, hh boolean, size string, w double")
    got = df.select(rules.liability_flag(F.col("liable"), F.col("hh"), F.col("size")), rules.small_producer_flag(F.col("w"), F.col("size"))).collect()
    assert [tuple(r) for r in got] == [("Compliant", "N/A"), ("Compliant", "N/A"), ("Non Compliant", "Non Compliant"), ("Compliant", "Compliant"), ("Non Compliant", "N/A")]
