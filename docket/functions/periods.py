"""Period labels: year, canonical label, ordinal (O-06, trap T12)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _c(col) -> Column:
    return F.col(col) if isinstance(col, str) else col


def period_year(label) -> Column:
    """Last four characters as a year, else 2000 + last two; NULL when neither parses."""
    s = F.rtrim(_c(label))
    four = F.right(s, F.lit(4))
    two = F.right(s, F.lit(2))
    y4 = F.when(four.rlike("^[0-9]{4}$"), four.cast("int"))
    y2 = F.when(two.rlike("^[0-9]{2}$"), two.cast("int") + 2000)
    return F.coalesce(y4, y2)


# Month abbreviations expanded in period labels.
MONTH_WORDS = [("Jan", "January"), ("Jun", "June"), ("Dec", "December"),
               ("Mar", "March"), ("Apr", "April"), ("Jul", "July")]


def canonical_period(label) -> Column:
    """'Jan to Jun 24' -> 'January to June 2024': expand month words, 4-digit year.

    The year is the trailing digit token; years below 2000 get +2000.
    """
    s = F.trim(_c(label))
    year_tok = F.regexp_extract(s, r"([0-9]+)$", 1)
    head = F.rtrim(F.regexp_replace(s, r"[0-9]+$", ""))
    for short, full in MONTH_WORDS:
        head = F.regexp_replace(head, rf"\b{short}\b", full)
    year = year_tok.cast("int")
    year = F.when(year < 2000, year + 2000).otherwise(year)
    return F.when(s.isNull() | (s == "") | (year_tok == ""), F.lit(None).cast("string")) \
        .otherwise(F.concat_ws(" ", head, year.cast("string")))


def normalise_period(df: DataFrame, col: str, base_year: int, shift: Column | None = None) -> DataFrame:
    """Add canonical label, label year, ordinal and reporting year (0 when the label is no
    half-year), and the shifted relevant year.

    The ordinal is a formula, for any year: 2 * (year - base_year) + 1 for January to June, + 2
    for July to December (so years before ``base_year`` count backwards).
    """
    out = df.withColumn("canonical_period", canonical_period(col)) \
            .withColumn("period_year", period_year(col))
    c = F.col("canonical_period")
    half = F.when(c.rlike("^January to June [0-9]{4}$"), 1).when(c.rlike("^July to December [0-9]{4}$"), 2)
    year = F.right(c, F.lit(4)).try_cast("int")
    out = out.withColumn("period_ordinal", F.coalesce(2 * (year - base_year) + half, F.lit(0)).cast("int")) \
             .withColumn("reporting_year", F.when(half.isNotNull(), year).otherwise(0).cast("int"))
    if shift is not None:
        out = out.withColumn("relevant_year", F.col("period_year") + shift)
    return out


def year_quarter(col) -> Column:
    """Quarter of a date as one number, 19983 for the third of 1998."""
    return (F.year(_c(col)) * 10 + F.quarter(_c(col))).cast("int")


def year_quarters(df: DataFrame, col: str) -> list[int]:
    """All quarters from the first to the last year of a column (two numbers come to the driver)."""
    first, last = df.agg(F.min(F.year(col)), F.max(F.year(col))).first()
    return [] if first is None else [y * 10 + q for y in range(first, last + 1) for q in (1, 2, 3, 4)]
