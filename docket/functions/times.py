"""Text timestamps -> TIMESTAMP_NTZ (O-07)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(col) -> Column:
    return F.col(col) if isinstance(col, str) else col


def parse_event_time(col, mode: str = "millis") -> Column:
    """Parse an ISO text timestamp.

    ``millis``: keep the first 23 characters (to the millisecond) and parse;
    ``utc``: honour a trailing offset/Z and convert to UTC wall time;
    ``lenient``: like ``millis`` but NULL instead of an error on bad text.
    All modes use ``try_to_timestamp`` so bad text yields NULL, never a failure.
    """
    s = F.trim(_c(col))
    if mode in ("millis", "lenient"):
        head = F.substring(F.regexp_replace(s, "T", " "), 1, 23)
        return F.try_to_timestamp(head, F.lit("yyyy-MM-dd HH:mm:ss[.SSS][.SS][.S]")).cast("timestamp_ntz")
    if mode == "utc":
        ts = F.try_to_timestamp(s, F.lit("yyyy-MM-dd'T'HH:mm:ss[.SSSSSSS][.SSSSSS][.SSS]XXX"))
        # instant -> its UTC wall time, from microseconds: no session time zone, so no gap in it, takes part
        micros, day = F.unix_micros(ts), F.lit(86_400_000_000)
        days = F.floor(micros / day)
        rest = (micros - days * day).cast("decimal(18,6)") / F.lit(1_000_000)
        return F.lit("1970-01-01 00:00:00").cast("timestamp_ntz") + F.make_dt_interval(days.cast("int"), F.lit(0), F.lit(0), rest.cast("decimal(18,6)"))
    raise ValueError(mode)


def in_years(col, first: int, last: int | None = None) -> Column:
    """``first <= year(col) <= last`` written as a range on the raw column, so
    Parquet min/max statistics can skip row groups (``year(col) = y`` cannot)."""
    last = first if last is None else last
    c = _c(col)
    lo = F.lit(f"{first:04d}-01-01 00:00:00").cast("timestamp_ntz")
    hi = F.lit(f"{last + 1:04d}-01-01 00:00:00").cast("timestamp_ntz")
    return (c >= lo) & (c < hi)
