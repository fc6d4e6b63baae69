"""Rows in one global order, spread over even ranges.

Ranges follow the data's size, not a setting, so that a task's share stays the same at any input
and a key that holds a third of the rows is spread over a third of the ranges.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from docket.llm.common import saved

RANGE_BYTES = 64 << 20
PART_BITS = 33  # monotonically_increasing_id: the partition above, the row within it below


def ranges_for(rows: DataFrame, size: Column | None = None, each: int = 64) -> int:
    """Ranges of about ``RANGE_BYTES`` for rows of ``each`` bytes and what ``size`` adds."""
    total = rows.agg(F.sum(F.lit(each) + (F.coalesce(size, F.lit(0)) if size is not None else 0)).cast("long")).first()[0]
    return max(1, -(-(total or 0) // RANGE_BYTES))


def sorted_ranges(rows: DataFrame, ranges: int, *order: str) -> DataFrame:
    """``rows`` in ranges of ``order``, sorted in each, with their place ``at``: ascending over the
    whole table, its upper bits the range."""
    return rows.repartitionByRange(ranges, *order).sortWithinPartitions(*order).withColumn("at", F.monotonically_increasing_id())


def part(at: Column) -> Column:
    return F.shiftright(at, PART_BITS)


def places(rows: DataFrame, group: str, *order: str, each: int = 200) -> DataFrame:
    """``rows`` with ``pos`` (place in the group, from 0) and ``n`` (rows of the group).

    ``group`` must not be null. Within a range a group's rows are consecutive, so a row's place is
    its distance from the group's first row there plus the rows in earlier ranges; the window
    runs over one row per (group, range).
    """
    own = saved(sorted_ranges(rows, ranges_for(rows.select(group), each=each), group, *order), "ordered")
    runs = own.groupBy(group, part(F.col("at")).alias("part")).agg(F.min("at").alias("first"), F.count(F.lit(1)).alias("k"))
    across = Window.partitionBy(group)
    before = F.coalesce(F.sum("k").over(across.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    runs = runs.select(F.col(group).alias("run_group"), "part", (before - F.col("first")).alias("shift"), F.sum("k").over(across).alias("n"))
    return own.join(runs, (F.col(group) == F.col("run_group")) & (part(F.col("at")) == F.col("part"))).select(
        *rows.columns, (F.col("at") + F.col("shift")).alias("pos"), "n")
