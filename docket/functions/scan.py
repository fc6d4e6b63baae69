"""Keyed, time-ordered scans that survive a hot key.

A window partitioned by the entity key alone sends every row of a key to one task; if one key
holds a third of the data that task holds a third of the data. ``KeyedScan`` range-partitions
the rows by (key, order) and commits them with the number of their range, so that each range
holds an even share of all rows however they are spread over keys and time, a burst within one
second included. Running aggregates then run per (key, range), and state is carried in from a
key's earlier ranges through a summary with one row per (key, range): at most as many as there
are ranges. The result does not depend on where the ranges end. Order columns must be ascending
and give a total order within a key; NULL keys and NULL order values are values like others.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from docket.session import committed


def null_safe_join(left: DataFrame, right: DataFrame, keys: list[str], how: str = "left") -> DataFrame:
    """Join on ``keys`` with NULL matching NULL; the keys appear once, from ``left``."""
    r = right.select(*[F.col(k).alias(f"__r_{k}") if k in keys else F.col(k) for k in right.columns])
    cond = F.lit(True)
    for k in keys:
        cond = cond & F.col(k).eqNullSafe(F.col(f"__r_{k}"))
    return left.join(r, cond, how).drop(*[f"__r_{k}" for k in keys])


ROWS_IN_PARTITION = 250_000


def dealt(df: DataFrame, rows: int, *keys: str) -> DataFrame:
    """``df``, of about so many rows, dealt by ``keys`` into as many partitions as keep each near
    ``ROWS_IN_PARTITION``: what a task holds for a grouping by the keys does not grow with the table."""
    return df.repartition(max(1, -(-rows // ROWS_IN_PARTITION)), *keys)


RANGES_PER_PARTITION = 4


@dataclass
class KeyedScan:
    keys: list[str]
    order: list[str]            # ascending, total within key
    bucket_col: str = "__bkt"

    def prepare(self, df: DataFrame) -> DataFrame:
        """The rows in ranges of (key, order), committed: every later use sees the same ranges."""
        # a few ranges to a partition, so that dealing (key, range) out by hash stays even
        n = RANGES_PER_PARTITION * int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
        ranged = df.repartitionByRange(n, *[F.col(c) for c in [*self.keys, *self.order]])
        return committed(ranged.withColumn(self.bucket_col, F.spark_partition_id()), "scan")

    # -- windows -----------------------------------------------------------
    def _in_bucket(self, lo, hi):
        return (Window.partitionBy(*self.keys, self.bucket_col)
                .orderBy(*self.order).rowsBetween(lo, hi))

    def _across(self, lo, hi):
        return Window.partitionBy(*self.keys).orderBy(self.bucket_col).rowsBetween(lo, hi)

    # -- operations --------------------------------------------------------
    def run(self, df: DataFrame, counts: dict | None = None, lasts: dict | None = None,
            firsts: dict | None = None, inclusive: bool = False) -> DataFrame:
        """All scan outputs of one keyed log in one pass.

        ``counts``: name -> condition: number of earlier rows meeting it.
        ``lasts``: name -> (condition, value): value of the latest earlier row meeting it.
        ``firsts``: name -> (condition, value): value of the earliest later row meeting it.
        ``inclusive`` lets a row see itself. One window over (key, bucket), one
        per-range summary, one small carry window per
        key over its ranges and one join back.
        """
        counts, lasts, firsts = counts or {}, lasts or {}, firsts or {}
        if self.bucket_col not in df.columns:
            df = self.prepare(df)
        before = self._in_bucket(Window.unboundedPreceding, Window.currentRow if inclusive else -1)
        after = self._in_bucket(Window.currentRow if inclusive else 1, Window.unboundedFollowing)
        order_struct = F.struct(*[F.col(c) for c in self.order])
        loc, summ, carry, finals = [], [], [], []
        across_before = self._across(Window.unboundedPreceding, -1)
        across_after = self._across(1, Window.unboundedFollowing)
        for n, cond in counts.items():
            flag = F.when(cond, 1).otherwise(0)
            loc.append(F.coalesce(F.sum(flag).over(before), F.lit(0)).alias(f"__l_{n}"))
            summ.append(F.sum(flag).alias(f"__s_{n}"))
            carry.append(F.coalesce(F.sum(f"__s_{n}").over(across_before), F.lit(0)).alias(f"__c_{n}"))
            finals.append((F.col(f"__l_{n}") + F.col(f"__c_{n}")).cast("long").alias(n))
        for n, (cond, value) in lasts.items():
            v = F.struct(value.alias("v"))
            loc.append(F.last(F.when(cond, v), ignorenulls=True).over(before).alias(f"__l_{n}"))
            summ.append(F.max_by(v, F.when(cond, order_struct)).alias(f"__s_{n}"))
            carry.append(F.last(f"__s_{n}", ignorenulls=True).over(across_before).alias(f"__c_{n}"))
            finals.append(F.coalesce(F.col(f"__l_{n}"), F.col(f"__c_{n}")).getField("v").alias(n))
        for n, (cond, value) in firsts.items():
            v = F.struct(value.alias("v"))
            loc.append(F.first(F.when(cond, v), ignorenulls=True).over(after).alias(f"__l_{n}"))
            summ.append(F.min_by(v, F.when(cond, order_struct)).alias(f"__s_{n}"))
            carry.append(F.first(f"__s_{n}", ignorenulls=True).over(across_after).alias(f"__c_{n}"))
            finals.append(F.coalesce(F.col(f"__l_{n}"), F.col(f"__c_{n}")).getField("v").alias(n))
        kb = [*self.keys, self.bucket_col]
        x = df.select("*", *loc)
        c = df.groupBy(*kb).agg(*summ).select(*kb, *carry)
        out = null_safe_join(x, c, kb)
        tmp = [f"__l_{n}" for n in [*counts, *lasts, *firsts]] + [f"__c_{n}" for n in [*counts, *lasts, *firsts]]
        return out.select(*[F.col(k) for k in df.columns], *finals).drop(*[t for t in tmp if t in out.columns])

    def last_before(self, df: DataFrame, source: Column, value: Column, out: str,
                    inclusive: bool = False) -> DataFrame:
        """``out`` = ``value`` of the most recent earlier row (within key) where ``source``."""
        return self.run(df, lasts={out: (source, value)}, inclusive=inclusive)

    def first_after(self, df: DataFrame, source: Column, value: Column, out: str,
                    inclusive: bool = False) -> DataFrame:
        """``out`` = ``value`` of the earliest later row (within key) where ``source``."""
        return self.run(df, firsts={out: (source, value)}, inclusive=inclusive)

    def count_before(self, df: DataFrame, cond: Column, out: str, inclusive: bool = False) -> DataFrame:
        """``out`` = number of earlier rows (within key) satisfying ``cond``."""
        return self.run(df, counts={out: cond}, inclusive=inclusive)

    def next_value(self, df: DataFrame, value: Column, out: str) -> DataFrame:
        """``out`` = ``value`` of the next row within key (NULL for the last row): LEAD."""
        return self.first_after(df, F.lit(True), value, out)

    def prev_value(self, df: DataFrame, value: Column, out: str) -> DataFrame:
        """``out`` = ``value`` of the previous row within key: LAG."""
        return self.last_before(df, F.lit(True), value, out)

    def finish(self, df: DataFrame) -> DataFrame:
        return df.drop(self.bucket_col)
