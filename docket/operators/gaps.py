"""Expected-but-missing reports (O-35, O-37 .. O-39)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def expected_grid(entities: DataFrame, key: str, periods: Sequence, period_col: str,
                  facts: DataFrame, mandated: Sequence | None = None) -> DataFrame:
    """Entity x period grid with fact counts so gaps show (O-35).

    The grid is an explode of the fixed period list per entity (no join
    operator); facts are pre-aggregated per (key, period) before the left join.
    Per-entity totals use a window over the grid, whose partitions hold at most
    ``len(periods)`` rows, so no key can be hot there.
    ``mandated``: periods that must all be present for ``all_present``.
    """
    grid = entities.select(key).distinct().withColumn(period_col, F.explode(F.array(*[F.lit(p) for p in periods])))
    cnt = facts.groupBy(key, period_col).agg(F.count(F.lit(1)).alias("n_facts"))
    g = grid.join(cnt, [key, period_col], "left").withColumn("n_facts", F.coalesce("n_facts", F.lit(0)))
    g = g.withColumn("present", F.col("n_facts") > 0)
    must = list(mandated if mandated is not None else periods)
    w = Window.partitionBy(key)
    g = g.withColumn("n_present", F.sum(F.col("present").cast("int")).over(w))
    g = g.withColumn("all_present", F.sum(F.when(F.col(period_col).isin(must) & F.col("present"), 1)
                                          .otherwise(0)).over(w) == len(must))
    return g


def unmatched(left: DataFrame, right: DataFrame, keys: Sequence[str] | Column,
              where: Column | None = None) -> DataFrame:
    """Rows of ``left`` with no partner in ``right`` (NOT EXISTS, O-37)."""
    if where is not None:
        right = right.filter(where)
    on = list(keys) if not isinstance(keys, Column) else keys
    return left.join(right, on, "left_anti")


def matched(left: DataFrame, right: DataFrame, keys: Sequence[str] | Column) -> DataFrame:
    """Rows of ``left`` with a partner in ``right`` (EXISTS)."""
    on = list(keys) if not isinstance(keys, Column) else keys
    return left.join(right, on, "left_semi")


def repeat_submitters(df: DataFrame, key: str, file_col: str, more_than: int = 1) -> DataFrame:
    """Keys with more than ``more_than`` distinct files (O-39); exact distinct count."""
    return (df.groupBy(key).agg(F.count_distinct(file_col).alias("n_files"))
              .filter(F.col("n_files") > more_than))


def error_report(rows: DataFrame, direct: Sequence[tuple[str, Column, Column, Column]],
                 expected: tuple[Column, Column, Column], found: tuple[Column, Column, Column]) -> DataFrame:
    """Typed errors (error_type, entity_key, period), distinct, in one pass over joined rows (O-38).

    ``direct``: (type, condition, entity, periods): an error for each period of a row that meets
    it. ``expected`` and ``found``: (condition, entity, periods) on both sides of the period
    check: an entity's period on the expected side only is ``expected_period_missing``, on the
    found side only ``unexpected_period``. Each row is exploded into its entries, and one
    aggregation settles all kinds.
    """
    sides = [("expected", *expected), ("found", *found)]
    entries = []
    for flag, cond, entity, periods in [*direct, *sides]:
        space = F.lit("period" if flag in ("expected", "found") else flag)
        entries.append(F.when(cond, F.struct(space.alias("space"), F.lit(flag).alias("flag"),
                                             entity.cast("string").alias("entity_key"), periods.alias("periods"))))
    x = rows.select(F.inline(F.filter(F.array(*entries), lambda e: e.isNotNull())))
    x = x.select("space", "flag", "entity_key", F.explode("periods").alias("p")).withColumn("period", F.col("p").cast("int"))
    has = {f: F.max((F.col("flag") == f).cast("int")) for f in ("expected", "found")}
    agg = x.groupBy("space", "entity_key", "period").agg(has["expected"].alias("e"), has["found"].alias("f"))
    kind = (F.when(F.col("space") != "period", F.col("space"))
            .when(F.col("f") == 0, F.lit("expected_period_missing")).when(F.col("e") == 0, F.lit("unexpected_period")))
    return agg.select(kind.alias("error_type"), "entity_key", "period").filter(F.col("error_type").isNotNull())
