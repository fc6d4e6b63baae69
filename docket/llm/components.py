"""Connected components by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docket.llm.common import saved


def _state(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("hi", "lo").cast("decimal(38,0)"))).first())


def components(edges: DataFrame) -> DataFrame:
    """(id, component): the smallest id reachable, for every id of ``edges`` (a, b) but those
    linked with themselves alone.

    Each round links every node's larger neighbours to the smallest one about it, then its
    smaller ones, until all edges lead to a root. Rounds grow with the logarithm of the longest
    path. Minima are combined before the shuffle and joined back from a written table, so that a
    node with very many neighbours is a skewed join that can be split. Nulls and loops are left out.
    """
    e = saved(edges.filter("a IS NOT NULL AND b IS NOT NULL AND a <> b")
              .select(F.greatest("a", "b").alias("hi"), F.least("a", "b").alias("lo")).distinct(), "edges")
    state = _state(e)
    while state[0]:
        both = e.select(F.col("hi").alias("u"), F.col("lo").alias("v")).unionByName(e.select(F.col("lo").alias("u"), F.col("hi").alias("v")))
        low = saved(both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m")), "star")
        large = saved(both.join(low, "u").filter("v > u").select(F.col("v").alias("hi"), F.col("m").alias("lo")).distinct(), "star")
        low = saved(large.groupBy("hi").agg(F.min("lo").alias("m")), "star")
        small = large.join(low, "hi")
        e = saved(small.filter("lo <> m").select(F.col("lo").alias("hi"), F.col("m").alias("lo"))
                  .unionByName(low.select("hi", F.col("m").alias("lo"))).distinct(), "edges")
        last, state = state, _state(e)
        if state == last:
            break
    roots = e.select(F.col("lo").alias("id")).distinct()
    return e.select(F.col("hi").alias("id"), F.col("lo").alias("component")).unionByName(roots.select("id", F.col("id").alias("component")))
