"""Serving extracts (O-58, O-59, O-65 .. O-68)."""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from docket.session import committed
from docket.functions.text import ci


def text_filters(col: str, contains: str | None = None, all_words: Sequence[str] | None = None,
                 any_of: Sequence[str] | None = None) -> list[Column]:
    """Optional filters built only from the arguments given (case-insensitive, T1).

    ``contains``: substring; ``all_words``: every word present; ``any_of``: exact
    values. User text is matched literally (no wildcard injection).
    """
    out = []
    if contains:
        out.append(F.contains(ci(col), F.lit(contains.lower().rstrip())))
    if all_words:
        for w in all_words:
            out.append(F.contains(ci(col), F.lit(w.lower())))
    if any_of:
        out.append(ci(col).isin([v.lower().rstrip() for v in any_of]))
    return out


def apply_overrides(spark: SparkSession, df: DataFrame, key: str, status_col: str,
                    overrides_json: str | None, key_type: str = "bigint") -> DataFrame:
    """Apply JSON decision overrides ``[{"key": k, "status": s}, ...]`` before the
    status filter; one override per key (the last one given wins)."""
    if not overrides_json:
        return df
    schema = T.ArrayType(T.StructType([T.StructField("key", T.StringType()),
                                       T.StructField("status", T.StringType())]))
    ov = (spark.createDataFrame([(overrides_json,)], "j string")
          .select(F.posexplode(F.from_json("j", schema)).alias("pos", "o"))
          .select(F.col("o.key").cast(key_type).alias("__ok"), F.col("o.status").alias("__os"), "pos"))
    ov = ov.groupBy("__ok").agg(F.max_by("__os", "pos").alias("__os"))
    x = df.join(ov, F.col(key) == F.col("__ok"), "left")
    return x.withColumn(status_col, F.coalesce(F.col("__os"), F.col(status_col))).drop("__ok", "__os")


TOP_ROWS = 2_000  # up to here a page comes from a top-k; deeper ones from even ranges of the order


def filter_page(spark: SparkSession, df: DataFrame, key: str, status_col: str,
                status_rank: Mapping[str, int], order: Sequence[Column], page: int, size: int,
                filters: Sequence[Column] = (), statuses: Sequence[str] | None = None,
                overrides_json: str | None = None, exact_first: Column | None = None) -> DataFrame:
    """Filter, override, status-ranked stable order, clamped page (O-58).

    ``exact_first``: rows that meet it (the searched name or reference matched exactly) come
    before the others; within both, status rank, then ``order``, then ``key``. The total is one
    aggregate (a single number to the driver). A page near the top is a top-k. A deeper one
    is found by seeking: the filtered rows are committed in even ranges of the page's order, the
    rows of each range counted, and only the ranges that the page lies in are sorted, so no task
    ever holds all rows before it. The rows are the same either way. A page past the end is
    clamped to the last page. Adds ``total_count``.
    """
    x = df
    for f in filters:
        x = x.filter(f)
    x = apply_overrides(spark, x, key, status_col, overrides_json)
    if statuses is not None:
        x = x.filter(F.col(status_col).isin(list(statuses)))
    pairs = [v for kv in status_rank.items() for v in (F.lit(kv[0]), F.lit(kv[1]))]
    rank = F.coalesce(F.try_element_at(F.create_map(*pairs), F.col(status_col)), F.lit(len(status_rank) + 1))
    x = x.withColumn("status_rank", rank.cast("int"))
    by = [F.col("status_rank"), *order, F.col(key)]
    if exact_first is not None:
        by.insert(0, F.when(exact_first, 0).otherwise(1))
    total = x.count()
    page = min(max(1, page), max(1, math.ceil(total / size)))
    skip = (page - 1) * size
    if skip + size > TOP_ROWS:
        n = int(spark.conf.get("spark.sql.shuffle.partitions"))
        ranged = committed(x.repartitionByRange(n, *by).withColumn("__part", F.spark_partition_id()), "pages")
        held = dict(ranged.groupBy("__part").count().collect())  # one row per range
        wanted, before, first = [], 0, None
        for part in sorted(held):
            if before < skip + size and before + held[part] > skip:
                wanted.append(part)
                first = before if first is None else first
            before += held[part]
        x, skip = ranged.filter(F.col("__part").isin(wanted)).drop("__part"), skip - (first or 0)
    out = x.orderBy(*by).offset(skip).limit(size)
    return out.withColumn("total_count", F.lit(total).cast("long")).withColumn("page", F.lit(page))


def delta_extract(branches: Sequence[tuple[str, DataFrame]], distinct: bool = False) -> DataFrame:
    """Change feed: labelled branches, UNION ALL or UNION distinct (T7) (O-59)."""
    out = None
    for label, df in branches:
        d = df.withColumn("change_type", F.lit(label))
        out = d if out is None else out.unionByName(d)
    return out.distinct() if distinct else out


def delta_refresh(all_rows: DataFrame, touched: DataFrame, key: str) -> DataFrame:
    """Refresh variant: every row of any key touched in the window (semi join)."""
    return all_rows.join(touched.select(key).distinct(), key, "left_semi")


def public_register(df: DataFrame, keys: Sequence[str], order: Sequence[str], file_col: str,
                    status_col: str, accepted: str, cancelled: str, ref_prefix: str) -> DataFrame:
    """Latest file per key; a cancelled latest row carries the latest accepted
    file's reference (O-65). One aggregation, two max_by picks."""
    ordering = F.struct(*[F.col(c) for c in order])
    agg = df.groupBy(*keys).agg(
        F.max_by(F.struct(F.col(file_col).alias("f"), F.col(status_col).alias("s")), ordering).alias("__l"),
        F.max_by(F.col(file_col), F.when(F.col(status_col) == accepted, ordering)).alias("__acc"))
    ref = F.when(F.col("__l.s") == cancelled, F.col("__acc")).otherwise(F.col("__l.f"))
    return agg.select(*keys, F.col("__l.f").alias("latest_file"), F.col("__l.s").alias("latest_status"),
                      F.when(ref.isNotNull(), F.concat_ws("", F.lit(ref_prefix),
                                                         *[F.col(k).cast("string") for k in keys[:1]],
                                                         F.lit("-"), ref.cast("string"))).alias("register_ref"))


def file_label(parts: Sequence[Column], sep: str = " - ") -> Column:
    """Composed selectable label (CONCAT_WS skips NULL parts)."""
    return F.concat_ws(sep, *parts)


def landing_pairs(org: DataFrame, data: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Pair the org file with the data file of the same keys (e.g. entity, year):
    full outer, each side one row per key."""
    return org.join(data, list(keys), "full_outer")


def names_filter(col: str, names: Sequence[str], mode: str = "any") -> Column:
    """Several organisation-name fragments (S6): ``any`` = match one of them,
    ``all`` = match every one. Case-insensitive substring, matched literally."""
    conds = [F.contains(ci(col), F.lit(n.lower().rstrip())) for n in names]
    if not conds:
        return F.lit(True)
    out = conds[0]
    for c in conds[1:]:
        out = (out | c) if mode == "any" else (out & c)
    if mode not in ("any", "all"):
        raise ValueError(mode)
    return out
