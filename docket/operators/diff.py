"""Comparison of two versions (O-51 .. O-57)."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def diff_measures(a: DataFrame, b: DataFrame, keys: Sequence[str], measures: Mapping[str, Column],
                  null_keys: str = "match", key_kinds: Mapping[str, str] | None = None) -> DataFrame:
    """Full outer diff of two versions on many nullable keys (O-51).

    Each side is first aggregated to unique keys, so the join cannot fan out.
    ``null_keys``: ``match`` unifies NULL with ''/0 (T2, the member diff);
    ``distinct`` keeps NULL keys apart so they never match (T3, the drill).
    Output: keys, ``<m>_1``, ``<m>_2``, ``<m>_diff`` (NULL counts as 0) and
    ``change_class`` in added / removed / changed / unchanged.
    """
    kinds = dict(key_kinds or {})

    def prep(df):
        if null_keys == "match":
            for k in keys:
                zero = F.lit("") if kinds.get(k, "string") == "string" else F.lit(0)
                df = df.withColumn(k, F.coalesce(F.col(k), zero))
        elif null_keys != "distinct":
            raise ValueError(null_keys)
        return df.groupBy(*keys).agg(*[m.alias(n) for n, m in measures.items()])

    a1 = prep(a).select(*[F.col(k).alias(f"__a_{k}") for k in keys],
                        *[F.col(n).alias(f"{n}_1") for n in measures], F.lit(True).alias("__in_a"))
    b1 = prep(b).select(*[F.col(k).alias(f"__b_{k}") for k in keys],
                        *[F.col(n).alias(f"{n}_2") for n in measures], F.lit(True).alias("__in_b"))
    cond = None
    for k in keys:
        c = F.col(f"__a_{k}") == F.col(f"__b_{k}")
        cond = c if cond is None else cond & c
    x = a1.join(b1, cond, "full_outer")
    cols = [F.coalesce(F.col(f"__a_{k}"), F.col(f"__b_{k}")).alias(k) for k in keys]
    for n in measures:
        cols += [F.col(f"{n}_1"), F.col(f"{n}_2"),
                 (F.coalesce(F.col(f"{n}_2"), F.lit(0)) - F.coalesce(F.col(f"{n}_1"), F.lit(0))).alias(f"{n}_diff")]
    same = None
    for n in measures:
        s = F.col(f"{n}_1").eqNullSafe(F.col(f"{n}_2"))
        same = s if same is None else same & s
    klass = (F.when(F.col("__in_a").isNull(), F.lit("added"))
             .when(F.col("__in_b").isNull(), F.lit("removed"))
             .when(same, F.lit("unchanged")).otherwise(F.lit("changed")))
    return x.select(*cols, klass.alias("change_class"))


def _dim(dim: Column | Sequence[Column]) -> Column:
    if isinstance(dim, Column):
        return dim.cast("string")
    # slashes within a value are marked, so that different values never read alike
    return F.concat_ws(" / ", *[F.regexp_replace(F.coalesce(c.cast("string"), F.lit("")), r"([\\/])", r"\\$1") for c in dim])


def diff_breakdowns(rows: DataFrame, breakdowns: Sequence[tuple[str, Column, Column | Sequence[Column]]],
                    v1: Column, v2: Column, scaffold: DataFrame | None = None,
                    kind: str = "percentage", upper: float = 10.0, lower: float = -10.0) -> DataFrame:
    """Many breakdown reports of a two-version diff in one pass (O-52).

    ``breakdowns``: (name, predicate, group column or columns; several are shown
    joined by `` / ``, NULL as empty). Each row is
    exploded into one (breakdown, dim_value) entry per breakdown whose predicate
    holds — a bounded fan-out — and everything is aggregated once.
    ``scaffold`` (breakdown, dim_value) adds zero rows for combinations with no
    data. Change: percentage = 0 when either side sums to 0 (and for equal
    sides), else (s2-s1)/s1*100; value = s2-s1. ``arrow`` = up / down / flat
    against the ``upper``/``lower`` limits (the reference declares and ignores
    them).
    """
    entries = F.array(*[F.when(pred, F.struct(F.lit(name).alias("breakdown"),
                                              _dim(dim).alias("dim_value")))
                        for name, pred, dim in breakdowns])
    x = rows.select(F.explode(F.filter(entries, lambda e: e.isNotNull())).alias("__e"),
                    F.coalesce(v1, F.lit(0.0)).alias("__v1"), F.coalesce(v2, F.lit(0.0)).alias("__v2"))
    agg = x.groupBy(F.col("__e.breakdown").alias("breakdown"), F.col("__e.dim_value").alias("dim_value")) \
           .agg(F.sum("__v1").alias("s1"), F.sum("__v2").alias("s2"))
    if scaffold is not None:
        agg = scaffold.select("breakdown", F.col("dim_value").cast("string")).distinct() \
                      .join(agg, ["breakdown", "dim_value"], "left")
    agg = agg.withColumn("s1", F.round(F.coalesce("s1", F.lit(0.0)), 2)) \
             .withColumn("s2", F.round(F.coalesce("s2", F.lit(0.0)), 2))
    pct = F.when((F.col("s1") == 0) | (F.col("s2") == 0) | (F.col("s1") == F.col("s2")), F.lit(0.0)) \
           .otherwise(F.round((F.col("s2") - F.col("s1")) / F.col("s1") * 100, 2))
    out = agg.withColumn("value_change", F.round(F.col("s2") - F.col("s1"), 2)).withColumn("pct_change", pct)
    measure = F.col("pct_change") if kind == "percentage" else F.col("value_change")
    return out.withColumn("arrow", F.when(measure >= upper, F.lit("up"))
                          .when(measure <= lower, F.lit("down")).otherwise(F.lit("flat")))


def membership_change(a: DataFrame, b: DataFrame, key: str, attr: str,
                      attr_rank: Mapping[str, int]) -> DataFrame:
    """added / removed / size increased / size decreased / size removed / no change (O-53).

    Presence decides added and removed, so a member without a size is present. A missing old
    size counts as the lowest when the new one is larger than that, as the highest when smaller.
    """
    pairs = [x for k, v in attr_rank.items() for x in (F.lit(k), F.lit(v))]
    rank = F.create_map(*pairs)
    x = a.select(key, F.col(attr).alias(f"{attr}_1"), F.lit(True).alias("__in_a")).join(
        b.select(key, F.col(attr).alias(f"{attr}_2"), F.lit(True).alias("__in_b")), key, "full_outer")
    r1, r2 = F.try_element_at(rank, F.col(f"{attr}_1")), F.try_element_at(rank, F.col(f"{attr}_2"))
    low, high = F.lit(min(attr_rank.values())), F.lit(max(attr_rank.values()))
    change = (F.when(F.col("__in_a").isNull(), F.lit("added"))
              .when(F.col("__in_b").isNull(), F.lit("removed"))
              .when(r2 > F.coalesce(r1, low), F.lit("size increased"))
              .when(r2 < F.coalesce(r1, high), F.lit("size decreased"))
              .when(F.col(f"{attr}_1").isNotNull() & F.col(f"{attr}_2").isNull(), F.lit("size removed"))
              .otherwise(F.lit("no change")))
    return x.withColumn("change", change).drop("__in_a", "__in_b")


def diff_columns_long(a: DataFrame, b: DataFrame, keys: Sequence[str], cols: Sequence[str],
                      categories: Mapping[str, str]) -> DataFrame:
    """One row per entity and column with old, new and a change label (O-54).

    Columns are compared as strings; the (name, old, new) structs are built by a
    comprehension and exploded, replacing ~90 hand-written CASE columns and the
    reference's parameter cross join. Entities only in ``b`` are Joiner rows,
    only in ``a`` Leaver rows.
    """
    a1 = a.select(*keys, *[F.col(c).cast("string").alias(f"__o_{c}") for c in cols], F.lit(True).alias("__in_a"))
    b1 = b.select(*keys, *[F.col(c).cast("string").alias(f"__n_{c}") for c in cols], F.lit(True).alias("__in_b"))
    x = a1.join(b1, list(keys), "full_outer")
    items = F.array(*[F.struct(F.lit(c).alias("column_name"), F.lit(categories.get(c, "other")).alias("category"),
                               F.col(f"__o_{c}").alias("old_value"), F.col(f"__n_{c}").alias("new_value"))
                      for c in cols])
    x = x.select(*keys, "__in_a", "__in_b", F.explode(items).alias("__i")).select(
        *keys, "__in_a", "__in_b", "__i.*")
    # NULL and '' are one value here (T2)
    old, new = F.coalesce("old_value", F.lit("")), F.coalesce("new_value", F.lit(""))
    change = (F.when(F.col("__in_a").isNull(), F.lit("Joiner"))
              .when(F.col("__in_b").isNull(), F.lit("Leaver"))
              .when(old == new, F.lit("No Change"))
              .when(old == "", F.lit("Added"))
              .when(new == "", F.lit("Removed"))
              .otherwise(F.lit("Changed")))
    return x.withColumn("change", change).drop("__in_a", "__in_b")


def year_on_year(y1: DataFrame, y2: DataFrame, scheme: str, member: str, newest: Sequence[str] = (),
                 carry: Sequence[str] = ()) -> DataFrame:
    """Joiner / Leaver / No change per (scheme, member), and where a leaver went (O-55).

    The full join is null-safe on both keys. ``moved_to`` is the scheme of the leaver's newest
    row in year 2 (largest ``newest`` columns, then largest scheme: one row, so nothing fans
    out), and ``moved_<c>`` its attribute ``c`` for each of ``carry``.
    """
    a = y1.select(F.col(scheme).alias("__s1"), F.col(member).alias("__m1"), F.lit(True).alias("__in1"))
    b = y2.select(F.col(scheme).alias("__s2"), F.col(member).alias("__m2"), F.lit(True).alias("__in2"))
    x = a.join(b, F.col("__s1").eqNullSafe(F.col("__s2")) & F.col("__m1").eqNullSafe(F.col("__m2")), "full_outer")
    x = x.select(F.when(F.col("__in1"), F.col("__s1")).otherwise(F.col("__s2")).alias(scheme),
                 F.when(F.col("__in1"), F.col("__m1")).otherwise(F.col("__m2")).alias(member),
                 F.when(F.col("__in1").isNull(), F.lit("Joiner")).when(F.col("__in2").isNull(), F.lit("Leaver"))
                  .otherwise(F.lit("No change")).alias("status"))
    order = F.struct(*[F.col(c) for c in newest], F.col(scheme))
    dest = (y2.groupBy(F.col(member).alias("__m"))
              .agg(F.max_by(F.struct(F.col(scheme).alias("s"), *[F.col(c) for c in carry]), order).alias("__d")))
    x = x.join(dest, (x[member] == dest["__m"]) & (x["status"] == "Leaver"), "left")
    return x.select(scheme, member, "status", F.col("__d.s").alias("moved_to"), *[F.col(f"__d.{c}").alias(f"moved_{c}") for c in carry])


def changed_members(old: DataFrame, new: DataFrame, member: str) -> DataFrame:
    """Members with any changed, new or removed row, excluding members that are
    wholly new or wholly removed (O-56). Returns distinct member ids.

    Same result as EXCEPT DISTINCT both ways (grouping compares NULLs as
    equal), but as two partial aggregations instead of two distinct+anti-join
    pairs: rows tagged by side are grouped on all columns (a hot member is
    spread by the other columns), then folded per member.
    """
    cols = old.columns
    tagged = (old.select(*cols, F.lit(1).alias("__o"), F.lit(0).alias("__n"))
              .unionByName(new.select(*cols, F.lit(0).alias("__o"), F.lit(1).alias("__n"))))
    rows = tagged.groupBy(*cols).agg(F.max("__o").alias("__o"), F.max("__n").alias("__n"))
    per = rows.groupBy(member).agg(F.max("__o").alias("__in_old"), F.max("__n").alias("__in_new"),
                                   F.max(F.when(F.col("__o") + F.col("__n") == 1, 1).otherwise(0)).alias("__chg"))
    return per.filter((F.col("__in_old") == 1) & (F.col("__in_new") == 1) & (F.col("__chg") == 1)).select(member)


def cross_validate(declared: DataFrame, reported: DataFrame, key: str, declared_total: str,
                   reported_total: str, tolerance: float, flags: Mapping[str, DataFrame] | None = None) -> DataFrame:
    """Declared vs reported per key with tolerance rules (O-57).

    Both sides one row per key, full outer join; ``flags``: name -> DataFrame of
    keys, turned into booleans by joining their distinct keys (EXISTS, no fan-out).
    status: declared_only / reported_only / match (|diff| <= tolerance x declared)
    / mismatch.
    """
    x = (declared.select(key, declared_total, F.lit(True).alias("__in_d"))
         .join(reported.select(key, reported_total, F.lit(True).alias("__in_r")), key, "full_outer"))
    for name, keys_df in (flags or {}).items():
        k = keys_df.select(F.col(key).alias("__k")).distinct().withColumn(name, F.lit(True))
        x = x.join(k, x[key] == k["__k"], "left").drop("__k").withColumn(name, F.coalesce(name, F.lit(False)))
    # presence decides who declared and who reported; a missing total counts as 0
    d, r = F.coalesce(F.col(declared_total), F.lit(0)), F.coalesce(F.col(reported_total), F.lit(0))
    status = (F.when(F.col("__in_r").isNull(), F.lit("declared_only")).when(F.col("__in_d").isNull(), F.lit("reported_only"))
              .when(F.abs(d - r) <= F.abs(d) * tolerance, F.lit("match")).otherwise(F.lit("mismatch")))
    return x.withColumn("status", status).drop("__in_d", "__in_r")


def drill_down(rows: DataFrame, breakdowns: Sequence[tuple[str, Column, Column]], name: str,
               dim_value: str | None = None) -> DataFrame:
    """Rows of a diff behind one breakdown entry (O-51 drill, S2).

    ``breakdowns`` is the same data as for ``diff_breakdowns``: choosing a
    breakdown (and optionally a dimension value) is a filter, so the 73
    hand-written drill branches of the reference become one parameterised call.
    Each name resolves to exactly one breakdown (the reference's duplicated
    flag returned two result sets).
    """
    found = [(p, d) for n, p, d in breakdowns if n == name]
    if len(found) != 1:
        raise KeyError(f"breakdown {name!r} defined {len(found)} times")
    pred, dim = found[0]
    out = rows.filter(F.coalesce(pred, F.lit(False)))
    if dim_value is not None:
        out = out.filter(_dim(dim) == dim_value)
    return out
