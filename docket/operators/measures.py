"""Aggregation operators (O-36, O-40 .. O-50)."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from docket.functions.scan import KeyedScan


def _lit_map(d: Mapping) -> Column:
    return F.create_map(*[F.lit(x) for kv in d.items() for x in kv])


def extrapolate(df: DataFrame, measure: str, by: str, factors: Mapping[str, float], out: str,
                precision: tuple[int, int] = (16, 2), rounded: bool = False) -> DataFrame:
    """Scale partial-period quantities to a full period (O-36).

    ``factors`` is an argument (the reference disagrees with itself, T11);
    unknown classes keep factor 1. Result is ``decimal(p,s)`` (HALF_UP, T9), or
    a whole number with ``rounded``.
    """
    f = F.coalesce(F.try_element_at(_lit_map(factors), F.col(by)), F.lit(1.0))
    p, s = precision
    value = (F.col(measure) * f).cast(f"decimal({p},{s})")
    return df.withColumn(out, F.round(value, 0).cast("long") if rounded else value)


def relative_move(from_code: str, to_code: str, names: Mapping[str, str]) -> Column:
    """'England to Wales' where both ends are given, else NULL (O-36); an unknown code shows as empty."""
    text = lambda c: F.coalesce(F.try_element_at(_lit_map(names), F.col(c)), F.lit(""))
    return F.when(F.col(from_code).isNotNull() & F.col(to_code).isNotNull(), F.concat(text(from_code), F.lit(" to "), text(to_code)))


def split_material(material: str, sub_type: str, split: Sequence[str]) -> Column:
    """Materials of ``split`` are told apart by their sub-type where it is given (O-36)."""
    given = F.trim(F.coalesce(F.col(sub_type), F.lit("")))
    return F.when(F.col(material).isin(list(split)) & (given != ""), F.concat_ws(" - ", material, given)).otherwise(F.col(material))


def json_payload(df: DataFrame, group: Sequence[str], fields: Sequence[str], out: str = "payload",
                 page_size: int = 1000) -> DataFrame:
    """JSON arrays of members per group, in pages sorted by ``fields`` (O-40).

    One rule for every size: a member's ordinal in its group, by ``fields``, counted by a
    ``KeyedScan`` (so a hot group is spread over its ranges); page = ordinal div ``page_size``.
    The pages of a group, in order, hold its members in order. Built with ``to_json`` over a
    sorted struct array, never by concatenating strings. Equal members keep their number.
    """
    x = df.select(*group, *fields).withColumn("__id", F.monotonically_increasing_id())
    scan = KeyedScan(list(group), [*fields, "__id"])
    x = scan.finish(scan.count_before(scan.prepare(x), F.lit(True), "__n"))
    member = F.struct(*[F.col(c) for c in fields])
    return x.groupBy(*group, F.expr(f"__n div {page_size}").alias("page")).agg(
        F.count(F.lit(1)).alias("n_members"), F.to_json(F.array_sort(F.collect_list(member))).alias(out))


def complete_period_weights(facts: DataFrame, entity: str, set_col: str, period_col: str,
                            required: Sequence, order: Sequence[Column], file_col: str,
                            members: DataFrame, member_file: str, weight: Column,
                            deduct: Column) -> DataFrame:
    """Relational division + newest file per period + net tonnage (O-41).

    Entities qualify per set (e.g. year) only when they reported every required
    period; all sets are rows of one aggregation. For each qualifying (entity,
    set, period) the newest file is kept and its members' weight minus deducted
    weight is returned in tonnes (rounded to 3 places). Empty input gives a
    typed empty result.
    """
    req = facts.filter(F.col(period_col).isin(list(required)))
    ok = (req.groupBy(entity, set_col).agg(F.count_distinct(period_col).alias("__n"))
             .filter(F.col("__n") == len(required)).drop("__n"))
    cand = req.join(ok, [entity, set_col], "left_semi")
    w = Window.partitionBy(entity, set_col, period_col).orderBy(*order)
    newest = cand.withColumn("__rn", F.row_number().over(w)).filter("__rn = 1").drop("__rn")
    wts = members.groupBy(member_file).agg(
        F.sum(weight).alias("__w"), F.sum(F.when(deduct, weight).otherwise(0.0)).alias("__d"))
    out = newest.join(wts, newest[file_col] == wts[member_file], "left")
    return out.withColumn("net_weight_t", F.round((F.coalesce("__w", F.lit(0.0)) - F.coalesce("__d", F.lit(0.0)))
                                                  / 1000.0, 3)).drop("__w", "__d", member_file)


def half_year_population(df: DataFrame, entity: str, time: str, accepted: Column,
                         order: Sequence[str], file_col: str) -> DataFrame:
    """Per entity and year: latest accepted file, half-years with an accepted file, first
    date and obligated days to year end; liable = has an accepted file (O-42).
    One partial aggregation."""
    x = df.withColumn("year", F.year(time))
    agg = x.groupBy(entity, "year").agg(
        F.max_by(F.col(file_col), F.when(accepted, F.struct(*[F.col(c) for c in order]))).alias("latest_file"),
        F.max(accepted & (F.month(time) <= 6)).alias("has_h1"),
        F.max(accepted & (F.month(time) > 6)).alias("has_h2"),
        F.min(F.col(time).cast("date")).alias("first_date"))
    agg = agg.filter(F.col("latest_file").isNotNull())
    return agg.withColumn("obligated_days",
                          F.datediff(F.make_date("year", F.lit(12), F.lit(31)), F.col("first_date")) + 1)


def weight_pivots(df: DataFrame, keys: Sequence[str], axes: Sequence[tuple[str, Sequence[str]]],
                  measures: Mapping[str, Column | None]) -> DataFrame:
    """Fixed-column pivots fused into one pass of conditional sums (O-43).

    ``axes``: [(column, values)]; every combination becomes a column per
    measure (``None`` measure = row count). Same shape as several
    ``groupBy().pivot(values)`` calls, but one scan and one shuffle.
    """
    combos: list[list[tuple[str, str]]] = [[]]
    for col, vals in axes:
        combos = [c + [(col, v)] for c in combos for v in vals]
    aggs = []
    for name, m in measures.items():
        for combo in combos:
            cond = F.lit(True)
            for col, v in combo:
                cond = cond & (F.col(col) == v)
            suffix = "_".join(v for _, v in combo)
            if m is None:
                aggs.append(F.count(F.when(cond, 1)).alias(f"{name}_{suffix}"))
            else:
                aggs.append(F.round(F.coalesce(F.sum(F.when(cond, m)), F.lit(0.0)), 2).alias(f"{name}_{suffix}"))
    return df.groupBy(*keys).agg(*aggs)


def status_dates(df: DataFrame, key: str, status_col: str, time: str, statuses: Sequence[str]) -> DataFrame:
    """Pivot the newest time of each status into date and time-of-day columns (O-44).

    Explicit group keys (trap T5); one aggregation.
    """
    aggs = [F.max(F.when(F.col(status_col) == s, F.col(time))).alias(f"__{s}") for s in statuses]
    x = df.groupBy(key).agg(*aggs)
    cols = [key]
    for s in statuses:
        cols.append(F.to_date(F.col(f"__{s}")).alias(f"{s}_date"))
        cols.append(F.date_format(F.col(f"__{s}"), "HH:mm:ss").alias(f"{s}_time"))
    return x.select(*cols)


def child_counts(parents: DataFrame, parent_key: str, children: DataFrame, child_key: str,
                 counts: Mapping[str, Column]) -> DataFrame:
    """Children per parent with conditional and distinct counts; parents without
    children get 0 (O-45). Children are aggregated before the join."""
    agg = children.groupBy(child_key).agg(*[c.alias(n) for n, c in counts.items()])
    out = parents.join(agg, parents[parent_key] == agg[child_key], "left").drop(agg[child_key])
    return out.fillna(0, subset=list(counts))


def obligation_balance(df: DataFrame, keys: Sequence[str], required: Column, accepted: Column,
                       awaiting: Column) -> DataFrame:
    """Required against accepted and awaiting quantities per key, with Met / Not Met (O-46).

    The three columns are NULL on rows that do not count for them: one aggregation of
    conditional sums instead of a full join of two.
    """
    agg = df.groupBy(*keys).agg(*[F.round(F.coalesce(F.sum(c), F.lit(0.0)), 2).alias(n) for n, c in
                                  (("required", required), ("accepted", accepted), ("awaiting", awaiting))])
    return _balanced(agg)


def newest_balance(df: DataFrame, keys: Sequence[str], order: Sequence[str], is_obligation: Column,
                   is_credit: Column, amount: Column) -> DataFrame:
    """Balance of the newest obligation row and the newest credit row per key (O-46).

    Earlier rows of a key are superseded, not added. Both picks are one partial aggregation;
    ``order`` is total within a key.
    """
    at = F.struct(*[F.col(c) for c in order])
    agg = df.groupBy(*keys).agg(F.max_by(amount, F.when(is_obligation, at)).alias("required"),
                                F.max_by(amount, F.when(is_credit, at)).alias("accepted"))
    agg = agg.withColumns({n: F.round(F.coalesce(n, F.lit(0.0)), 2) for n in ("required", "accepted")})
    return _balanced(agg.withColumn("awaiting", F.lit(0.0))).drop("awaiting")


def _balanced(agg: DataFrame) -> DataFrame:
    out = agg.withColumn("remaining", F.round(F.col("required") - F.col("accepted") - F.col("awaiting"), 2))
    return out.withColumn("status", F.when(F.col("remaining") <= 0, F.lit("Met")).otherwise(F.lit("Not Met")))


def hierarchy_rollup(df: DataFrame, levels: Sequence[tuple[str, str]], measures: Mapping[str, Column]) -> DataFrame:
    """Totals at every level of a one-hop-per-level hierarchy (O-47).

    Each row is exploded to (level, node) pairs — itself and each ancestor —
    then aggregated once: the reference's OR joins become one equi-grouping and
    nothing is double counted.
    """
    pairs = F.array(*[F.struct(F.lit(name).alias("level"), F.col(col).cast("long").alias("node_id"))
                      for name, col in levels])
    x = df.withColumn("__p", F.explode(pairs))
    return x.groupBy(F.col("__p.level").alias("level"), F.col("__p.node_id").alias("node_id")) \
            .agg(*[m.alias(n) for n, m in measures.items()])


def concat_labels(df: DataFrame, keys: Sequence[str], col: str, out: str, sep: str = ",") -> DataFrame:
    """Sorted, distinct, separated list of values per key (O-49)."""
    return df.groupBy(*keys).agg(F.array_join(F.array_sort(F.collect_set(col)), sep).alias(out))


def share_of_total(df: DataFrame, keys: Sequence[str], group: str, measure: Column, out: str) -> DataFrame:
    """Group sum next to the whole-key sum (O-50): SUM(SUM(x)) OVER (keys).

    The window runs after the aggregation, so a key's partition holds one row
    per distinct ``group`` value, not its raw rows.
    """
    g = df.groupBy(*keys, group).agg(F.sum(measure).alias(out))
    w = Window.partitionBy(*keys)
    g = g.withColumn(f"{out}_total", F.sum(out).over(w))
    return g.withColumn("share", F.round(F.try_divide(F.col(out), F.col(f"{out}_total")), 4)) \
            .withColumn(out, F.round(out, 2)).withColumn(f"{out}_total", F.round(f"{out}_total", 2))


def obligation_lines(edges: DataFrame, parent: str, child: str, amounts: DataFrame, org: str, amount: str,
                     credits: DataFrame | None = None, credit: str = "credit") -> DataFrame:
    """Parent line with the group total and zero child lines (O-47 report shape).

    Parent total = its own amount + its children's (one hop, via ``edges``);
    each child appears as a line with obligation 0; the parent's credit is
    shown on the first line only — the parent line, which sorts first by
    construction, so no window over a (possibly huge) group is needed.
    ``remaining`` = obligation - credit on the parent line.
    """
    own = amounts.select(F.col(org).alias("__org"), F.col(amount).alias("__amt"))
    via = edges.select(F.col(parent).alias("__p"), F.col(child).alias("__c")) \
               .join(own, F.col("__c") == F.col("__org")).select(F.col("__p").alias("__org"), "__amt")
    parents = edges.select(F.col(parent).alias("__org")).distinct()
    total = parents.join(own.unionByName(via), "__org", "left").groupBy("__org") \
                   .agg(F.round(F.coalesce(F.sum("__amt"), F.lit(0.0)), 2).alias("obligation"))
    plines = total.select(F.col("__org").alias("parent_id"), F.lit("parent").alias("line_type"),
                          F.col("__org").alias("org_id"), "obligation")
    if credits is not None:  # only parent lines show a credit, so only they are joined
        cr = credits.select(F.col(org).alias("__cp"), F.col(credit).alias("__cr"))
        plines = plines.join(cr, F.col("parent_id") == F.col("__cp"), "left").drop("__cp")
    else:
        plines = plines.withColumn("__cr", F.lit(None).cast("double"))
    clines = edges.select(F.col(parent).alias("parent_id"), F.lit("child").alias("line_type"),
                          F.col(child).alias("org_id"), F.lit(0.0).alias("obligation"), F.lit(None).cast("double").alias("__cr"))
    lines = plines.unionByName(clines)
    first = F.col("line_type") == "parent"
    lines = lines.withColumn("credit", F.when(first, F.round(F.coalesce("__cr", F.lit(0.0)), 2)).otherwise(F.lit(0.0)))
    return lines.drop("__cr").withColumn(
        "remaining", F.when(first, F.round(F.col("obligation") - F.col("credit"), 2)).otherwise(F.lit(0.0)))
