"""Breakdowns and drills of a two-version diff, by rules that are data (O-52, O-51 drill).

A rule names a subset of the rows (texts that columns hold, columns that are filled or blank) and
the columns it is shown by. ``breakdown_cube`` turns a list of rules into one typed cube;
``write_drill`` keeps the rows behind each rule in a partition of its own.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from docket.functions.scan import null_safe_join
from docket.functions.text import ci
from docket.session import committed


HELD, FILLED = "__held_{}", "__filled_{}"
COMBINATION, GROUP = "__combination", "__group"


def fold(text: str) -> str:
    """A text as ``ci`` compares it."""
    return text.rstrip(" ").lower()


@dataclass(frozen=True)
class Rule:
    name: str
    where: Mapping[str, Sequence[str]] = field(default_factory=dict)  # column -> texts, any of them, case-blind (T1)
    filled: Sequence[str] = ()
    blank: Sequence[str] = ()
    by: Sequence[str] = ()

    def predicate(self) -> Column:
        """The rule over the columns of ``_case``."""
        cond = F.lit(True)
        for c, texts in self.where.items():
            cond = cond & F.col(HELD.format(c)).isin([fold(t) for t in texts])
        for c in self.filled:
            cond = cond & F.col(FILLED.format(c))
        for c in self.blank:
            cond = cond & ~F.col(FILLED.format(c))
        return cond

    @property
    def reads(self) -> set[str]:
        return {*self.where, *self.filled, *self.blank, *self.by}


def _case(rules: Sequence[Rule]) -> dict[str, Column]:
    """What the rules can tell of a row: which of the texts they name each column holds ('' for any
    other), and which columns are filled."""
    named = {c: sorted({fold(t) for r in rules for t in r.where.get(c, ())}) for c in sorted({c for r in rules for c in r.where})}
    out = {HELD.format(c): F.when(ci(c).isin(texts), ci(c)).otherwise("") for c, texts in named.items()}
    return out | {FILLED.format(c): F.coalesce(ci(c), F.lit("")) != "" for c in sorted({c for r in rules for c in (*r.filled, *r.blank)})}


def by_rule(rows: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """``rows`` once for every rule they meet, named in ``rule``.

    Rules are tried on the distinct cases only, of which there are no more than the texts that the
    rules name allow; so they may be broadcast to all rows, whatever the number of rules.
    """
    names = [r.name for r in rules]
    if len(set(names)) != len(names):
        raise ValueError(f"rules share a name: {sorted({n for n in names if names.count(n) > 1})}")
    case = _case(rules)
    x = rows.select("*", *[c.alias(n) for n, c in case.items()])
    cases = committed(x.select(*case).distinct(), "cases")  # so that no rule is pushed down to the rows
    met = F.array_compact(F.array(*[F.when(r.predicate(), F.lit(r.name)) for r in rules]))
    cases = cases.withColumn("__met", met).filter(F.size("__met") > 0)
    return x.join(F.broadcast(cases), list(case)).select(*rows.columns, F.explode("__met").alias("rule"))


def change(s1: Column, s2: Column, kind: str) -> Column:
    """Percentage: 0 if either side is 0 (and for equal sides), else the signed change of the first. Value: s2 - s1."""
    if kind == "value":
        return F.round(s2 - s1, 2)
    if kind != "percentage":
        raise ValueError(kind)
    return F.when((s1 == 0) | (s2 == 0), F.lit(0.0)).otherwise(F.round((s2 - s1) / s1 * 100, 2))


def _names(base: DataFrame, dims: Sequence[str]) -> DataFrame:
    """(dim, folded, shown): one spelling for texts that differ in case only, the least one."""
    each = F.explode(F.array(*[F.struct(F.lit(d).alias("dim"), F.col(d).alias("text")) for d in dims])).alias("x")
    once = base.select(each).select("x.dim", "x.text").filter("text IS NOT NULL").distinct()
    return once.groupBy("dim", ci("text").alias("folded")).agg(F.min("text").alias("shown"))


def _scaffold(names: DataFrame, rules: Sequence[Rule], dims: Sequence[str]) -> DataFrame:
    """(rule, dims): every combination of the values that a rule's columns have; blank ones are left out."""
    spark = names.sparkSession
    need = [(r.name, *[d if d in r.by else None for d in dims]) for r in rules]
    out = spark.createDataFrame(need, "rule string, " + ", ".join(f"need_{d} string" for d in dims))
    for d in dims:
        values = names.filter("folded <> ''").select(F.col("dim").alias(f"of_{d}"), F.col("folded").alias(f"key_{d}"), F.col("shown").alias(d))
        allowed = F.lit(True)
        for r in rules:
            if d in r.by and d in r.where:
                allowed = F.when(F.col("rule") == r.name, F.col(f"key_{d}").isin([t.lower() for t in r.where[d]])).otherwise(allowed)
        out = out.join(values, F.col(f"need_{d}") == F.col(f"of_{d}"), "left")
        out = out.filter(F.col(f"need_{d}").isNull() | (F.col(d).isNotNull() & allowed)).drop(f"need_{d}", f"of_{d}", f"key_{d}")
    return out


def breakdown_cube(rows: DataFrame, rules: Sequence[Rule], entity: Sequence[str], dims: Sequence[str], v1: Column, v2: Column,
                   kind: str = "percentage", upper: float = 10.0, lower: float = -10.0) -> DataFrame:
    """All breakdowns of a two-version diff: (level, breakdown, entity, dims, s1, s2, change, arrow) (O-52).

    Each rule groups by the entity columns and its own ``by`` columns, which keep their names and types;
    dims that a rule does not group by are NULL. ``level``: ``member`` for a rule's groups; ``scaffold``
    for a zero row (entity NULL) of every combination of the values its columns have in ``rows``;
    ``total`` for the sums over all entities, zero rows included. Texts that differ in case are one
    value, shown by its least spelling (T1); NULL and '' stay apart in groups. Missing quantities
    count as 0. At level ``total`` the change is 0 for both kinds when either side is 0.

    ``rows`` is read once. Rules, spellings and the groups that rows end in are worked out on the distinct
    combinations of the columns in use alone; rows are reduced to sums by entity and combination before
    they are dealt to the groups, which are told apart by numbers until their texts are put back at the end.
    """
    used = sorted({c for r in rules for c in r.reads} | set(dims))
    only_blank = [c for c in used if c not in dims and not any(c in r.where for r in rules)]
    keep = [F.when(F.coalesce(ci(c), F.lit("")) != "", F.lit("x")).alias(c) if c in only_blank else F.col(c) for c in used]
    base = committed(rows.select(*entity, *keep, F.coalesce(v1, F.lit(0.0)).alias("s1"), F.coalesce(v2, F.lit(0.0)).alias("s2")), "cube")
    combined = committed(base.select(*used).distinct().withColumn(COMBINATION, F.monotonically_increasing_id()), "combinations")
    names = committed(_names(combined, dims), "names")

    tagged = by_rule(combined, rules)
    shown = tagged.select("rule", COMBINATION, *[F.when(F.col("rule").isin([r.name for r in rules if d in r.by]), F.col(d)).alias(d) for d in dims])
    for d in dims:
        n = names.select(F.col("dim").alias("__dim"), F.col("folded").alias("__folded"), F.col("shown").alias("__shown"))
        shown = shown.join(n, (F.col("__dim") == F.lit(d)) & (F.col("__folded") == ci(d)), "left")
        shown = shown.withColumn(d, F.coalesce("__shown", d)).drop("__dim", "__folded", "__shown")
    total = ["rule", *dims]
    shown = committed(shown, "shown")
    groups = committed(shown.select(*total).distinct().withColumn(GROUP, F.monotonically_increasing_id()), "groups")
    links = committed(null_safe_join(shown, groups, total).select(COMBINATION, GROUP), "links")
    zero = committed(_scaffold(names, rules, dims).select(*total).distinct(), "scaffold")

    add = [F.sum("s1").alias("s1"), F.sum("s2").alias("s2")]
    sums = committed(null_safe_join(base, combined, used).groupBy(*entity, COMBINATION).agg(*add), "sums")
    member = sums.join(links, COMBINATION).groupBy(*entity, GROUP).agg(*add).join(groups, GROUP)
    over = sums.groupBy(COMBINATION).agg(*add).join(links, COMBINATION).groupBy(GROUP).agg(*add).join(groups, GROUP)
    nothing = zero.select(*total, F.lit(0.0).alias("s1"), F.lit(0.0).alias("s2"))
    over = over.select(*total, "s1", "s2").unionByName(nothing).groupBy(*total).agg(*add)
    no_entity = [F.lit(None).cast(base.schema[e].dataType).alias(e) for e in entity]
    s1, s2 = F.col("s1"), F.col("s2")
    show = lambda x, level, who: x.select(F.lit(level).alias("level"), F.col("rule").alias("breakdown"), *who, *dims,
                                          F.round(s1, 2).alias("s1"), F.round(s2, 2).alias("s2"))
    own = show(member, "member", entity).unionByName(show(nothing, "scaffold", no_entity)).withColumn("change", change(s1, s2, kind))
    every = show(over, "total", no_entity).withColumn("change", F.when((s1 == 0) | (s2 == 0), F.lit(0.0)).otherwise(change(s1, s2, kind)))
    out = own.unionByName(every)
    return out.withColumn("arrow", F.when(F.col("change") >= upper, "up").when(F.col("change") <= lower, "down").otherwise("flat"))


def write_drill(rows: DataFrame, rules: Sequence[Rule], path: str) -> None:
    """The rows behind every rule, under ``path`` in one folder per rule (O-51 drill).

    A row is tagged once with all rules it meets and written for each, so its fan-out is bounded by
    the rules. Rows are rebalanced by rule: small rules share tasks, a large one is split.
    """
    tagged = by_rule(rows, rules)
    tagged.hint("rebalance", "rule").write.partitionBy("rule").parquet(path)


def read_drill(spark: SparkSession, path: str, rule: str, **values: str) -> DataFrame:
    """The rows behind one rule whose columns hold these values: reads the rule's folder, with the
    values pushed down. A NULL never matches (T3); letters match in either case (T1)."""
    out = spark.read.parquet(path).filter(F.col("rule") == rule)
    for c, v in values.items():
        out = out.filter(ci(c) == v.lower().rstrip(" "))
    return out
