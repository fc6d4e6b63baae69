"""Enrichment and shaping (O-28 .. O-34)."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docket.functions.scan import dealt
from docket.functions.text import ci

from docket.operators.gaps import expected_grid


def attach_lookups(df: DataFrame, lookups: Sequence[tuple[DataFrame, Column]]) -> DataFrame:
    """Left-join each dimension on its condition (caller aliases the columns).

    Dimensions are not force-broadcast: AQE broadcasts those under the runtime
    threshold and shuffles the rest, so a dimension that grows with the data
    never blows up the executors.
    """
    for dim, cond in lookups:
        df = df.join(dim, cond, "left")
    return df


def flatten_entities(a: DataFrame, b: DataFrame, a_key: str, b_key: str,
                     lookups: Sequence[tuple[DataFrame, Column]] = (),
                     roles: tuple[str, str] = ("from", "to")) -> DataFrame:
    """Two sides of a connection, full outer, into one wide record (O-28).

    ``party_id`` = coalesce of the keys; ``role`` = both / <from> only / <to> only.
    Keys are unique per side, so the full join is 1:1 and cannot fan out;
    lookups (nation, region, ...) are then attached as left joins.
    """
    x = a.join(b, F.col(a_key) == F.col(b_key), "full_outer")
    x = x.withColumn("party_id", F.coalesce(F.col(a_key).cast("long"), F.col(b_key).cast("long")))
    role = (F.when(F.col(a_key).isNotNull() & F.col(b_key).isNotNull(), F.lit("both"))
            .when(F.col(a_key).isNotNull(), F.lit(f"{roles[0]} only")).otherwise(F.lit(f"{roles[1]} only")))
    return attach_lookups(x.withColumn("role", role), lookups)


def expand_row_scope(df: DataFrame, ids: Sequence[str], scope_cols: Mapping[str, str],
                     role_col: str = "scope_role", scope_col: str = "scope") -> DataFrame:
    """One row per visible scope value (O-29): unpivot, NULL scopes dropped as
    T-SQL UNPIVOT does. ``scope_cols``: source column -> role label."""
    x = df.select(*ids, *[F.col(c).alias(label) for c, label in scope_cols.items()])
    out = x.unpivot(list(ids), list(scope_cols.values()), role_col, scope_col)
    return out.filter(F.col(scope_col).isNotNull())


def row_scope(df: DataFrame, scope_col: str, visible: DataFrame, visible_col: str) -> DataFrame:
    """Rows whose scope is visible to the caller: EXISTS against the caller's scope list."""
    v = visible.select(F.col(visible_col).alias("__scope")).distinct()
    return df.join(v, F.col(scope_col) == F.col("__scope"), "left_semi")


def multi_path_lookup(rows: DataFrame, paths: Sequence[tuple[str, Column, Mapping[str, Column]]]) -> DataFrame:
    """Union-distinct of several derivations of one relation, each tagged (O-30).

    ``paths``: (tag, predicate, columns). Every path is derived from the same joined rows: a row
    is exploded into an entry per path whose predicate holds, so the facts are read and joined
    once however many paths there are.
    """
    entries = F.array(*[F.when(pred, F.struct(*[c.alias(n) for n, c in cols.items()], F.lit(tag).alias("path")))
                        for tag, pred, cols in paths])
    return rows.select(F.inline(F.filter(entries, lambda e: e.isNotNull()))).distinct()


def attach_optional_children(parent: DataFrame, key: str,
                             children: Sequence[tuple[DataFrame, str]]) -> DataFrame:
    """parent x childA  U  parent x childB  U  parents with no child (O-31).

    Each child is (DataFrame, its key column); missing columns become NULL. The children are
    unioned first, so one left join attaches them all and leaves childless parents their row.
    """
    out = None
    for child, ckey in children:
        c = child.withColumnRenamed(ckey, "__ck")
        out = c if out is None else out.unionByName(c, allowMissingColumns=True)
    return parent.join(out, F.col(key) == F.col("__ck"), "left").drop("__ck")


def role_views(rows: DataFrame, roles: Sequence[tuple[str, Column, Column]], measures: Mapping[str, Column],
               role_col: str = "role", entity_col: str = "entity_id") -> DataFrame:
    """The same facts seen under several roles (O-32).

    ``roles``: (label, predicate, entity). Rows are exploded into an entry per role they play
    and aggregated once: the facts are read once for all roles, and combined before the shuffle.
    """
    entries = F.array(*[F.when(pred, F.struct(F.lit(label).alias("r"), entity.cast("long").alias("e")))
                        for label, pred, entity in roles])
    x = rows.withColumn("__e", F.explode(F.filter(entries, lambda e: e.isNotNull())))
    return x.groupBy(F.col("__e.r").alias(role_col), F.col("__e.e").alias(entity_col)).agg(
        *[m.alias(n) for n, m in measures.items()])


def entity_extract(facts: DataFrame, lookups: Sequence[tuple[DataFrame, Column, str]],
                   cols: Sequence[str], deal_by: str | None = None) -> DataFrame:
    """Distinct wide extract over a star join (O-33); ``lookups``: (dim, condition, how).

    Before the last lookup the facts are dealt by ``deal_by``, into partitions whose number grows
    with the facts. If the last condition equates it with one of ``cols``, join and distinct both
    work on these partitions: no wide row is shuffled, and a task's memory does not grow with the table.
    """
    x = facts
    for k, (dim, cond, how) in enumerate(lookups):
        if deal_by and k == len(lookups) - 1:
            x = dealt(x, facts.count(), deal_by)
        x = x.join(dim, cond, how)
    return x.select(*cols).distinct()


def extract_recent(entities: DataFrame, key: str, facts: DataFrame, period_col: str, periods: Sequence,
                   order: Sequence[str], file_col: str, status_col: str,
                   file_measures: DataFrame, file_measure_key: str) -> DataFrame:
    """Per entity and period: presence, first and latest file, latest status, and
    the latest file's measure pivots (O-34). Grid (O-35) + one first/latest
    aggregation (O-15 shape) + a pivot table keyed by file (O-43)."""
    grid = expected_grid(entities, key, periods, period_col, facts)
    fl = facts.groupBy(key, period_col).agg(
        F.min(F.struct(*[F.col(c) for c in order], F.col(file_col).alias("__f"))).getField("__f").alias("first_file"),
        F.max(F.struct(*[F.col(c) for c in order], F.col(file_col).alias("__f"),
                       F.col(status_col).alias("__s"))).alias("__last"))
    fl = fl.select(key, period_col, "first_file", F.col("__last.__f").alias("latest_file"),
                   F.col("__last.__s").alias("latest_status"))
    x = grid.join(fl, [key, period_col], "left")
    pm = file_measures.withColumnRenamed(file_measure_key, "latest_file")
    return x.join(pm, "latest_file", "left")


def role_columns(people: DataFrame, entity: str, role: str, roles: Sequence[str], order: Sequence[str],
                 fields: Sequence[str]) -> DataFrame:
    """Per entity the newest person of each role, one column per role and field (O-28).

    ``order`` is total within an entity. One aggregation with a pick per role, so an entity with
    very many people is combined before the shuffle. Roles compare without case (T1).
    """
    rank = F.struct(*[F.col(c) for c in order])
    record = F.struct(*[F.col(c) for c in fields])
    picks = [F.max_by(record, F.when(ci(role) == r.lower(), rank)).alias(f"__{r}") for r in roles]
    return people.groupBy(entity).agg(*picks).select(entity, *[F.col(f"__{r}.{c}").alias(f"{r.lower()}_{c}") for r in roles for c in fields])


def flatten_contacts(entities: DataFrame, key: str, contacts: DataFrame, schemes: DataFrame, enrolments: DataFrame,
                     enrolment_status: str) -> DataFrame:
    """Entities with their contacts by role, scheme and enrolment counts by state, one wide row each
    (O-28). Every side has one row per entity before it is joined, so nothing fans out."""
    states = enrolments.groupBy(key).agg(F.count(F.lit(1)).alias("n_enrolments"),
                                         F.count(F.when(ci(enrolment_status) == "approved", 1)).alias("n_approved"))
    out = entities.join(contacts, key, "left").join(schemes, key, "left").join(states, key, "left")
    return out.fillna(0, ["n_enrolments", "n_approved"])


def one_user_per_file(users: DataFrame, file: str, order: Sequence[str], fields: Sequence[str]) -> DataFrame:
    """The newest user row of each file (O-67): a file with several matching users keeps one."""
    return users.groupBy(file).agg(F.max_by(F.struct(*[F.col(c) for c in fields]), F.struct(*[F.col(c) for c in order])).alias("__u")) \
                .select(file, *[F.col(f"__u.{c}").alias(f"user_{c}") for c in fields])
