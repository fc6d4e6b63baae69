"""Latest-state selection (O-14 .. O-19)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from docket.functions.scan import KeyedScan, null_safe_join


def _cols(xs):
    return [F.col(x) if isinstance(x, str) else x for x in xs]


def latest_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[Column],
                   where: Column | None = None) -> DataFrame:
    """One row per key: the first row under ``order`` (O-14).

    ``order`` must be a total order within a key (T8). ``row_number() = 1`` lets
    Catalyst insert a partial WindowGroupLimit before the shuffle, so each map
    task forwards at most one row per key: a hot key costs one row per task.
    """
    if where is not None:
        df = df.filter(where)
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("__rn", F.row_number().over(w)).filter("__rn = 1").drop("__rn")


def first_and_latest(df: DataFrame, keys: Sequence[str], class_col: str,
                     priority: Sequence[str], order: Sequence[str],
                     payload: Sequence[str]) -> DataFrame:
    """First and latest row per key side by side, within the best class present (O-15).

    ``priority`` lists classes best first; rows of other classes are ignored.
    One aggregation with min/max over structs: partial aggregation makes it
    insensitive to hot keys.
    """
    rank = F.array_position(F.array(*[F.lit(p) for p in priority]), F.col(class_col)).cast("int")
    base = df.withColumn("__r", rank).filter(F.col("__r") > 0)
    first = F.min(F.struct(F.col("__r").alias("r"), *_cols(order), *_cols(payload)))
    last = F.max(F.struct((-F.col("__r")).alias("r"), *_cols(order), *_cols(payload)))
    agg = base.groupBy(*keys).agg(first.alias("__f"), last.alias("__l"))
    out = agg.select(*keys,
                     F.element_at(F.array(*[F.lit(p) for p in priority]), F.col("__f.r")).alias("chosen_class"),
                     *[F.col(f"__f.{c}").alias(f"first_{c}") for c in [*order, *payload]],
                     *[F.col(f"__l.{c}").alias(f"latest_{c}") for c in [*order, *payload]])
    return out


def latest_flag(df: DataFrame, keys: Sequence[str], ts: Column, out: str = "is_latest") -> DataFrame:
    """Flag every row tied at the newest ``ts`` of its key (O-16).

    Max per key is a partial aggregate joined back; AQE broadcasts it when small
    and splits a skewed key on the big side otherwise (no key-wide window).
    """
    df = df.withColumn("__ts", ts)
    mx = df.groupBy(*keys).agg(F.max("__ts").alias("__mx"))
    return (null_safe_join(df, mx, list(keys))
              .withColumn(out, F.coalesce(F.col("__ts") == F.col("__mx"), F.lit(False)))
              .drop("__ts", "__mx"))


def latest_with_fallback(df: DataFrame, keys: Sequence[str], accepted: Column,
                         order: Sequence[str], cols: Sequence[str]) -> DataFrame:
    """Attributes of the latest accepted row where one exists, else of the latest row (O-17).

    Both picks come out of one aggregation (``max_by`` with a NULL ordering for
    non-accepted rows). The choice is by existence of an accepted row, not by
    ``coalesce``, so NULL attributes of the accepted row win.
    """
    payload = F.struct(*_cols(cols))
    ordering = F.struct(*_cols(order))
    agg = df.groupBy(*keys).agg(
        F.max_by(payload, F.when(accepted, ordering)).alias("__acc"),
        F.max_by(payload, ordering).alias("__any"))
    pick = F.when(F.col("__acc").isNotNull(), F.col("__acc")).otherwise(F.col("__any"))
    return agg.select(*keys, *[pick.getField(c).alias(c) for c in cols],
                      F.when(F.col("__acc").isNotNull(), F.lit("accepted"))
                       .otherwise(F.lit("submitted")).alias("source"))


def collapse_repeats(df: DataFrame, keys: Sequence[str], order: Sequence[str], state: str,
                     file_col: str) -> DataFrame:
    """Drop a row when the next row of its key has the same state from a different file (O-18).

    The LEAD runs as a keyed scan so a hot key is split across tasks.
    """
    scan = KeyedScan(list(keys), list(order))
    x = scan.prepare(df)
    x = scan.next_value(x, F.struct(F.col(state).alias("s"), F.col(file_col).alias("f")), "__next")
    drop = (F.col("__next.s").eqNullSafe(F.col(state))) & ~(F.col("__next.f").eqNullSafe(F.col(file_col)))
    return scan.finish(x.filter(F.col("__next").isNull() | ~drop).drop("__next"))


def source_preference_latest(sources: Sequence[tuple[DataFrame, int]], keys: Sequence[str],
                             order: Sequence[Column]) -> DataFrame:
    """Union sources; per key prefer the lower source rank, then ``order`` (O-19)."""
    tagged = None
    for df, rank in sources:
        d = df.withColumn("source_rank", F.lit(rank))
        tagged = d if tagged is None else tagged.unionByName(d)
    return latest_per_key(tagged, keys, [F.col("source_rank").asc(), *order])


# Regulator statuses folded into the ACCEPTED class.
ACCEPTED_STATUSES = ["GRANTED", "REFUSED", "CANCELLED", "APPROVED"]


def submission_first_latest(df: DataFrame, keys: Sequence[str], time: str, file_col: str, status: str,
                            resub: Column, payload: Sequence[str] = ()) -> DataFrame:
    """First and latest submission per key under the full status-class rules (O-15, S5).

    1. class: raw = upper(trim(status)), missing -> PENDING; QUERIED -> PENDING;
       GRANTED/REFUSED/CANCELLED/APPROVED -> ACCEPTED; other values stay.
    2. among non-resubmission PENDING/ACCEPTED rows: if a key's newest such row
       is not QUERIED, all its QUERIED rows are dropped;
    3. a QUERIED row followed (in time) by a QUERIED row of another file is
       dropped (consecutive queries collapse to the last);
    4. first = earliest remaining pending/accepted row, else the latest
       rejected non-resubmission;
    5. latest = newest of: last remaining pending/accepted row, last rejected
       resubmission when the key has no pending/accepted resubmission, last
       pending/accepted resubmission.
    Ties on time are broken by file. One aggregate + join for rule 2, a
    keyed scan for rule 3, one aggregation for rules 4-5.
    """
    raw = F.upper(F.trim(F.coalesce(F.col(status), F.lit("PENDING"))))
    cls = (F.when(raw == "QUERIED", F.lit("PENDING")).when(raw.isin(ACCEPTED_STATUSES), F.lit("ACCEPTED"))
           .otherwise(raw))
    x = (df.withColumn("__raw", raw).withColumn("__cls", cls)
           .withColumn("__resub", F.coalesce(resub, F.lit(False))))
    is_pa = F.col("__cls").isin("PENDING", "ACCEPTED")
    pa = x.filter(is_pa & ~F.col("__resub"))
    newest = pa.groupBy(*keys).agg(F.max_by("__raw", F.struct(time, file_col)).alias("__newest"))
    pa = (null_safe_join(pa, newest, list(keys))
            .filter((F.col("__raw") != "QUERIED") | (F.col("__newest") == "QUERIED")).drop("__newest"))
    scan = KeyedScan(list(keys), [time, file_col])
    pa = scan.finish(scan.run(scan.prepare(pa), firsts={
        "__next": (F.lit(True), F.struct(F.col("__raw").alias("raw"), F.col(file_col).alias("f")))}))
    collapse = ((F.col("__raw") == "QUERIED") & (F.col("__next.raw") == "QUERIED")
                & ~F.col("__next.f").eqNullSafe(F.col(file_col)))
    pa = pa.filter(~F.coalesce(collapse, F.lit(False))).drop("__next")
    rest = x.filter(~(is_pa & ~F.col("__resub")))
    kind_rest = (F.when((F.col("__cls") == "REJECTED") & ~F.col("__resub"), F.lit("rej"))
                 .when((F.col("__cls") == "REJECTED") & F.col("__resub"), F.lit("rej_r"))
                 .when(is_pa & F.col("__resub"), F.lit("pa_r")))
    u = pa.withColumn("__kind", F.lit("pa")).unionByName(rest.withColumn("__kind", kind_rest))
    rec = F.struct(F.col(time).alias("t"), F.col(file_col).alias("f"), F.col("__raw").alias("s"),
                   *[F.col(c) for c in payload])
    k = F.col("__kind")
    agg = u.groupBy(*keys).agg(
        F.min(F.when(k == "pa", rec)).alias("__first_pa"), F.max(F.when(k == "pa", rec)).alias("__last_pa"),
        F.max(F.when(k == "rej", rec)).alias("__last_rej"), F.max(F.when(k == "rej_r", rec)).alias("__last_rej_r"),
        F.max(F.when(k == "pa_r", rec)).alias("__last_pa_r"))
    first = F.coalesce(F.col("__first_pa"), F.col("__last_rej"))
    latest = F.greatest(F.col("__last_pa"), F.when(F.col("__last_pa_r").isNull(), F.col("__last_rej_r")),
                        F.col("__last_pa_r"))
    out = agg.select(*keys, first.alias("__first"), latest.alias("__latest"))
    cols = [*keys]
    for side in ("first", "latest"):
        cols += [F.col(f"__{side}.t").alias(f"{side}_time"), F.col(f"__{side}.f").alias(f"{side}_file"),
                 F.col(f"__{side}.s").alias(f"{side}_status"),
                 *[F.col(f"__{side}.{c}").alias(f"{side}_{c}") for c in payload]]
    return out.select(*cols)
