"""Event reconciliation (O-20 .. O-27)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docket.functions.scan import KeyedScan, null_safe_join
from docket.functions.text import ci
from docket.operators.latest import latest_per_key
from docket.operators.rules import is_late


def _cols(xs):
    return [F.col(x) if isinstance(x, str) else x for x in xs]


def asof_attribute(events: DataFrame, anchors: DataFrame, keys: Sequence[str],
                   event_time: str, anchor_time: str, event_cols: Sequence[str],
                   anchor_cols: Sequence[str],
                   strict: bool = True, direction: str = "backward") -> DataFrame:
    """As-of join (O-20): each event gets the latest earlier anchor of its key.

    ``strict`` means ``anchor_time < event_time`` (else ``<=``); ``direction``
    ``forward`` gives the earliest later anchor instead. Among anchors at the
    same time the largest (backward) / smallest (forward) ``anchor_cols`` wins.
    An anchor or event without a time matches nothing (NULL is not before anything).
    Plan: union both sides and scan them in time order (``KeyedScan``): no range
    join, and a hot key is spread over its ranges. Output: keys, event_cols, anchor_cols prefixed
    ``anchor_`` (NULL when there is no anchor).
    """
    if direction not in ("backward", "forward"):
        raise ValueError(direction)
    # At equal time the scan must not see excluded anchors: order the sides.
    anchors_first = (direction == "backward") != strict
    ev_side, an_side = (1, 0) if anchors_first else (0, 1)
    a_struct = F.struct(*_cols(anchor_cols))
    e_struct = F.struct(*_cols(event_cols))
    a_type = anchors.select(a_struct.alias("a")).schema["a"].dataType
    e_type = events.select(e_struct.alias("e")).schema["e"].dataType
    ev = events.select(*keys, F.col(event_time).alias("__t"), F.lit(ev_side).alias("__side"),
                       e_struct.alias("__e"), F.lit(None).cast(a_type).alias("__a"))
    an = anchors.filter(F.col(anchor_time).isNotNull()).select(*keys, F.col(anchor_time).alias("__t"), F.lit(an_side).alias("__side"),
                        F.lit(None).cast(e_type).alias("__e"), a_struct.alias("__a"))
    scan = KeyedScan(list(keys), ["__t", "__side", "__a", "__e"])
    x = scan.prepare(ev.unionByName(an))
    is_anchor = F.col("__a").isNotNull()
    if direction == "backward":
        x = scan.last_before(x, is_anchor, F.col("__a"), "__hit")
    else:
        x = scan.first_after(x, is_anchor, F.col("__a"), "__hit")
    x = scan.finish(x).filter(F.col("__e").isNotNull())
    x = x.withColumn("__hit", F.when(F.col("__t").isNotNull(), F.col("__hit")))
    return x.select(*keys, *[F.col(f"__e.{c}").alias(c) for c in event_cols],
                    *[F.col(f"__hit.{c}").alias(f"anchor_{c}") for c in anchor_cols])


# Decision wording (status naming) used by the event fold.
DECISION_WORDING = {"Accepted": "Granted", "Rejected": "Refused"}


def event_state(events: DataFrame, key: str, time: str, id_col: str, type_col: str,
                submit_type: str, decision_type: str, resubmit_type: str,
                decision: Column) -> DataFrame:
    """Fold a typed event log into current state per key (O-21).

    One ``groupBy(key)`` with conditional min/max/max_by replaces the reference's
    six self-joins; partial aggregation keeps a hot key cheap.
    Rules: decision wording Accepted->Granted, Rejected->Refused; status is
    Pending when the newest submission is later than the newest decision, else
    the newest decision, else Pending; granted = oldest granted decision;
    resubmission status: NULL without a resubmission, else the newest decision
    at or after the newest resubmission, else Pending.
    """
    t, ty = F.col(time), F.col(type_col)
    word = decision
    for raw, shown in DECISION_WORDING.items():
        word = F.when(ci(decision) == raw.lower(), F.lit(shown)).otherwise(word)
    is_sub, is_dec, is_res = ty == submit_type, ty == decision_type, ty == resubmit_type
    ordering = F.struct(t, F.col(id_col))
    agg = events.groupBy(key).agg(
        F.min(F.when(is_sub, t)).alias("first_submit_ts"),
        F.max(F.when(is_sub, t)).alias("latest_submit_ts"),
        F.count(F.when(is_sub, 1)).alias("n_submits"),
        F.max(F.when(is_dec, t)).alias("latest_decision_ts"),
        F.max_by(F.when(is_dec, word), F.when(is_dec, ordering)).alias("latest_decision"),
        F.count(F.when(is_dec, 1)).alias("n_decisions"),
        F.min(F.when(is_dec & (word == "Granted"), t)).alias("first_granted_ts"),
        F.max(F.when(is_res, t)).alias("latest_resubmit_ts"),
    )
    status = (F.when(F.col("latest_decision_ts").isNull(), F.lit("Pending"))
              .when(F.col("latest_submit_ts") > F.col("latest_decision_ts"), F.lit("Pending"))
              .otherwise(F.col("latest_decision")))
    resub = (F.when(F.col("latest_resubmit_ts").isNull(), F.lit(None).cast("string"))
             .when(F.col("latest_decision_ts") >= F.col("latest_resubmit_ts"), F.col("latest_decision"))
             .otherwise(F.lit("Pending")))
    return agg.withColumn("status", status).withColumn("resubmission_status", resub)


def file_decision_status(files: DataFrame, submission: str, decision: Column, decided_at: str,
                         cancel: Column, pending: Column, year: Column,
                         rename_from_year: int) -> DataFrame:
    """Status per file (O-22).

    ``decision`` is 'Accepted'/'Rejected'/NULL per file; a cancelling file
    cancels its whole submission; undecided files inherit the newest decision of
    a sibling; Accepted is named Granted from ``rename_from_year`` on; files
    with no decision anywhere are Pending (``pending``) or Uploaded.
    Per-submission facts come from one partial aggregate joined back.
    """
    f = files.withColumn("__dec", decision).withColumn("__cancel", cancel)
    sub = f.groupBy(submission).agg(
        F.max(F.col("__cancel").cast("int")).alias("__sub_cancel"),
        F.max_by(F.col("__dec"), F.when(F.col("__dec").isNotNull(),
                                        F.struct(F.col(decided_at), F.col("__dec")))).alias("__sub_dec"))
    f = f.join(sub, submission, "left")
    eff = F.coalesce(F.col("__dec"), F.col("__sub_dec"))
    named = F.when((ci(eff) == "accepted") & (year >= rename_from_year), F.lit("Granted")) \
             .when((ci(eff) == "rejected") & (year >= rename_from_year), F.lit("Refused")).otherwise(eff)
    status = (F.when(F.col("__sub_cancel") == 1, F.lit("Cancelled"))
              .when(eff.isNotNull(), named)
              .when(pending, F.lit("Pending"))
              .otherwise(F.lit("Uploaded")))
    return f.withColumn("status", status).drop("__dec", "__cancel", "__sub_cancel", "__sub_dec")


def prior_stats(df: DataFrame, keys: Sequence[str], order: Sequence[str],
                counts: dict[str, Column], lasts: dict[str, tuple[Column, Column]],
                pending: Column | None = None, newest: Column | None = None) -> DataFrame:
    """Per row, statistics over strictly earlier rows of its key (O-23).

    ``counts``: name -> condition, number of earlier rows meeting it.
    ``lasts``: name -> (condition, value), value of the latest earlier row meeting it.
    ``pending``: rows of this kind are kept only when they are the newest of
    their key (``newest`` = the ordering expression compared with its max).
    Replaces correlated TOP 1 / COUNT subqueries with a bucketed keyed scan.
    """
    scan = KeyedScan(list(keys), list(order))
    x = scan.finish(scan.run(scan.prepare(df), counts=counts, lasts=lasts))
    if pending is not None:
        nv = newest if newest is not None else F.struct(*_cols(order))
        x = x.withColumn("__nv", nv)
        mx = x.groupBy(*keys).agg(F.max("__nv").alias("__mx"))
        x = null_safe_join(x, mx, list(keys)).filter(~pending | F.col("__nv").eqNullSafe(F.col("__mx"))) \
             .drop("__nv", "__mx")
    return x


def resubmission_split(df: DataFrame, key: str, time: str, type_col: str, marker: str,
                       upload: str) -> DataFrame:
    """Label uploads before the first marker event of their key 'original', later ones
    'resubmission' (O-24). The first marker per key is a partial aggregate."""
    first = df.filter(F.col(type_col) == marker).groupBy(key).agg(F.min(time).alias("__first_marker"))
    up = df.filter(F.col(type_col) == upload).join(first, key, "left")
    kind = F.when(F.col("__first_marker").isNotNull() & (F.col(time) > F.col("__first_marker")),
                  F.lit("resubmission")).otherwise(F.lit("original"))
    return up.withColumn("kind", kind).drop("__first_marker")


def audit_history(df: DataFrame, entity: str, time: str, id_col: str, json_col: str,
                  path: str) -> DataFrame:
    """Version history from JSON audit payloads (O-25).

    One row per (entity, value) with first/last seen and count, and whether it
    is the entity's current value (value of its latest audit row).
    """
    v = df.withColumn("value", F.get_json_object(F.col(json_col), path)).filter(F.col("value").isNotNull())
    hist = v.groupBy(entity, "value").agg(F.min(time).alias("first_seen"), F.max(time).alias("last_seen"),
                                          F.count(F.lit(1)).alias("n_versions"))
    cur = v.groupBy(entity).agg(F.max_by("value", F.struct(time, id_col)).alias("__cur"))
    return (hist.join(cur, entity, "left")
                .withColumn("is_current", F.col("value") == F.col("__cur")).drop("__cur"))


def size_deadline(size: Column, year: Column, large_from: int) -> Column:
    """Deadline by size and year, for any year: small 2 April of the year; large 2 October of
    the year before from ``large_from`` on, else 2 April."""
    april = F.make_date(year, F.lit(4), F.lit(2))
    large = F.when(year >= large_from, F.make_date(year - 1, F.lit(10), F.lit(2))).otherwise(april)
    return F.when(size == "large", large).when(size == "small", april)


def deadline_flags(df: DataFrame, keys: Sequence[str], time: str, size: Column,
                   large_from: int) -> DataFrame:
    """Late / on time from the first submission vs the deadline by size and year (O-26).

    The deadline is a formula of size and year (``size_deadline``): no calendar
    table, no range of years.
    """
    x = df.withColumn("size", size).withColumn("year", F.year(time))
    first = x.groupBy(*keys, "size", "year").agg(F.min(time).alias("first_submission"))
    out = first.withColumn("deadline", size_deadline(F.col("size"), F.col("year"), large_from))
    return out.withColumn("is_late", F.col("first_submission") >= F.col("deadline"))


def upload_bundle(files: DataFrame, members: DataFrame, key: str, set_id: str,
                  order: Sequence[Column], member_type: str, types: Sequence[str],
                  measure: str) -> DataFrame:
    """Latest set per key with per-type member counts and sums and the sorted
    list of member types present (O-27). Types are fixed -> fused conditional sums."""
    latest = latest_per_key(files, [key], order).select(key, set_id)
    m = members.join(latest, set_id, "inner")
    aggs = []
    for t in types:
        aggs.append(F.count(F.when(F.col(member_type) == t, 1)).alias(f"n_{t}"))
        aggs.append(F.round(F.sum(F.when(F.col(member_type) == t, F.col(measure))), 2).alias(f"sum_{t}"))
    aggs.append(F.array_join(F.array_sort(F.collect_set(member_type)), ",").alias("member_types"))
    bundled = m.groupBy(key, set_id).agg(*aggs)
    out = latest.join(bundled, [key, set_id], "left")
    return out.fillna(0, subset=[f"n_{t}" for t in types])


def registration_state(events: DataFrame, key: str, time: str, id_col: str, type_col: str, file_col: str,
                       decision: str, is_resub: Column, upload_type: str, application_type: str,
                       decision_type: str, user: str | None = None, comment: str | None = None,
                       cutoffs: DataFrame | None = None) -> DataFrame:
    """Registration fold with file attribution and resubmissions (O-21, S3).

    * newest copy per (key, event id) is kept;
    * the file of an application is the newest upload strictly before it (as-of, ``<``);
    * a decision without a file is a registration decision, worded
      Accepted->Granted, Rejected->Refused, NULL->Pending; a decision with a file
      is a resubmission decision on that file (NULL->Pending, else as is);
    * first application = oldest non-resubmission application; initial
      application = the newest one (the reference's naming); latest
      resubmission = newest resubmission application;
    * status: Pending when the newest application is later than the newest
      decision, else that decision, else the newest Granted, else Pending;
    * resubmission status: NULL without a resubmission, else the newest
      decision on the latest resubmission's file, else Pending.

    With ``user`` and ``comment`` (columns of the log) come the coalesced items: the current file and the
    producer's user are the resubmission's, else the initial application's; the regulator's user and comment
    are those of the decision on the resubmitted file, else of the latest decision; the two comments of the
    producer stand apart. A part that is NULL falls to the next one, each item by itself.
    With ``cutoffs`` (key, ``cutoff``; a row per key) come the late items: the first application, and the
    resubmission, at or after the cutoff; false without a cutoff or a time.

    One dedupe aggregate, one as-of scan, one fold aggregate and one (key, file)
    aggregate joined back.
    """
    said = [c for c in (user, comment) if c]
    cols = [time, type_col, file_col, decision, "__resub", *said]
    x = events.withColumn("__resub", F.coalesce(is_resub, F.lit(False)))
    x = (x.groupBy(key, id_col).agg(F.max(F.struct(*[F.col(c) for c in cols])).alias("__r"))
          .select(key, id_col, *[F.col(f"__r.{c}").alias(c) for c in cols]))
    uploads = x.filter(F.col(type_col) == upload_type)
    others = x.filter(F.col(type_col).isin(application_type, decision_type))
    att = asof_attribute(others, uploads, [key], time, time, [id_col, *cols], [time, id_col, file_col], strict=True)
    ty, t = F.col(type_col), F.col(time)
    app = ty == application_type
    dec = ty == decision_type
    reg_dec = dec & F.col(file_col).isNull()
    res_dec = dec & F.col(file_col).isNotNull()
    raw = ci(F.trim(F.col(decision)))
    wording = (F.when(raw == "accepted", F.lit("Granted")).when(raw == "rejected", F.lit("Refused"))
               .when(F.col(decision).isNull(), F.lit("Pending")).otherwise(F.col(decision)))
    res_wording = F.coalesce(F.col(decision), F.lit("Pending"))
    at = [t.alias("t"), F.col(id_col).alias("id")]
    app_rec = F.struct(*at, F.col(f"anchor_{file_col}").alias("file"), *said)
    agg = att.groupBy(key).agg(
        F.min(F.when(app & ~F.col("__resub"), app_rec)).alias("__first"),
        F.max(F.when(app & ~F.col("__resub"), app_rec)).alias("__initial"),
        F.max(F.when(app & F.col("__resub"), app_rec)).alias("__resub_app"),
        F.max(F.when(reg_dec, F.struct(*at, wording.alias("w"), *said))).alias("__dec"),
        F.max(F.when(reg_dec & (wording == "Granted"), t)).alias("granted_time"),
        F.max(F.when(app, t)).alias("__last_app_t"))
    # resubmission decisions carry their own file: no as-of needed, so read them from the deduped log
    rdec = (x.filter(res_dec).groupBy(F.col(key).alias("__rkey"), F.col(file_col).alias("__rfile"))
               .agg(F.max(F.struct(*at, res_wording.alias("w"), *said)).alias("__rd")))
    out = agg.join(rdec, (F.col(key) == F.col("__rkey")) & (F.col("__resub_app.file") == F.col("__rfile")), "left")
    status = (F.when(F.col("__last_app_t") > F.col("__dec.t"), F.lit("Pending"))
              .when(F.col("__dec").isNotNull(), F.col("__dec.w"))
              .when(F.col("granted_time").isNotNull(), F.lit("Granted"))
              .otherwise(F.lit("Pending")))
    resub_status = (F.when(F.col("__resub_app").isNull(), F.lit(None).cast("string"))
                    .when(F.col("__rd").isNotNull(), F.col("__rd.w")).otherwise(F.lit("Pending")))
    items = [F.coalesce("__resub_app.file", "__initial.file").alias("current_file")] if said else []
    if user:
        items += [F.coalesce(f"__resub_app.{user}", f"__initial.{user}").alias("producer_user"),
                  F.coalesce(f"__rd.{user}", f"__dec.{user}").alias("regulator_user")]
    if comment:
        items += [F.col(f"__initial.{comment}").alias("application_comment"), F.col(f"__resub_app.{comment}").alias("resubmission_comment"),
                  F.coalesce(f"__rd.{comment}", f"__dec.{comment}").alias("regulator_comment")]
    if cutoffs is not None:
        out = null_safe_join(out, cutoffs.select(key, F.col("cutoff").alias("__cutoff")), [key])
        items += [is_late(F.col("__first.t"), F.col("__cutoff")).alias("late"),
                  is_late(F.col("__resub_app.t"), F.col("__cutoff")).alias("resubmission_late")]
    return out.select(
        key,
        F.col("__first.t").alias("first_application_time"), F.col("__first.file").alias("first_application_file"),
        F.col("__initial.t").alias("initial_application_time"),
        F.col("__initial.file").alias("initial_application_file"),
        F.col("__resub_app.t").alias("resubmission_time"), F.col("__resub_app.file").alias("resubmission_file"),
        F.col("__dec.t").alias("latest_decision_time"), F.col("__dec.w").alias("latest_decision"),
        "granted_time", status.alias("status"), resub_status.alias("resubmission_status"), *items)


def audit_versions(audit: DataFrame, old: str, new: str, fields: dict[str, str]) -> DataFrame:
    """Every version that an audit log shows of its entities (O-25): the old and the new payload
    of each row, taken apart by JSON path, distinct. One pass; NULL payloads show nothing."""
    payload = F.explode(F.filter(F.array(old, new), lambda p: p.isNotNull()))
    x = audit.select(payload.alias("__p"))
    return x.select(*[F.get_json_object("__p", path).alias(n) for n, path in fields.items()]).distinct()


def latest_actor(audit: DataFrame, entity: str, order: Sequence[str], actor: str, people: DataFrame,
                 person: str, name_cols: Sequence[str]) -> DataFrame:
    """Who touched each entity last (O-25): the actor of the newest audit row that has one, with
    the person's name (parts joined by blanks, missing ones left out; '' when unknown)."""
    newest = audit.filter(F.col(actor).isNotNull()).groupBy(entity).agg(
        F.max_by(actor, F.struct(*_cols(order))).alias("actor"))
    names = people.select(F.col(person).alias("__p"), F.trim(F.concat_ws(" ", *[F.trim(F.col(c)) for c in name_cols])).alias("actor_name"))
    return newest.join(names, F.col("actor") == F.col("__p"), "left").drop("__p") \
                 .withColumn("actor_name", F.coalesce("actor_name", F.lit("")))


def upload_files(files: DataFrame, keys: Sequence[str], set_id: str, order: Sequence[str], type_col: str,
                 types: Sequence[str], file_cols: Sequence[str]) -> DataFrame:
    """Latest set per ``keys`` (organisation, period, scheme) with its file columns by type and the
    sorted list of its types (O-27).

    A set's newest file of a type gives that type's columns. One aggregation to sets, one to keys;
    the newest set is that of the newest ``order``, then the largest id.
    """
    rank = F.struct(*_cols(order))
    payload = F.struct(*_cols(file_cols))
    per_type = [F.max_by(payload, F.when(ci(type_col) == t.lower(), rank)).alias(f"__{t}") for t in types]
    # the set of types is bounded by the type's domain
    sets = files.groupBy(*keys, set_id).agg(F.max(rank).alias("__at"), F.array_join(F.array_sort(F.collect_set(type_col)), ",").alias("types"), *per_type)
    newest = sets.groupBy(*keys).agg(F.max(F.struct("__at", set_id, "types", *[f"__{t}" for t in types])).alias("__s"))
    return newest.select(*keys, F.col(f"__s.{set_id}").alias(set_id), F.col("__s.types").alias("types"),
                         *[F.col(f"__s.__{t}.{c}").alias(f"{t.lower()}_{c}") for t in types for c in file_cols])
