"""Rule compositions: late fees, compliance flags, scheme totals, next year's population, the
compliance grid (parts of O-26, O-42, O-47, O-48, O-57)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docket.functions.scan import null_safe_join

SMALL_PRODUCER_LIMIT_KG = 50_000


def journey_cutoff(journey: Column, size: Column, is_scheme: Column, large: Column, small: Column) -> Column:
    """The cutoff a submission is held against (O-26): by the journey's producer size, else by
    the organisation's size, else the large one for schemes; NULL when none applies."""
    j, s = F.lower(journey), F.trim(size)
    return (F.when(j.endswith("largeproducer"), large).when(j.endswith("smallproducer"), small)
            .when(s == "L", large).when(s == "S", small).when(is_scheme, large))


def is_late(decided: Column, cutoff: Column) -> Column:
    return F.coalesce(decided >= cutoff, F.lit(False))


def member_late_fee(size: Column, large: Column, small: Column, resubmitted: Column, is_new_joiner: Column,
                    resubmission_late: Column, submission_late: Column, latest_application: Column,
                    first_submission: Column, first_submitted: Column, joined: Column) -> Column:
    """Whether a member owes a late fee (O-26); the first rule that applies decides.

    1. a resubmission: a new joiner by the resubmission's lateness, others by the submission's;
    2. the latest application came before the cutoff of the member's size: no;
    3. the first submission came at or after it: every member owes;
    4. the member was submitted after the first submission: only joiners (with a date) owe;
    5. the member's size has a cutoff: by the member's first submitted date;
    6. else as the submission.
    NULL dates meet no comparison, so they fall to the next rule.
    """
    s = F.trim(size)
    cutoff = F.when(s == "L", large).when(s == "S", small)
    return (F.when(resubmitted.isNotNull(), F.when(is_new_joiner, resubmission_late).otherwise(submission_late))
            .when(latest_application < cutoff, F.lit(False))
            .when(first_submission >= cutoff, F.lit(True))
            .when(first_submitted > first_submission, joined.isNotNull())
            .when(s.isin("L", "S"), F.coalesce(first_submitted >= cutoff, F.lit(False)))
            .otherwise(submission_late))


def liability_flag(liable: Column, has_household: Column, size: Column) -> Column:
    """Compliant when a liable organisation that is not small reports household packaging, or
    one that is not liable reports none (O-57)."""
    fine = (liable & has_household & (F.coalesce(size, F.lit("")) != "S")) | (~liable & ~has_household)
    return F.when(fine, F.lit("Compliant")).otherwise(F.lit("Non Compliant"))


def small_producer_flag(weight: Column, size: Column, limit: float = SMALL_PRODUCER_LIMIT_KG) -> Column:
    """A small producer's total against the weight limit (O-57)."""
    return (F.when((size == "S") & (weight > limit), F.lit("Non Compliant"))
            .when((size == "S") & (weight <= limit), F.lit("Compliant")).otherwise(F.lit("N/A")))


def scheme_totals(members: DataFrame, scheme: str, member: str, edges: DataFrame, parent: str, child: str,
                  amounts: DataFrame, org: str, amount: str) -> DataFrame:
    """Scheme total = its own + its members' + their subsidiaries' amounts (O-47).

    Every organisation that counts for a scheme becomes a (scheme, org) pair: the scheme itself,
    its members, the members' children. Pairs are distinct, so an organisation reached twice
    counts once. One equi-join with the amounts, one aggregation.
    """
    direct = members.select(F.col(scheme).alias("scheme_id"), F.col(member).alias("__o")).distinct()
    below = direct.join(edges.select(F.col(parent).alias("__o"), F.col(child).alias("__c")), "__o").select("scheme_id", F.col("__c").alias("__o"))
    own = direct.select("scheme_id", F.col("scheme_id").alias("__o")).distinct()
    pairs = direct.unionByName(below).unionByName(own).distinct()
    per_org = amounts.groupBy(F.col(org).alias("__o")).agg(F.sum(amount).alias("__a"))
    return pairs.join(per_org, "__o", "left").groupBy("scheme_id").agg(
        F.round(F.coalesce(F.sum("__a"), F.lit(0.0)), 2).alias("total"), F.count(F.lit(1)).alias("n_orgs"))


def next_year_population(obligations: DataFrame, files: DataFrame, keys: Sequence[str], year: str, half: Column,
                         accepted: Column, order: Sequence[str]) -> DataFrame:
    """Obligation rows with the half-years their producer reported the year before (O-42).

    Per ``keys`` (organisation, subsidiary, submitter), year and half-year the latest accepted
    file counts; the flags of a year go to the obligations of the next. Keys match NULL to NULL.
    """
    x = files.withColumn("__h", half).filter(accepted)
    latest = x.groupBy(*keys, year, "__h").agg(F.max(F.struct(*[F.col(c) for c in order])).alias("__latest"))
    flags = latest.groupBy(*keys, (F.col(year) + 1).alias(year)).agg(
        F.max(F.col("__h") == 1).alias("has_h1"), F.max(F.col("__h") == 2).alias("has_h2"))
    out = null_safe_join(obligations, flags, [*keys, year])
    return out.withColumns({c: F.coalesce(c, F.lit(False)) for c in ("has_h1", "has_h2")})


def compliance_grid(facts: DataFrame, org: str, year: str, period: Column, at: str, status: str, scheme: str, order: Sequence[str],
                    deadline: Column, obligation: DataFrame) -> DataFrame:
    """Organisation x year x period: first and latest file dates, latest status, deadline met,
    latest scheme, and the year's obligation on every period (O-48).

    ``obligation``: one row per (org, year). The periods are those that occur; one aggregation per
    period, one per year for the scheme, joined.
    """
    x = facts.withColumn("period", period)
    rank = F.struct(*[F.col(c) for c in order])
    per = x.groupBy(org, year, "period").agg(F.min(at).alias("first_date"), F.max(at).alias("latest_date"), F.max_by(status, rank).alias("latest_status"),
                                             F.count(F.lit(1)).alias("n_files"))
    by_year = x.groupBy(org, year).agg(F.max_by(scheme, rank).alias("latest_scheme"))
    out = per.join(by_year, [org, year], "left").join(obligation, [org, year], "left")
    return out.withColumn("deadline", deadline).withColumn("deadline_met", F.col("first_date") <= F.col("deadline"))
