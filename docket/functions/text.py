"""Collation and NULL policy, decided once (traps T1-T4 and O-13)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(col) -> Column:
    return F.col(col) if isinstance(col, str) else col


def ci(col) -> Column:
    """Case-insensitive, trailing-blank-insensitive comparison key (T1)."""
    return F.lower(F.rtrim(_c(col)))


def ci_equals(a, b) -> Column:
    return ci(a) == ci(b)


def null_unified(col, kind: str = "string") -> Column:
    """NULL and the empty value compare equal in joins (T2): '' for text, 0 for numbers."""
    return F.coalesce(_c(col), F.lit("" if kind == "string" else 0))


def key_equals(a, b, null_keys: str = "match", kind: str = "string") -> Column:
    """Join predicate for nullable keys.

    ``match``: NULL and '' unify (T2); ``distinct``: plain equality, NULL never
    matches (T3); ``safe``: NULL matches only NULL (T4, eqNullSafe).
    """
    if null_keys == "match":
        return null_unified(a, kind) == null_unified(b, kind)
    if null_keys == "distinct":
        return _c(a) == _c(b)
    if null_keys == "safe":
        return _c(a).eqNullSafe(_c(b))
    raise ValueError(null_keys)


# Placeholder tokens that mean "missing" in free-text columns.
DEFAULT_PLACEHOLDERS = ["N/A", "NA", "NOT SET", "-", "NONE"]


def scrub_placeholders(col, tokens: list[str] | None = None, extra: tuple[str, ...] = ()) -> Column:
    """Blank or placeholder text -> NULL; other values trimmed (O-13)."""
    toks = [t.upper() for t in [*(tokens if tokens is not None else DEFAULT_PLACEHOLDERS), *extra]]
    trimmed = F.trim(_c(col))
    return F.when((trimmed == "") | F.upper(trimmed).isin(toks), F.lit(None).cast("string")) \
        .otherwise(trimmed)
