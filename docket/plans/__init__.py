"""Rebinds of every operator onto the shared test tables, with oracle SQL.

``all_queries()`` maps a query name to ``fn(spark, sf_dir) -> DataFrame``;
``all_oracles()`` maps the same names to DuckDB SQL over the same tables.
"""

from __future__ import annotations

import importlib

from docket.plans.registry import ORACLES, QUERIES

_MODULES = ["rebind_latest", "rebind_events", "rebind_conform", "rebind_shape",
            "rebind_gaps", "rebind_measures", "rebind_diff", "rebind_serve",
            "rebind_upsert", "rebind_pipeline", "rebind_rules"]


def _load():
    for m in _MODULES:
        importlib.import_module(f"docket.plans.{m}")


def all_queries():
    _load()
    return dict(QUERIES)


def all_oracles():
    _load()
    return dict(ORACLES)
