"""Every registered query vs its DuckDB oracle on the smallest test tables."""

import os
import sys

import duckdb
import pytest

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "tools"))
from oracle_check import TABLES, rows_of, type_diffs  # noqa: E402

from docket.plans import all_oracles, all_queries  # noqa: E402

QUERIES = all_queries()
ORACLES = all_oracles()


@pytest.fixture(scope="module")
def duck(sf_small):
    con = duckdb.connect()
    for t in TABLES:
        p = f"{sf_small}/{t}.parquet"
        if os.path.exists(p):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return con


def test_every_query_registered_with_oracle_or_marked():
    rows_only = set(QUERIES) - set(ORACLES)
    assert not rows_only, rows_only
    assert set(ORACLES) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, duck, sf_small, name):
    df = QUERIES[name](spark, sf_small)
    rows = [tuple(r) for r in df.collect()]
    if name not in ORACLES:
        assert len(rows) > 0
        return
    res = duck.execute(ORACLES[name])
    cols = [d[0] for d in res.description]
    assert sorted(df.columns) == sorted(cols)
    assert type_diffs(df, res) == []
    assert rows_of(df.columns, rows) == rows_of(cols, res.fetchall())
