"""Run queries in Spark and their oracle SQL in DuckDB; compare like the driver.

usage: python tools/oracle_check.py [--sf DIR] [name ...]
Compares row count, column names, types (loosely) and an order-insensitive
multiset of normalised rows. Prints one line per query and a summary.
"""

from __future__ import annotations

import argparse
import datetime as dt
import decimal
import math
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import duckdb  # noqa: E402

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings "
          "pages benchmark labels conversations").split()


def norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return None
        return round(v, 6)
    if isinstance(v, decimal.Decimal):
        return round(float(v), 6)
    if hasattr(v, "to_pydatetime"):
        v = v.to_pydatetime()
    if isinstance(v, dt.datetime):
        return v.isoformat(sep=" ")
    if isinstance(v, dt.date):
        return v.isoformat()
    if hasattr(v, "item"):
        return norm(v.item())
    if isinstance(v, bool):
        return int(v)
    if isinstance(v, (list, tuple)):
        return tuple(norm(x) for x in v)
    return v


def spark_to_duck_type(t: str) -> str:
    t = t.lower()
    simple = {"bigint": "BIGINT", "int": "INTEGER", "smallint": "SMALLINT", "tinyint": "TINYINT",
              "double": "DOUBLE", "float": "FLOAT", "string": "VARCHAR", "boolean": "BOOLEAN",
              "timestamp_ntz": "TIMESTAMP", "timestamp": "TIMESTAMP WITH TIME ZONE", "date": "DATE"}
    if t in simple:
        return simple[t]
    if t.startswith("decimal"):
        return t.upper().replace(" ", "")
    return t.upper()


def type_diffs(sdf, res):
    duck = {d[0]: str(d[1]).upper().replace(" ", "") for d in res.description}
    out = []
    for f in sdf.schema.fields:
        want = spark_to_duck_type(f.dataType.simpleString()).replace(" ", "")
        got = duck.get(f.name, "?")
        if want != got:
            out.append(f"{f.name}:{f.dataType.simpleString()}/{got}")
    return out


def rows_of(cols, records):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    out = [tuple(norm(r[i]) for i in order) for r in records]
    return sorted(out, key=lambda t: tuple((x is None, str(type(x)), x if x is not None else 0) for x in t))


def main():
    ap = argparse.ArgumentParser()
    ap.add_argument("--sf", default="/root/testdata/sf0.01")
    ap.add_argument("--tz", default=None, help="session time zone to run Spark under")
    ap.add_argument("--ansi", default=None, help="true/false for spark.sql.ansi.enabled")
    ap.add_argument("names", nargs="*")
    a = ap.parse_args()
    from docket.plans import all_oracles, all_queries
    from docket.session import local_test_session
    spark = local_test_session()
    if a.tz:
        spark.conf.set("spark.sql.session.timeZone", a.tz)
    if a.ansi:
        spark.conf.set("spark.sql.ansi.enabled", a.ansi)
    qs, orc = all_queries(), all_oracles()
    con = duckdb.connect()
    for t in TABLES:
        p = f"{a.sf}/{t}.parquet"
        if os.path.exists(p):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    names = a.names or sorted(qs)
    bad = []
    for n in names:
        t0 = time.time()
        try:
            df = qs[n](spark, a.sf)
            srows = [tuple(r) for r in df.collect()]
            scols = df.columns
            st = time.time() - t0
            if n not in orc:
                print(f"{n:32s} rows-only  spark_rows={len(srows)} {st:.1f}s")
                continue
            res = con.execute(orc[n])
            dcols = [d[0] for d in res.description]
            drows = res.fetchall()
            msg = []
            if sorted(scols) != sorted(dcols):
                msg.append(f"cols spark={sorted(scols)} duck={sorted(dcols)}")
            elif len(srows) != len(drows):
                msg.append(f"rows spark={len(srows)} duck={len(drows)}")
            else:
                a1, b1 = rows_of(scols, srows), rows_of(dcols, drows)
                if a1 != b1:
                    diffs = [(x, y) for x, y in zip(a1, b1) if x != y][:3]
                    msg.append(f"values differ, cols={sorted(scols)} e.g. {diffs}")
            td = type_diffs(df, res)
            if td:
                msg.append("types " + ",".join(td))
            status = "OK " if not msg else "BAD"
            if msg:
                bad.append(n)
            print(f"{n:32s} {status} rows={len(srows)} {st:.1f}s {' '.join(msg)[:1500]}")
        except Exception as e:  # report and continue
            bad.append(n)
            print(f"{n:32s} ERR {type(e).__name__}: {str(e)[:1500]}")
    print(f"SUMMARY {len(names) - len(bad)}/{len(names)} ok; bad={bad}")
    spark.stop()


if __name__ == "__main__":
    main()
