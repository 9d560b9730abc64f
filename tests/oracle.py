"""Compare registered queries with their SQL in DuckDB: ``python tests/oracle.py [sf] [name…]``."""

from __future__ import annotations

import math
import os
import sys
import time
from collections import Counter

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _value(v):
    if isinstance(v, float):
        return None if math.isnan(v) else float(f"{v:.12g}")
    return v


_TYPES = {"bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR", "boolean": "BOOLEAN"}


def type_differences(con, df, sql):
    """Columns whose types differ between Spark and DuckDB."""
    ours = {c: _TYPES.get(t, t) for c, t in df.dtypes}
    theirs = {r[0]: r[1] for r in con.execute(f"DESCRIBE {sql}").fetchall()}
    return [f"{c}: {ours.get(c)} != {theirs.get(c)}" for c in sorted({*ours, *theirs}) if ours.get(c) != theirs.get(c)]


def spark_rows(df):
    names = sorted(df.columns)
    return names, Counter(tuple(_value(r[n]) for n in names) for r in df.collect())


def sql_rows(con, sql):
    cur = con.execute(sql)
    cols = [d[0] for d in cur.description]
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    rows = Counter(tuple(_value(r[i]) for i in order) for r in cur.fetchall())
    return sorted(cols), rows


def differences(con, spark, name, sf_dir):
    """Empty when the query and its SQL agree on names and rows."""
    from changeloom.plans import QUERIES

    q = QUERIES[name]
    df = q.plan(spark, sf_dir)
    names, got = spark_rows(df)
    if q.sql is None:
        return [] if sum(got.values()) else ["no rows"]
    wanted_names, wanted = sql_rows(con, q.sql)
    if names != wanted_names:
        return [f"columns {names} != {wanted_names}"]
    out = type_differences(con, df, q.sql)
    if got != wanted:
        extra, missing = got - wanted, wanted - got
        out.append(f"{sum(got.values())} rows, {sum(wanted.values())} wanted; "
                   f"{sum(extra.values())} extra, {sum(missing.values())} missing")
        out += [f"  + {r}" for r in list(extra)[:3]] + [f"  - {r}" for r in list(missing)[:3]]
    if not got:
        out.append("no rows")
    return out


if __name__ == "__main__":
    from changeloom.plans import QUERIES
    from changeloom.session import build_session

    sf = f"/root/testdata/{sys.argv[1] if len(sys.argv) > 1 else 'sf0.01'}"
    spark = build_session(
        master="local[8]", **{"spark.sql.shuffle.partitions": "8", "spark.ui.enabled": "false"}
    )
    spark.sparkContext.setLogLevel("ERROR")
    con, bad = connect(sf), 0
    for name in sys.argv[2:] or QUERIES:
        began = time.time()
        try:
            diff = differences(con, spark, name, sf)
        except Exception as e:  # noqa: BLE001 - report and go on
            diff = [f"{type(e).__name__}: {str(e)[:1500]}"]
        bad += bool(diff)
        print(f"{'BAD' if diff else 'ok '} {name} {time.time() - began:.2f}s", *diff, sep="\n" if diff else " ", flush=True)
    print(f"{bad} bad")
