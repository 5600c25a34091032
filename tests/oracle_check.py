"""Run registered queries beside their SQL and compare. ``python tests/oracle_check.py [sf_dir] [name ...]``"""

from __future__ import annotations

import math
import os
import sys
import time

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    return con


def cell(x):
    if x is None or (isinstance(x, float) and math.isnan(x)):
        return (0, "")
    if isinstance(x, bool):
        return (1, x)
    if isinstance(x, (int, float)):
        return (2, float(x))
    return (3, str(x))


def rows(cols: list[str], data: list[tuple]) -> list[tuple]:
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted(tuple(cell(r[i]) for i in order) for r in data)


def same(a: list[tuple], b: list[tuple]) -> str:
    """'' if equal, else what differs."""
    if len(a) != len(b):
        return f"{len(a)} rows, expected {len(b)}"
    if a == b:
        return ""
    near = 0
    for x, y in zip(a, b):
        if x == y:
            continue
        for u, v in zip(x, y):
            if u != v and not (u[0] == v[0] == 2 and math.isclose(u[1], v[1], rel_tol=1e-9, abs_tol=1e-12)):
                return f"row {x} expected {y}"
        near += 1
    return f"near: {near} rows differ in the last digits"


def compare(spark, con, name: str, query, sql: str, sf_dir: str) -> str:
    df = query(spark, sf_dir)
    got = df.collect()
    res = con.execute(sql)
    want_cols = [x[0] for x in res.description]
    want = res.fetchall()
    if sorted(df.columns) != sorted(want_cols):
        return f"columns {sorted(df.columns)} expected {sorted(want_cols)}"
    return same(rows(df.columns, [tuple(r) for r in got]), rows(want_cols, want))


if __name__ == "__main__":
    from tidemark import make_session
    from tidemark.plans import registry

    folder = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    names = sys.argv[2:] or list(registry.QUERIES)
    session = make_session(
        "check", "local[8]", **{"spark.sql.shuffle.partitions": "8", "spark.ui.enabled": "false", "spark.driver.memory": "8g"}
    )
    session.sparkContext.setLogLevel("ERROR")
    db = connect(folder)
    bad = 0
    for n in names:
        start = time.time()
        try:
            if n in registry.ORACLES:
                result = compare(session, db, n, registry.QUERIES[n], registry.ORACLES[n], folder)
            else:
                result = f"no SQL, {len(registry.QUERIES[n](session, folder).collect())} rows"
        except Exception as err:  # noqa: BLE001
            result = f"ERROR {type(err).__name__}: {str(err)[:600]}"
        mark = "ok " if result == "" or result.startswith("no SQL") else "BAD"
        bad += mark == "BAD"
        print(f"{mark} {time.time() - start:6.2f}s {n} {result}", flush=True)
    print(f"{len(names) - bad}/{len(names)} agree")
