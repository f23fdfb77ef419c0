"""Run registered queries next to their SQL oracles and compare them.

    python tests/oracle_check.py [sf_dir] [name ...]
"""

from __future__ import annotations

import os
import sys
import tempfile
import time

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    return con


def normal_rows(rows: list[tuple]) -> list[tuple]:
    return sorted((tuple(r) for r in rows), key=lambda r: tuple((v is None, str(v)) for v in r))


def compare(spark, con, fn, sql: str, sf_dir: str) -> str:
    """Empty when names, row counts and all values agree exactly."""
    df = fn(spark, sf_dir)
    cols = sorted(df.columns)
    got = normal_rows(df.select(*cols).collect())
    rel = con.sql(sql)
    if sorted(rel.columns) != cols:
        return f"columns {cols} vs {sorted(rel.columns)}"
    want = normal_rows(rel.select(*[f'"{c}"' for c in cols]).fetchall())
    if len(got) != len(want):
        return f"rows {len(got)} vs {len(want)}"
    bad = [(g, w) for g, w in zip(got, want) if g != w]
    if bad:
        return f"{len(bad)} of {len(got)} rows differ, e.g. {bad[0]}"
    kinds = [(c, type(a), type(b)) for c, a, b in zip(cols, got[0], want[0]) if type(a) is not type(b)] if got else []
    return f"types {kinds}" if kinds else ""


def main() -> int:
    import __spark_entry__ as e
    from adtide.session import build_session

    args = sys.argv[1:]
    sf_dir = args[0] if args else "/root/testdata/sf0.01"
    spark = build_session(
        spark__checkpoint__dir=tempfile.mkdtemp(prefix="oracle-"),
        spark__master="local[8]", spark__sql__shuffle__partitions="8", spark__driver__memory="12g",
        spark__ui__enabled="false", spark__ui__showConsoleProgress="false",
    )
    spark.sparkContext.setLogLevel("ERROR")
    con, failed = connect(sf_dir), 0
    oracles = e.oracle_sql()
    for name, fn in e.queries().items():
        if args[1:] and name not in args[1:]:
            continue
        start = time.time()
        try:
            if name in oracles:
                out = compare(spark, con, fn, oracles[name], sf_dir)
            else:
                out = "" if fn(spark, sf_dir).count() else "no rows"
        except Exception as exc:  # noqa: BLE001
            out = f"{type(exc).__name__}: {str(exc)[:600]}"
        failed += bool(out)
        print(f"{'FAIL' if out else 'ok  '} {name:24s} {time.time() - start:6.2f}s {out}", flush=True)
    print("failed:", failed)
    return failed


if __name__ == "__main__":
    sys.exit(1 if main() else 0)
