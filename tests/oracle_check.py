"""Run every registered query and its SQL on the same tables and compare the rows."""

from __future__ import annotations

import math
import sys
import time
from pathlib import Path

import duckdb

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    return con


def _key(value) -> str:
    if isinstance(value, float) and not math.isnan(value):
        return f"{value:.6f}"
    return repr(value)


def compare(spark, con, sf_dir: str, fn, sql: str) -> str:
    """Empty string if the rows agree, else what differs."""
    df = fn(spark, sf_dir)
    got_cols = sorted(df.columns)
    got = sorted(tuple(_key(r[c]) for c in got_cols) for r in df.collect())
    cur = con.execute(sql)
    names = [d[0] for d in cur.description]
    order = [names.index(c) for c in sorted(names)]
    want = sorted(tuple(_key(r[i]) for i in order) for r in cur.fetchall())
    if got_cols != sorted(names):
        return f"columns {got_cols} != {sorted(names)}"
    if len(got) != len(want):
        return f"rows {len(got)} != {len(want)}"
    bad = [(g, w) for g, w in zip(got, want) if g != w]
    if bad:
        return f"{len(bad)} of {len(got)} rows differ, first:\n  spark {bad[0][0]}\n  sql   {bad[0][1]}"
    return ""


def main() -> None:
    import __spark_entry__ as contract
    from casemill import build_session

    queries, oracle = contract.queries(), contract.oracle_sql()
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    only = sys.argv[2:]
    spark = build_session(master="local[8]", spark__sql__shuffle__partitions="8", spark__ui__enabled="false", spark__driver__memory="8g")
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(sf_dir)
    failed = []
    for name, fn in queries.items():
        if only and name not in only:
            continue
        started = time.perf_counter()
        try:
            if name in oracle:
                problem = compare(spark, con, sf_dir, fn, oracle[name])
            else:
                problem = "" if fn(spark, sf_dir).count() else "no rows"
        except Exception as exc:  # noqa: BLE001 - reported per query
            problem = f"{type(exc).__name__}: {str(exc)[:1500]}"
        print(f"{'ok  ' if not problem else 'FAIL'} {name} {time.perf_counter() - started:.1f}s {problem}", flush=True)
        if problem:
            failed.append(name)
    print(f"{len(failed)} failed: {' '.join(failed)}")


if __name__ == "__main__":
    main()
