"""Run queries on Spark and their check SQL on DuckDB, and compare every value.

    python tests/compare.py /root/testdata/sf0.01 [key ...]
"""

from __future__ import annotations

import datetime as dt
import decimal
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import duckdb  # noqa: E402

SUPPLIED = ("region nation customer supplier part orders lineitem events documents embeddings pages benchmark "
            "labels conversations").split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for name in SUPPLIED:
        path = f"{sf_dir}/{name}.parquet"
        if os.path.exists(path):
            con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return con


def plain(v):
    if isinstance(v, decimal.Decimal):
        return float(v)
    if isinstance(v, dt.datetime):
        return v.replace(tzinfo=None)
    return v


def normal(rows, names):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted((tuple(plain(r[i]) for i in order) for r in rows), key=repr)


def difference(spark_df, con, sql: str) -> str | None:
    """None if both give the same columns and values, else what differs."""
    got = normal(spark_df.collect(), spark_df.columns)
    cur = con.execute(sql)
    names = [d[0] for d in cur.description]
    want = normal(cur.fetchall(), names)
    if sorted(names) != sorted(spark_df.columns):
        return f"columns {sorted(set(names) ^ set(spark_df.columns))}"
    if len(got) != len(want):
        return f"rows {len(got)} vs {len(want)}"
    for g, w in zip(got, want):
        if g != w or [type(x) for x in g] != [type(x) for x in w]:
            return f"first difference:\n  spark  {g}\n  oracle {w}"
    return None if got else "no rows"


def main() -> int:
    from __spark_entry__ import oracle_sql, queries
    from carepulse.session import local_session

    sf_dir, keys = sys.argv[1], sys.argv[2:]
    spark, con = local_session(), connect(sf_dir)
    checks, failed = oracle_sql(), 0
    for key, run in queries().items():
        if keys and key not in keys:
            continue
        started = time.time()
        try:
            result = run(spark, sf_dir)
            wrong = difference(result, con, checks[key]) if key in checks else f"no SQL; {result.count()} rows"
        except Exception as e:  # report and go on
            wrong = f"{type(e).__name__}: {str(e)[:1200]}"
        failed += wrong is not None and key in checks
        print(f"{'ok ' if wrong is None else 'BAD' if key in checks else '-- '} {key} {time.time() - started:.2f}s {wrong or ''}", flush=True)
    print(f"{failed} failed")
    return failed


if __name__ == "__main__":
    sys.exit(1 if main() else 0)
