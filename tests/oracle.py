"""Compare named queries with their SQL in DuckDB; also a command line tool.

    python tests/oracle.py [sf_dir] [query ...]
"""

from __future__ import annotations

import glob
import os
import sys
import time
from collections import Counter

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def checker(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("set timezone = 'UTC'")
    for path in sorted(glob.glob(f"{sf_dir}/*.parquet")):
        name = os.path.basename(path).removesuffix(".parquet")
        con.execute(f"create view {name} as select * from read_parquet('{path}')")
    return con


def difference(df, con: duckdb.DuckDBPyConnection, sql: str) -> str | None:
    """None when both hold the same rows under the same column names."""
    rel = con.sql(sql)
    names = sorted(rel.columns)
    if sorted(df.columns) != names:
        return f"columns {sorted(df.columns)} != {names}"
    got = Counter(tuple(r) for r in df.select(*names).collect())
    want = Counter(rel.select(*[duckdb.ColumnExpression(n) for n in names]).fetchall())
    if got == want:
        return None
    extra, missing = got - want, want - got
    return (
        f"{sum(got.values())} rows against {sum(want.values())}; "
        f"extra {list(extra.items())[:2]}, missing {list(missing.items())[:2]}"
    )


def main() -> None:
    import __spark_entry__ as entry

    from tidemark.session import local_session

    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    chosen = sys.argv[2:] or list(entry.queries())
    spark, con, sqls = local_session(8), checker(sf), entry.oracle_sql()
    for name in chosen:
        began = time.time()
        try:
            df = entry.queries()[name](spark, sf)
            if name in sqls:
                result = difference(df, con, sqls[name]) or f"same, {df.count()} rows"
            else:
                result = f"rows only, {df.count()} rows"
        except Exception as e:  # report and go on with the next query
            result = "ERROR " + str(e)[:600]
        print(f"{name:24s} {time.time() - began:6.1f}s {result}", flush=True)


if __name__ == "__main__":
    main()
