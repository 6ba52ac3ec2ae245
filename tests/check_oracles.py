"""Run registered queries beside their SQL oracles and compare rows, columns, types and values.

    python tests/check_oracles.py [--sf 0.01] [name ...]
"""

from __future__ import annotations

import math
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import duckdb

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages benchmark "
          "labels conversations").split()


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{folder}/{t}.parquet'")
    return con


def normal(v):
    if isinstance(v, float):
        return None if math.isnan(v) else repr(v)
    return None if v is None else str(v)


def rows_of(table) -> list[tuple]:
    names = sorted(table.column_names)
    cols = [table.column(n).to_pylist() for n in names]
    return sorted((tuple(normal(v) for v in r) for r in zip(*cols)), key=lambda r: tuple((x is None, x or "") for x in r))


def compare(spark, con, folder: str, fn, sql: str) -> str:
    """Empty string when equal, else what differs."""
    got, want = fn(spark, folder).toArrow(), con.execute(sql).to_arrow_table()
    if sorted(got.column_names) != sorted(want.column_names):
        return f"columns {sorted(got.column_names)} vs {sorted(want.column_names)}"
    def kind(t):
        return str(t).replace("large_string", "string")
    types = {n: (kind(got.schema.field(n).type), kind(want.schema.field(n).type)) for n in got.column_names}
    diff = {n: t for n, t in types.items() if t[0] != t[1]}
    if diff:
        return f"types {diff}"
    if got.num_rows != want.num_rows:
        return f"rows {got.num_rows} vs {want.num_rows}"
    a, b = rows_of(got), rows_of(want)
    bad = [(x, y) for x, y in zip(a, b) if x != y]
    return f"{len(bad)} of {len(a)} rows differ, first {bad[0]}" if bad else ""


def main() -> int:
    import __spark_entry__ as entry
    from tabforge.session import local_session

    args = sys.argv[1:]
    sf = "0.01"
    if "--sf" in args:
        i = args.index("--sf")
        sf = args[i + 1]
        del args[i:i + 2]
    folder = f"/root/testdata/sf{sf}"
    spark, con = local_session(), connect(folder)
    queries, oracles = entry.queries(), entry.oracle_sql()
    failed = 0
    for name in args or queries:
        start = time.time()
        try:
            if name in oracles:
                message = compare(spark, con, folder, queries[name], oracles[name])
                state = f"FAIL {message}" if message else "ok"
            else:
                state = f"rows {queries[name](spark, folder).toArrow().num_rows}"
        except Exception as e:  # report every query, whatever it raises
            state = f"ERROR {type(e).__name__}: {str(e)[:600]}"
        failed += state.startswith(("FAIL", "ERROR"))
        print(f"{time.time() - start:7.2f}s  {name:22s} {state}", flush=True)
    print(f"{failed} failed")
    return int(failed > 0)


if __name__ == "__main__":
    sys.exit(main())
