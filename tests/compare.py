"""Run registered queries on Spark and DuckDB and compare rows, column names and types.

    python tests/compare.py [--sf DIR] [name or prefix ...]
"""

from __future__ import annotations

import argparse
import os
import sys
import time
import traceback

import duckdb
import pandas as pd
import pyarrow as pa

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from xoutcome.catalog.base import TABLES  # noqa: E402


def connect(sf: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for table in TABLES:
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{sf}/{table}.parquet'")
    return con


def kind(t: pa.DataType) -> str:
    if pa.types.is_decimal(t):
        return "decimal"
    if pa.types.is_list(t) or pa.types.is_large_list(t):
        return f"list<{kind(t.value_type)}>"
    if pa.types.is_large_string(t) or pa.types.is_string(t) or "string_view" in str(t):
        return "string"
    if pa.types.is_timestamp(t):
        return "timestamp"
    return str(t)


def normal(table: pa.Table) -> list[tuple]:
    names = sorted(table.column_names)
    def cell(v):
        if isinstance(v, float):
            return "nan" if v != v else repr(v + 0.0)
        if isinstance(v, list):
            return "[" + ",".join(map(cell, v)) + "]"
        return str(v)
    columns = [[cell(v) for v in table.column(n).to_pylist()] for n in names]
    return sorted(zip(*columns)) if columns else []


def difference(found: pa.Table, wanted: pa.Table) -> str | None:
    a, b = sorted(found.column_names), sorted(wanted.column_names)
    if a != b:
        return f"columns {a} != {b}"
    ta = {n: kind(found.schema.field(n).type) for n in a}
    tb = {n: kind(wanted.schema.field(n).type) for n in a}
    if ta != tb:
        return f"types {[(n, ta[n], tb[n]) for n in a if ta[n] != tb[n]]}"
    ra, rb = normal(found), normal(wanted)
    if len(ra) != len(rb):
        return f"rows {len(ra)} != {len(rb)}"
    wrong = [(x, y) for x, y in zip(ra, rb) if x != y]
    if wrong:
        x, y = wrong[0]
        return f"{len(wrong)} of {len(ra)} rows differ, e.g. {[(n, p, q) for n, p, q in zip(a, x, y) if p != q]}"
    return None


def main() -> int:
    from xoutcome import build_session
    from xoutcome.catalog import registered

    parser = argparse.ArgumentParser()
    parser.add_argument("--sf", default="/root/testdata/sf0.01")
    parser.add_argument("--start")
    parser.add_argument("names", nargs="*")
    args = parser.parse_args()
    spark = build_session("local[8]", 8, **{"spark.ui.enabled": "false", "spark.ui.showConsoleProgress": "false",
                                                 "spark.driver.memory": "12g"})
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(args.sf)
    bad = 0
    chosen = dict(registered())
    if args.start:
        names = list(chosen)
        chosen = {n: chosen[n] for n in names[names.index(args.start):]}
    for name, q in chosen.items():
        if args.names and name not in args.names and not any(n.endswith("*") and name.startswith(n[:-1]) for n in args.names):
            continue
        start = time.time()
        try:
            found = q.run(spark, args.sf).toArrow()
            took = time.time() - start
            result = "rows only" if q.sql is None else difference(found, con.sql(q.sql).to_arrow_table())
            if q.sql is not None and found.num_rows == 0:
                result = result or "EMPTY"
        except Exception as e:  # noqa: BLE001
            took = time.time() - start
            result = f"ERROR {type(e).__name__}: {str(e)[:600]}"
            if os.environ.get("TRACE"):
                traceback.print_exc()
        ok = result in (None, "rows only")
        bad += not ok
        rows = found.num_rows if ok else "-"
        print(f"{'ok ' if ok else 'BAD'} {name:32s} {took:6.2f}s {rows} rows {result or ''}", flush=True)
    print("bad:", bad)
    return bad


if __name__ == "__main__":
    sys.exit(main())
