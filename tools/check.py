"""Run registered queries beside their SQL: check.py [-d folder] [name-prefix ...]."""

from __future__ import annotations

import argparse
import importlib
import math
import os
import sys
import time
import traceback

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from featherloom.catalog import SECTIONS  # noqa: E402
from featherloom.catalog.base import Tables  # noqa: E402
from featherloom.session import build_session  # noqa: E402

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages "
          "benchmark labels conversations").split()


def cell(v) -> str:
    if v is None:
        return "NULL"
    if isinstance(v, bool):
        return f"bool:{v}"
    if isinstance(v, float):
        return "NULL" if math.isnan(v) else f"float:{v!r}"
    if isinstance(v, int):
        return f"int:{v}"
    if isinstance(v, (list, tuple)):
        return "[" + ",".join(cell(x) for x in v) + "]"
    if isinstance(v, dict):
        return "{" + ",".join(cell(x) for x in v.values()) + "}"
    return f"{type(v).__name__}:{v}"


def bag(columns, rows) -> list[str]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted("|".join(cell(r[i]) for i in order) for r in rows)


def compare(tables: Tables, con, fn, sql) -> tuple[str, int]:
    df = fn(tables)
    rows = [tuple(r) for r in df.collect()]
    if not sql:
        return ("rows-only" if rows else "EMPTY"), len(rows)
    t0 = time.time()
    cur = con.execute(sql)
    names, want = [d[0] for d in cur.description], cur.fetchall()
    if time.time() - t0 > 3:
        print(f"   (sql took {time.time() - t0:.1f}s)")
    if sorted(names) != sorted(df.columns):
        return f"COLUMNS spark={sorted(df.columns)} sql={sorted(names)}", len(rows)
    a, b = bag(df.columns, rows), bag(names, want)
    if len(a) != len(b):
        return f"ROWS spark={len(a)} sql={len(b)} cols={sorted(names)} {a[:2]} {b[:2]}", len(rows)
    bad = [(x, y) for x, y in zip(a, b) if x != y]
    if bad:
        only_a, only_b = sorted(set(a) - set(b)), sorted(set(b) - set(a))
        return f"VALUES {len(bad)}/{len(a)} cols={str(sorted(names))[:600]}\n   spark {str(only_a[:3])[:1500]}\n   sql   {str(only_b[:3])[:1500]}", len(rows)
    return ("ok" if a else "ok-EMPTY"), len(rows)


def connect(folder: str):
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{folder}/{name}.parquet')")
    return con


def main() -> None:
    ap = argparse.ArgumentParser()
    ap.add_argument("-d", default="/root/testdata/sf0.01")
    ap.add_argument("-s", action="append", help="catalog section")
    ap.add_argument("names", nargs="*")
    args = ap.parse_args()
    spark = build_session(master="local[8]", **{
        "spark.sql.shuffle.partitions": "8", "spark.ui.enabled": "false", "spark.driver.memory": "12g",
        "spark.ui.showConsoleProgress": "false"})
    spark.sparkContext.setLogLevel("ERROR")
    con, tables, failed, n = connect(args.d), Tables(spark, args.d), 0, 0
    for section in args.s or SECTIONS:
        book = importlib.import_module(f"featherloom.catalog.{section}").book
        for name, fn in book.queries.items():
            if args.names and not any(name.startswith(p) for p in args.names):
                continue
            t0 = time.time()
            try:
                verdict, rows = compare(tables, con, fn, book.sql.get(name))
            except Exception as e:
                lines = [x for x in str(e).splitlines() if x.strip()][:6]
                where = traceback.extract_tb(e.__traceback__)[-1]
                verdict, rows = f"ERROR {type(e).__name__} {where.filename.split('/')[-1]}:{where.lineno} " + " / ".join(lines)[:700], -1
            n += 1
            good = verdict in ("ok", "rows-only")
            failed += not good
            print(f"{'  ' if good else '!!'} {name:38s} {rows:7d} {time.time() - t0:6.1f}s {verdict}", flush=True)
    print(f"{n} queries, {failed} not good")
    sys.exit(1 if failed else 0)


if __name__ == "__main__":
    main()
