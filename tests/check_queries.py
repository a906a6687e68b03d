"""Compare registered queries with their oracle SQL: `python tests/check_queries.py [sf] [name part ...]`."""

from __future__ import annotations

import glob
import math
import sys
import time
from collections import Counter
from pathlib import Path

import duckdb

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

import __spark_entry__ as entry  # noqa: E402
from strataflow.session import local_session  # noqa: E402

TYPES = {
    "string": {"VARCHAR"}, "bigint": {"BIGINT"}, "int": {"INTEGER"}, "double": {"DOUBLE"},
    "boolean": {"BOOLEAN"},
}


def plain(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else round(value, 9) + 0.0
    return value


def rows_of(rows, columns):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(plain(r[i]) for i in order) for r in rows)


def connect(folder: str):
    con = duckdb.connect()
    for f in glob.glob(f"{folder}/*.parquet"):
        con.execute(f"CREATE VIEW {Path(f).stem} AS SELECT * FROM '{f}'")
    return con


def compare(spark, con, folder, name, sql):
    start = time.time()
    df = entry.queries()[name](spark, folder)
    got = df.collect()
    took = time.time() - start
    if sql is None:
        return None, f"{len(got)} rows, no oracle", took
    cur = con.execute(sql)
    names = [d[0] for d in cur.description]
    want = cur.fetchall()
    if sorted(names) != sorted(df.columns):
        return False, f"columns {sorted(df.columns)} vs {sorted(names)}", took
    types = dict(zip(names, [str(d[1]) for d in cur.description]))
    off = {c: (t, types[c]) for c, t in df.dtypes if types[c] not in TYPES.get(t, {types[c]})}
    a, b = rows_of(got, df.columns), rows_of(want, names)
    if a != b:
        return False, f"{len(got)} vs {len(want)} rows; spark only {list((a - b).items())[:2]}; oracle only {list((b - a).items())[:2]}", took
    return True, f"{len(got)} rows" + (f" TYPES {off}" if off else ""), took


def main() -> int:
    sf = sys.argv[1] if len(sys.argv) > 1 else "0.01"
    parts = sys.argv[2:]
    folder = f"/root/testdata/sf{sf}"
    spark, con = local_session(8), connect(folder)
    bad = 0
    for name in entry.queries():
        if parts and not any(p in name for p in parts):
            continue
        try:
            ok, note, took = compare(spark, con, folder, name, entry.oracle_sql().get(name))
        except Exception as exc:  # noqa: BLE001 - reported per query
            ok, note, took = False, f"{type(exc).__name__}: {str(exc)[:600]}", 0.0
        bad += ok is False
        print(f"{'ok ' if ok else '-- ' if ok is None else 'BAD'} {name:45s} {took:6.2f}s {note}", flush=True)
    print(f"{bad} mismatches", flush=True)
    return 1 if bad else 0


if __name__ == "__main__":
    raise SystemExit(main())
