"""Run named queries on Spark and their SQL on DuckDB and compare the rows.

    python -m tests.parity [sf_dir] [name prefix ...]
"""

from __future__ import annotations

import datetime as dt
import math
import sys
import time
from collections import Counter

import duckdb

from foliospark.plans.fixtures import TABLES
from foliospark.plans.registry import load_all, runnable


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def norm(v):
    if isinstance(v, bool) or v is None or isinstance(v, (str, bytes)):
        return v
    if isinstance(v, int):
        return float(v)
    if isinstance(v, float):
        return None if math.isnan(v) else (0.0 if v == 0 else v)
    if isinstance(v, dt.datetime):
        return v.replace(tzinfo=None).isoformat()
    if isinstance(v, dt.date):
        return v.isoformat()
    if isinstance(v, (list, tuple)):
        return tuple(norm(x) for x in v)
    return str(v) if not hasattr(v, "as_tuple") else float(v)


KINDS = {"bigint": "n", "int": "n", "double": "n", "float": "n", "string": "s", "boolean": "b", "date": "d", "timestamp": "t", "timestamp_ntz": "t"}


def duck_kind(t: str) -> str:
    t = t.upper()
    if t in ("VARCHAR", "JSON"):
        return "s"
    if t == "BOOLEAN":
        return "b"
    if t == "DATE":
        return "d"
    if t.startswith("TIMESTAMP"):
        return "t"
    return "n" if t in ("BIGINT", "INTEGER", "DOUBLE", "FLOAT") else t


def compare(spark, con, name: str, sf_dir: str) -> str | None:
    """None if equal, else what differs."""
    q = load_all()[name]
    df = runnable(name)(spark, sf_dir)
    columns = sorted(df.columns)
    rows = Counter(tuple(norm(r[c]) for c in columns) for r in df.collect())
    if q.sql is None:
        return None
    rel = con.sql(q.sql)
    if sorted(rel.columns) != columns:
        return f"columns {columns} against {sorted(rel.columns)}"
    theirs = {c: duck_kind(str(t)) for c, t in zip(rel.columns, rel.types)}
    ours = {f.name: KINDS.get(f.dataType.simpleString(), f.dataType.simpleString()) for f in df.schema.fields}
    if theirs != ours:
        return f"types {[(c, ours[c], theirs[c]) for c in columns if ours[c] != theirs[c]]}"
    place = [rel.columns.index(c) for c in columns]
    expected = Counter(tuple(norm(r[i]) for i in place) for r in rel.fetchall())
    if rows == expected:
        return None
    extra, missing = rows - expected, expected - rows
    show = lambda c: [tuple(str(x)[:80] for x in r) for r in list(c)[:3]]
    return f"{sum(rows.values())} rows against {sum(expected.values())}; ours {show(extra)} theirs {show(missing)}"


def main(argv: list[str]) -> int:
    from tests.conftest import make_session

    sf_dir = argv[0] if argv else "/root/testdata/sf0.01"
    spark, con = make_session(), duck(sf_dir)
    bad = 0
    for name in load_all():
        if len(argv) > 1 and not any(name.startswith(p) for p in argv[1:]):
            continue
        start = time.time()
        try:
            result = compare(spark, con, name, sf_dir)
        except Exception as problem:
            result = f"{type(problem).__name__}: {str(problem)[:600]}"
        note = "ok" if result is None else "DIFF " + result
        if load_all()[name].sql is None:
            note += " (rows only)"
        print(f"{name:32s} {time.time() - start:6.2f}s {note}", flush=True)
        bad += result is not None
    print("failed:", bad)
    return bad


if __name__ == "__main__":
    raise SystemExit(main(sys.argv[1:]))
