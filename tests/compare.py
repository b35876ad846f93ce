"""Compare a query with its oracle SQL on one data folder.

    python tests/compare.py /root/testdata/sf0.01 [query ...]
"""

from __future__ import annotations

import math
import sys
import time
from pathlib import Path

import duckdb

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))


def oracle_connection(sf: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for f in sorted(Path(sf).glob("*.parquet")):
        con.execute(f"CREATE VIEW {f.stem} AS SELECT * FROM read_parquet('{f}')")
    return con


def _norm(v):
    if isinstance(v, float):
        return None if math.isnan(v) else round(v, 6) + 0.0
    return v


def _rows(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    out = [tuple(_norm(r[i]) for i in order) for r in rows]
    return sorted(out, key=repr)


def compare(spark, con, sf: str, name: str, queries, oracles) -> str | None:
    """None when equal, else what differs."""
    df = queries[name](spark, sf)
    got = _rows(df.columns, [tuple(r) for r in df.collect()])
    if name not in oracles:
        return None if got else "no rows"
    cur = con.execute(oracles[name])
    names = [d[0] for d in cur.description]
    want = _rows(names, cur.fetchall())
    if sorted(names) != sorted(df.columns):
        return f"columns {sorted(df.columns)} != {sorted(names)}"
    if len(got) != len(want):
        extra, lost = list(set(got) - set(want))[:3], list(set(want) - set(got))[:3]
        return f"rows {len(got)} != {len(want)}; extra {extra}; lost {lost}"
    bad = [(g, w) for g, w in zip(got, want) if g != w]
    if bad:
        return f"{len(bad)} rows differ, e.g. {bad[:2]}"
    types = [type(v).__name__ for v in (want[0] if want else ())]
    mine = [type(v).__name__ for v in (got[0] if got else ())]
    if types != mine and None not in (*want[0], *got[0]):
        return f"types {mine} != {types}"
    return None if want else "oracle has no rows"


def main() -> None:
    from tests.conftest import build_session
    from __spark_entry__ import oracle_sql, queries

    sf, names = sys.argv[1], sys.argv[2:]
    spark = build_session()
    con = oracle_connection(sf)
    q, o = queries(), oracle_sql()
    failed = 0
    for name in names or q:
        start = time.time()
        try:
            problem = compare(spark, con, sf, name, q, o)
        except Exception as e:  # report and go on with the next query
            problem = f"{type(e).__name__}: {str(e)[:1500]}"
        failed += problem is not None
        flag = "rows-only" if name not in o else ""
        print(f"{'FAIL' if problem else 'ok  '} {name} {time.time() - start:.1f}s {flag} {problem or ''}", flush=True)
    print(f"{failed} failed")


if __name__ == "__main__":
    main()
