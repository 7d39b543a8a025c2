"""Run registered queries in Spark and their SQL in DuckDB, and compare the rows.

    python tests/compare.py [sf_dir] [query ...]
"""

from __future__ import annotations

import datetime
import decimal
import math
import sys
import time
from collections import Counter
from pathlib import Path

import duckdb

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings "
    "pages benchmark labels conversations"
).split()


def connect(sf: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf}/{t}.parquet'")
    return con


def plain(v):
    if v is None or (isinstance(v, float) and math.isnan(v)):
        return None
    if isinstance(v, float):
        return ("float", repr(v + 0.0))
    if isinstance(v, decimal.Decimal):
        return ("decimal", str(v))
    if isinstance(v, bool):
        return ("bool", v)
    if isinstance(v, int):
        return ("int", v)
    if isinstance(v, (datetime.date, datetime.datetime)):
        return (type(v).__name__, v.isoformat())
    return (type(v).__name__, v)


def rows(columns, data):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(columns), Counter(tuple(plain(r[i]) for i in order) for r in data)


def compare(df, con, sql: str) -> str | None:
    """None if equal, else what differs."""
    ours = rows(df.columns, df.collect())
    cur = con.execute(sql)
    names = [d[0] for d in cur.description]
    theirs = rows(names, cur.fetchall())
    if ours[0] != theirs[0]:
        return f"columns {ours[0]} != {theirs[0]}"
    if ours[1] != theirs[1]:
        return (
            f"rows {sum(ours[1].values())} / {sum(theirs[1].values())}\n"
            f"  only ours   {list((ours[1] - theirs[1]).items())[:3]}\n"
            f"  only theirs {list((theirs[1] - ours[1]).items())[:3]}"
        )
    return None if sum(ours[1].values()) else "both empty"


def main() -> int:
    from tests.conftest import make_session

    import __spark_entry__ as e

    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark, con = make_session(), connect(sf)
    oracles, bad = e.oracle_sql(), 0
    for name in sys.argv[2:] or e.queries():
        start = time.time()
        try:
            df = e.queries()[name](spark, sf)
            if name in oracles:
                problem = compare(df, con, oracles[name])
            else:
                problem = None if df.count() else "no rows"
        except Exception as x:  # noqa: BLE001
            problem = f"{type(x).__name__}: {str(x)[:600]}"
        bad += problem is not None
        print(f"{'ok ' if problem is None else 'BAD'} {name} {time.time() - start:.1f}s", flush=True)
        if problem:
            print("   ", problem, flush=True)
    print(f"{bad} bad")
    return bad


if __name__ == "__main__":
    sys.exit(min(main(), 1))
