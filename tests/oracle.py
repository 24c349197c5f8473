"""Runs registered queries on Spark and their SQL on DuckDB and compares rows and types.

    python tests/oracle.py [sf_dir] [name ...]
"""

from __future__ import annotations

import math
import sys
import time
from pathlib import Path

import duckdb

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

import __spark_entry__ as contract  # noqa: E402
from carelens.registry.views import BASE  # noqa: E402

TYPES = {
    "BIGINT": "bigint", "INTEGER": "int", "VARCHAR": "string", "DATE": "date", "DOUBLE": "double",
    "BOOLEAN": "boolean", "TIMESTAMP": "timestamp",
}


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in BASE:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    return con


def _value(v: object) -> object:
    if isinstance(v, float):
        return "nan" if math.isnan(v) else round(v, 6)
    return v


def _rows(columns: list[str], rows: list[tuple]) -> list[str]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(repr([_value(r[i]) for i in order]) for r in rows)


def compare(spark, con, name: str, sf_dir: str) -> str:
    """'ok' with the row count, or what differs."""
    df = contract.queries()[name](spark, sf_dir)
    mine = [tuple(r) for r in df.collect()]
    sql = contract.oracle_sql().get(name)
    if sql is None:
        return f"ok (rows only) {len(mine)}"
    cur = con.execute(sql)
    names = [c[0] for c in cur.description]
    kinds = {c[0]: TYPES.get(str(c[1]), str(c[1])) for c in cur.description}
    theirs = cur.fetchall()
    if sorted(names) != sorted(df.columns):
        return f"DIFF columns {sorted(df.columns)} against {sorted(names)}"
    types = {n: (t, kinds[n]) for n, t in df.dtypes if t.replace("_ntz", "") != kinds[n]}
    a, b = _rows(df.columns, mine), _rows(names, theirs)
    if a != b:
        only_a = sorted(set(a) - set(b))[:3]
        only_b = sorted(set(b) - set(a))[:3]
        return f"DIFF {len(a)} rows against {len(b)}; spark only {only_a}; sql only {only_b}; types {types}"
    if types:
        return f"DIFF types {types}"
    return f"ok {len(a)}"


def main() -> int:
    from carelens.session import local_session

    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    wanted = sys.argv[2:]
    spark, con = local_session(8), connect(sf_dir)
    bad = 0
    for name in contract.queries():
        if wanted and not any(name.startswith(w) for w in wanted):
            continue
        start = time.time()
        try:
            told = compare(spark, con, name, sf_dir)
        except Exception as e:  # noqa: BLE001
            told = f"FAIL {type(e).__name__}: {str(e)[:600]}"
        bad += not told.startswith("ok")
        print(f"{time.time() - start:6.2f}s {name}: {told}", flush=True)
    print(f"{bad} bad")
    return bad


if __name__ == "__main__":
    sys.exit(main())
