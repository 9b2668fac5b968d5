"""Run registered queries and their SQL side by side: ``python -m checks.compare [folder] [query ...]``."""

from __future__ import annotations

import math
import sys
import time

import duckdb

from checks.oracle import ORACLE
from checks.queries import QUERIES
from checks.session import session

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
    "conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for table in TABLES:
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{sf_dir}/{table}.parquet'")
    return con


def _cell(value):
    if value is None or (isinstance(value, float) and math.isnan(value)):
        return None
    if isinstance(value, bool):
        return value
    if isinstance(value, (int, float)) or type(value).__name__ == "Decimal":
        return round(float(value), 6)
    return str(value)


def _rows(names: list[str], rows) -> tuple[list[str], list[tuple]]:
    order = sorted(range(len(names)), key=lambda i: names[i])
    out = [tuple(_cell(row[i]) for i in order) for row in rows]
    return [names[i] for i in order], sorted(out, key=repr)


def difference(spark_df, con: duckdb.DuckDBPyConnection, sql: str) -> str | None:
    """None when equal as bags of rows, else what differs first."""
    have_names, have = _rows(spark_df.columns, spark_df.collect())
    result = con.execute(sql)
    want_names, want = _rows([c[0] for c in result.description], result.fetchall())
    if have_names != want_names:
        return f"columns {have_names} != {want_names}"
    if len(have) != len(want):
        return f"{len(have)} rows != {len(want)}"
    for a, b in zip(have, want):
        if a != b:
            return "; ".join(f"{n}: {x!r} != {y!r}" for n, x, y in zip(have_names, a, b) if x != y)
    return None


def main() -> int:
    args = sys.argv[1:] or ["/root/testdata/sf0.01"]
    sf_dir, chosen = args[0], args[1:] or list(QUERIES)
    spark, con, failed = session(), connect(sf_dir), 0
    for name in chosen:
        start = time.time()
        try:
            df = QUERIES[name](spark, sf_dir)
            problem = difference(df, con, ORACLE[name]) if name in ORACLE else f"no SQL, {df.count()} rows"
        except Exception as error:  # a broken query must not hide the others
            problem = f"{type(error).__name__}: {str(error)[:600]}"
        bad = problem is not None and not problem.startswith("no SQL")
        failed += bad
        print(f"{'FAIL' if bad else 'ok':5}{name:30}{time.time() - start:6.1f}s  {problem or ''}", flush=True)
    print(f"{len(chosen) - failed} of {len(chosen)} agree")
    return 1 if failed else 0


if __name__ == "__main__":
    sys.exit(main())
