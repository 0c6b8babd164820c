"""Runs registered queries beside their SQL in DuckDB and compares names, types and values.

    python tools/check.py [sf folder] [query ...]

CHECK_CONF holds further session settings, such as
``spark.sql.autoBroadcastJoinThreshold=-1`` to try every join as a shuffle join.
"""

import datetime
import decimal
import os
import sys
import time
from collections import Counter

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from regista import build_session, workload  # noqa: E402

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{folder}/{name}.parquet')")
    return con


def _plain(value: object) -> object:
    if isinstance(value, bool):
        return ("bool", value)
    if isinstance(value, int):
        return ("int", value)
    if isinstance(value, float):
        return ("float", value + 0.0)
    if isinstance(value, decimal.Decimal):
        return ("decimal", str(value))
    if isinstance(value, datetime.datetime):
        return ("datetime", value.isoformat())
    if isinstance(value, datetime.date):
        return ("date", value.isoformat())
    return value


def _rows(columns: list[str], rows: list) -> Counter:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(_plain(r[i]) for i in order) for r in rows)


_TYPES = {
    "bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR",
    "boolean": "BOOLEAN", "date": "DATE",
}


def compare(spark, con, name: str, folder: str) -> str | None:
    """None when the query and its SQL agree, else what differs."""
    df = workload.queries()[name](spark, folder)
    got_columns, got = df.columns, df.collect()
    sql = workload.oracle_sql().get(name)
    if sql is None:
        return None if got else "no rows"
    cursor = con.execute(sql)
    want_columns = [d[0] for d in cursor.description]
    want = cursor.fetchall()
    if sorted(got_columns) != sorted(want_columns):
        return f"columns {sorted(got_columns)} != {sorted(want_columns)}"
    want_types = {r[0]: r[1] for r in con.execute(f"DESCRIBE {sql}").fetchall()}
    types = {c: _TYPES.get(k, k) for c, k in df.dtypes}
    if types != want_types:
        return f"types {({c: (types[c], want_types[c]) for c in types if types[c] != want_types[c]})}"
    a, b = _rows(got_columns, got), _rows(want_columns, want)
    if a != b:
        only_a, only_b = list((a - b).items())[:3], list((b - a).items())[:3]
        return (f"{len(got)} rows against {len(want)}, {sum((a - b).values())} differ; "
                f"only here {only_a}, only in SQL {only_b}")
    return None if got else "no rows on either side"


def main() -> int:
    args = sys.argv[1:]
    folder = args.pop(0) if args and "/" in args[0] else "/root/testdata/sf0.01"
    names = args or list(workload.queries())
    given = dict(c.split("=", 1) for c in os.environ.get("CHECK_CONF", "").split() if c)
    spark = build_session("check", "local[8]", **{
        "spark.ui.enabled": "false", "spark.sql.shuffle.partitions": "8",
        "spark.ui.showConsoleProgress": "false", **given,
    })
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(folder)
    bad = 0
    for name in names:
        start = time.time()
        try:
            problem = compare(spark, con, name, folder)
        except Exception as error:  # a failing query is a finding, the others still run
            problem = f"{type(error).__name__}: {str(error)[:1500]}"
        bad += problem is not None
        print(f"{'FAIL' if problem else 'ok':5}{time.time() - start:7.2f}s  {name}"
              + (f"\n      {problem}" if problem else ""), flush=True)
    print(f"{len(names) - bad} of {len(names)} agree")
    return bad


if __name__ == "__main__":
    sys.exit(1 if main() else 0)
