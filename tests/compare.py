"""Compare every registered query with its SQL counterpart on the given tables.

    python tests/compare.py [table folder] [name part ...]
"""

from __future__ import annotations

import math
import sys
import tempfile
import time
from pathlib import Path

import duckdb

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

import __spark_entry__ as entry  # noqa: E402
from millrace.session import build_session  # noqa: E402

TABLES = [
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents", "embeddings",
    "pages", "benchmark", "labels", "conversations",
]


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def _value(v):
    if isinstance(v, float):
        return "NaN" if math.isnan(v) else repr(v)
    return str(v)


def canonical(columns: list[str], rows) -> tuple[list[str], list[tuple]]:
    """Columns by name, rows in any order, values exact."""
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return [columns[i] for i in order], sorted(tuple(_value(r[i]) for i in order) for r in rows)


def compare(spark, con, sf_dir: str, name: str) -> str | None:
    """None when equal, else what differs."""
    df = entry.queries()[name](spark, sf_dir)
    got_columns, got = canonical(df.columns, [tuple(r) for r in df.collect()])
    result = con.sql(entry.oracle_sql()[name])
    want_columns, want = canonical(result.columns, result.fetchall())
    if got_columns != want_columns:
        return f"columns {got_columns} != {want_columns}"
    spark_types = {n: t for n, t in df.dtypes}
    names = {"BIGINT": "bigint", "INTEGER": "int", "DOUBLE": "double", "VARCHAR": "string", "DATE": "date",
             "TIMESTAMP": "timestamp_ntz", "BOOLEAN": "boolean"}
    for column, kind in zip(result.columns, result.types):
        if names.get(str(kind)) != spark_types[column]:
            return f"type of {column}: {spark_types[column]} != {kind}"
    if len(got) != len(want):
        return f"{len(got)} rows != {len(want)}"
    for a, b in zip(got, want):
        if a != b:
            return f"{sum(x != y for x, y in zip(got, want))} of {len(want)} rows, first {a} != {b}"
    return None if want else "no rows on either side"


def main() -> None:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = build_session(master="local[8]", spark__sql__shuffle__partitions="8", spark__driver__memory="8g", spark__checkpoint__dir=tempfile.mkdtemp(prefix="millrace-compare-"))
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(sf_dir)
    failed = 0
    for name in entry.oracle_sql():
        if sys.argv[2:] and not any(part in name for part in sys.argv[2:]):
            continue
        began = time.time()
        try:
            problem = compare(spark, con, sf_dir, name)
        except Exception as error:  # noqa: BLE001
            problem = f"{type(error).__name__}: {str(error)[:600]}"
        failed += problem is not None
        print(f"{'ok  ' if problem is None else 'FAIL'} {time.time() - began:6.2f}s {name} {problem or ''}", flush=True)
    print(f"{failed} failed")
    sys.exit(bool(failed))


if __name__ == "__main__":
    main()
