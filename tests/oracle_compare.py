"""Compare registered queries with their SQL, row by row.

Usage: ``python tests/oracle_compare.py [folder] [query ...]``
"""

from __future__ import annotations

import glob
import math
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def connect(folder: str):
    import duckdb

    con = duckdb.connect()
    for path in glob.glob(f"{folder}/*.parquet"):
        name = os.path.basename(path).removesuffix(".parquet")
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return con


def _key(value):
    if value is None:
        return (0, "")
    if isinstance(value, float):
        return (1, "nan" if math.isnan(value) else repr(value + 0.0))
    return (1, str(value))


def normalised(columns: list[str], rows) -> list[tuple]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(_key(row[i]) for i in order) for row in rows)


def compare(spark, con, name: str, folder: str) -> str | None:
    """None if equal, else a description of the difference."""
    import __spark_entry__ as entry

    df = entry.queries()[name](spark, folder)
    got_columns, got = df.columns, df.collect()
    cursor = con.execute(entry.oracle_sql()[name])
    want_columns, want = [d[0] for d in cursor.description], cursor.fetchall()
    if sorted(got_columns) != sorted(want_columns):
        return f"columns {sorted(got_columns)[:12]} against {sorted(want_columns)[:12]}"
    if len(got) != len(want):
        return f"{len(got)} rows against {len(want)}"
    kinds = {d[0]: str(d[1]) for d in cursor.description}
    types = {f.name: f.dataType.simpleString() for f in df.schema.fields}
    same_type = {"int": "INTEGER", "bigint": "BIGINT", "double": "DOUBLE", "string": "VARCHAR", "boolean": "BOOLEAN"}
    odd = {c: (types[c], kinds[c]) for c in types if same_type.get(types[c], kinds[c]) != kinds[c]}
    a, b = normalised(got_columns, got), normalised(want_columns, want)
    if a != b:
        i = next(i for i in range(len(a)) if a[i] != b[i])
        n = sum(x != y for x, y in zip(a, b))
        return f"{n} of {len(a)} rows differ, first: {str(a[i])[:600]} against {str(b[i])[:600]}"
    return f"types {odd}" if odd else None


if __name__ == "__main__":
    from tests.conftest import make_session

    import __spark_entry__ as entry

    folder = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark, con = make_session(), connect(folder)
    failed = 0
    for query in sys.argv[2:] or sorted(entry.oracle_sql()):
        start = time.time()
        problem = compare(spark, con, query, folder)
        failed += problem is not None
        print(f"{query:34s} {time.time() - start:6.1f}s {problem or 'ok'}", flush=True)
    print(f"{failed} differ; no SQL: {sorted(set(entry.queries()) - set(entry.oracle_sql()))}")
