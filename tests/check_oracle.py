"""Run registered queries beside their SQL: ``python tests/check_oracle.py [sf_dir] [key ...]``."""

from __future__ import annotations

import math
import os
import sys
import time

sys.path.insert(0, os.path.join(os.path.dirname(__file__), ".."))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()

KINDS = {"bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR", "boolean": "BOOLEAN"}


def plain(value):
    if value is None:
        return None
    if isinstance(value, float):
        return "nan" if math.isnan(value) else round(value, 9) + 0.0
    if isinstance(value, bool) or isinstance(value, (int, str)):
        return value
    return str(value)


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return [columns[i] for i in order], sorted((tuple(plain(r[i]) for i in order) for r in rows), key=repr)


def compare(con, df, sql):
    """None if both sides agree, else what differs."""
    kinds = {f.name: KINDS[f.dataType.simpleString()] for f in df.schema.fields}
    want_kinds = {r[0]: r[1] for r in con.execute(f"DESCRIBE {sql}").fetchall()}
    if kinds != want_kinds:
        return f"types {sorted(set(kinds.items()) ^ set(want_kinds.items()))}"
    names, got = rows_of(df.columns, [tuple(r) for r in df.collect()])
    cur = con.execute(sql)
    want_names, want = rows_of([c[0] for c in cur.description], cur.fetchall())
    if names != want_names:
        return f"columns {names} != {want_names}"
    if len(got) != len(want):
        return f"{len(got)} rows != {len(want)}"
    bad = [(a, b) for a, b in zip(got, want) if a != b]
    return f"{len(bad)} of {len(got)} rows differ, first: {bad[0]}" if bad else None


def connect(d):
    import duckdb

    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{d}/{t}.parquet'")
    return con


def main():
    import __spark_entry__ as entry
    from conftest import make_session

    d = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark, con = make_session(), connect(d)
    queries, sql = entry.queries(), entry.oracle_sql()
    for key in sys.argv[2:] or queries:
        start = time.time()
        try:
            if key in sql:
                verdict = compare(con, queries[key](spark, d), sql[key]) or "ok"
            else:
                verdict = f"rows only: {len(queries[key](spark, d).collect())}"
        except Exception as e:  # noqa: BLE001
            verdict = f"FAILED {type(e).__name__}: {str(e)[:600]}"
        print(f"@@ {key:24s} {time.time() - start:6.2f}s  {verdict}"[:900], flush=True)


if __name__ == "__main__":
    main()
