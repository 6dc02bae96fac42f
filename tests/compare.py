"""Run a registered query and its oracle side by side."""

from __future__ import annotations

from pathlib import Path

import duckdb

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages "
          "benchmark labels conversations").split()


def oracle_rows(sf_dir: str, sql: str):
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for name in TABLES:
        if Path(f"{sf_dir}/{name}.parquet").exists():
            con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    cursor = con.execute(sql)
    columns = [d[0] for d in cursor.description]
    return columns, cursor.fetchall()


def canonical(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    lines = [tuple(row[i] for i in order) for row in rows]
    return [columns[i] for i in order], sorted(lines, key=lambda r: [(v is not None, type(v).__name__, str(v)) for v in r])


def difference(spark, sf_dir, query, sql):
    """None when both results hold the same rows, else a short description."""
    df = query(spark, sf_dir)
    got_columns, got = canonical(df.columns, [tuple(r) for r in df.collect()])
    want_columns, want = canonical(*oracle_rows(sf_dir, sql))
    if got_columns != want_columns:
        return f"columns {got_columns} != {want_columns}"
    if len(got) != len(want):
        return f"{len(got)} rows != {len(want)}: {[r for r in got if r not in want][:3]} / {[r for r in want if r not in got][:3]}"
    wrong = [(g, w) for g, w in zip(got, want) if g != w or [type(v) for v in g] != [type(v) for v in w]]
    return f"{len(wrong)} rows differ, first {wrong[0]}" if wrong else None
