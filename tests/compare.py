"""Run registered queries on Spark and their SQL in DuckDB and compare the rows."""

import os
from decimal import Decimal

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def connect(sf_dir):
    con = duckdb.connect()
    for name in TABLES:
        path = os.path.join(sf_dir, f"{name}.parquet")
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return con


def _plain(value):
    if isinstance(value, (float, Decimal)):
        return round(float(value), 6) + 0.0
    if isinstance(value, bool):
        return value
    return value


def _sorted_rows(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    out = [tuple(_plain(row[i]) for i in order) for row in rows]
    return [names[i] for i in order], sorted(out, key=repr)


def compare(spark_df, con, sql):
    """None if equal, else a short account of the difference."""
    table = spark_df.toArrow()
    got_names, got = _sorted_rows(table.column_names, list(zip(*[c.to_pylist() for c in table.columns])))
    cursor = con.execute(sql)
    names = [d[0] for d in cursor.description]
    want_names, want = _sorted_rows(names, cursor.fetchall())
    if got_names != want_names:
        return f"columns {got_names} != {want_names}"
    if len(got) != len(want):
        return f"{len(got)} rows != {len(want)}"
    for a, b in zip(got, want):
        if a != b:
            return f"spark {str(a)[:300]} != sql {str(b)[:300]}"
    return None
