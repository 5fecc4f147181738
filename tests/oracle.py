"""Comparing a Spark result with its SQL in DuckDB."""

from __future__ import annotations

import math
from collections import Counter

import duckdb

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
          "conversations").split()


def connect(sf_dir):
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{sf_dir}/{name}.parquet')")
    return con


def _cell(value):
    if isinstance(value, float):
        return "NaN" if math.isnan(value) else repr(value)
    if hasattr(value, "tzinfo") and value.tzinfo is not None:
        value = value.replace(tzinfo=None)
    return repr(value)


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return [columns[i] for i in order], Counter(tuple(_cell(r[i]) for i in order) for r in rows)


def compare(df, con, sql):
    """None if equal, else a short account of the difference."""
    table = df.toArrow()
    left = rows_of(df.columns, list(zip(*[c.to_pylist() for c in table.columns])) if table.num_rows else [])
    found = con.execute(sql)
    right = rows_of([d[0] for d in found.description], found.fetchall())
    if left[0] != right[0]:
        return f"columns {left[0]} != {right[0]}"
    if left[1] == right[1]:
        return None
    only_left, only_right = left[1] - right[1], right[1] - left[1]
    def show(rows):
        return [tuple(c[:160] for c in r) for r in sorted(rows)[:3]]
    return (f"{sum(left[1].values())} rows vs {sum(right[1].values())}; "
            f"only Spark {sum(only_left.values())}: {show(only_left)}; only SQL {sum(only_right.values())}: {show(only_right)}")
