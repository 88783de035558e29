"""Compare a registered query with its SQL on DuckDB: columns, rows, values."""

from __future__ import annotations

import math

import duckdb

TABLES = [
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
    "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
]


def connect(folder: str):
    con = duckdb.connect()
    for table in TABLES:
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{folder}/{table}.parquet'")
    return con


def _cell(x):
    if x is None:
        return "∅"
    if isinstance(x, bool):
        return str(x)
    if isinstance(x, float):
        if math.isnan(x):
            return "nan"
        return repr(x + 0.0)
    if hasattr(x, "as_integer_ratio") and not isinstance(x, int):
        return repr(float(x))
    return str(x)


def rows_of(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted(tuple(_cell(r[i]) for i in order) for r in rows)


def differences(spark_df, con, sql: str, limit: int = 5) -> list[str]:
    expected = con.execute(sql)
    names = [d[0] for d in expected.description]
    if sorted(names) != sorted(spark_df.columns):
        return [f"columns {sorted(spark_df.columns)} != {sorted(names)}"]
    want = rows_of(names, expected.fetchall())
    got = rows_of(spark_df.columns, [tuple(r) for r in spark_df.collect()])
    found = [] if len(want) == len(got) else [f"rows {len(got)} != {len(want)}"]
    found += [f"spark {g} / sql {w}" for g, w in zip(got, want) if g != w][:limit]
    return found
