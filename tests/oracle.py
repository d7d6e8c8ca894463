"""Compare a registered query with its DuckDB statement, value by value."""

from __future__ import annotations

import math

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _plain(v):
    if v is None or (isinstance(v, float) and math.isnan(v)):
        return "~"
    if isinstance(v, bool):
        return str(v)
    if isinstance(v, float):
        return repr(round(v, 9) + 0.0)
    if hasattr(v, "as_tuple"):  # decimal
        return repr(float(v))
    return f"{v}"


def rows_of(columns: list[str], rows) -> list[tuple]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(_plain(r[i]) for i in order) for r in rows)


_SPARK_TYPES = {"string": "VARCHAR", "bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "boolean": "BOOLEAN"}


def compare(spark_df, con, sql: str) -> str | None:
    """None when equal, else a description of the first difference."""
    cursor = con.execute(sql)
    names = [d[0] for d in cursor.description]
    kinds = {d[0]: str(d[1]) for d in cursor.description}
    expected = rows_of(names, cursor.fetchall())
    if sorted(names) != sorted(spark_df.columns):
        return f"columns {sorted(spark_df.columns)} != {sorted(names)}"
    actual = rows_of(spark_df.columns, spark_df.collect())
    types = {n: _SPARK_TYPES.get(t, t) for n, t in spark_df.dtypes}
    loose = {"TINYINT": "INTEGER", "INTEGER": "INTEGER", "SMALLINT": "INTEGER"}
    odd = {n: (types[n], kinds[n]) for n in names if loose.get(types[n], types[n]) != loose.get(kinds[n], kinds[n])}
    if len(actual) != len(expected):
        return f"{len(actual)} rows != {len(expected)}; types {odd}"
    for a, e in zip(actual, expected):
        if a != e:
            return f"{sorted(names)}: spark {a} != duckdb {e}; types {odd}"
    return f"types {odd}" if odd else None
