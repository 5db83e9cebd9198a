"""Compare a Spark result with the oracle's, column by column, regardless of row order."""

from __future__ import annotations

import math

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


def oracle_rows(sf_dir: str, sql: str) -> tuple[dict[str, str], list[tuple]]:
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{sf_dir}/{name}.parquet')")
    cursor = connection.execute(sql)
    types = {d[0]: str(d[1]) for d in cursor.description}
    order = sorted(range(len(types)), key=lambda i: list(types)[i])
    return types, sorted((tuple(plain(r[i]) for i in order) for r in cursor.fetchall()), key=repr)


def spark_rows(df) -> tuple[dict[str, str], list[tuple]]:
    types = dict(df.dtypes)
    columns = sorted(types)
    return types, sorted((tuple(plain(r[c]) for c in columns) for r in df.collect()), key=repr)


def plain(value):
    """Zero has one sign, NaN equals itself."""
    if isinstance(value, float):
        return "NaN" if math.isnan(value) else value + 0.0
    return value
