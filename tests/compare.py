"""Compares a query with its oracle, as multisets of rows."""

from __future__ import annotations

import math
import os
from collections import Counter

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark"
    " labels conversations"
).split()


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    connection.execute("SET TimeZone = 'UTC'")
    for name in TABLES:
        path = f"{sf_dir}/{name}.parquet"
        if os.path.exists(path):
            connection.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return connection


def _plain(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else repr(value)  # sums are exact, so the last digit counts
    return str(value)


def multiset(rows, names) -> Counter:
    order = sorted(range(len(names)), key=lambda i: names[i])
    return Counter(tuple(_plain(row[i]) for i in order) for row in rows)


def differences(df, sql: str, connection) -> list[str]:
    """What differs: names, types, rows. Empty if nothing does."""
    result = connection.execute(sql)
    names = [d[0] for d in result.description]
    found = []
    if sorted(names) != sorted(df.columns):
        return [f"columns {sorted(df.columns)} != {sorted(names)}"]
    types = {d[0]: str(d[1]).upper() for d in result.description}
    known = {
        "bigint": "BIGINT",
        "int": "INTEGER",
        "double": "DOUBLE",
        "string": "VARCHAR",
        "date": "DATE",
        "timestamp_ntz": "TIMESTAMP",
        "boolean": "BOOLEAN",
    }
    for name, kind in df.dtypes:
        if known.get(kind) != types[name]:
            found.append(f"{name}: {kind} != {types[name]}")
    mine, theirs = multiset(df.collect(), df.columns), multiset(result.fetchall(), names)
    if mine != theirs:
        found.append(
            f"{sum(mine.values())} rows != {sum(theirs.values())};"
            f" only here {list((mine - theirs).items())[:3]};"
            f" only there {list((theirs - mine).items())[:3]}"
        )
    return found
