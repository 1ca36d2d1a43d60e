"""Compare a Spark result with the answer of its oracle SQL."""

from __future__ import annotations

from collections import Counter

import duckdb
from pyspark.sql import DataFrame

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings "
    "pages benchmark labels conversations"
).split()


def oracle_connection(sf_dir: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    connection.execute("set timezone = 'UTC'")
    for name in TABLES:
        connection.execute(
            f"create view {name} as select * from read_parquet('{sf_dir}/{name}.parquet')"
        )
    return connection


def differences(df: DataFrame, connection: duckdb.DuckDBPyConnection, sql: str) -> tuple[int, str]:
    """The number of Spark rows and a description of what differs, empty when nothing does."""
    cursor = connection.execute(sql)
    names = [column[0] for column in cursor.description]
    expected = cursor.fetchall()
    rows = df.collect()
    if sorted(names) != sorted(df.columns):
        return len(rows), f"columns {sorted(df.columns)} instead of {sorted(names)}"
    order = sorted(names)
    places = [names.index(name) for name in order]
    want = Counter(tuple(row[i] for i in places) for row in expected)
    got = Counter(tuple(row[name] for name in order) for row in rows)
    if want == got:
        return len(rows), ""
    return len(rows), (
        f"{len(rows)} rows instead of {len(expected)}; "
        f"missing {list((want - got).items())[:3]}; extra {list((got - want).items())[:3]}"
    )
