"""Comparison of a Spark query with its SQL counterpart in DuckDB."""

import duckdb

TABLES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents",
    "embeddings", "pages", "benchmark", "labels", "conversations",
)
TYPES = {"bigint": "BIGINT", "int": "INTEGER", "string": "VARCHAR", "double": "DOUBLE", "boolean": "BOOLEAN"}


def duckdb_on(sf_dir):
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return connection


def assert_same(df, connection, sql):
    answer = connection.execute(sql)
    columns = [(item[0], str(item[1])) for item in answer.description]
    assert sorted((name, TYPES[kind]) for name, kind in df.dtypes) == sorted(columns)
    names = sorted(df.columns)
    order = [[name for name, _ in columns].index(name) for name in names]
    expected = sorted(repr(tuple(row[i] for i in order)) for row in answer.fetchall())
    actual = sorted(repr(tuple(row[name] for name in names)) for row in df.collect())
    assert actual == expected
