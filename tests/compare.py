"""Run registered queries against DuckDB on the same files."""

import math

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def connect(sf_dir):
    connection = duckdb.connect()
    for name in TABLES:
        connection.sql(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return connection


def canonical(columns, rows):
    """Rows with columns in the order of their names, in a fixed row order."""
    order = sorted(range(len(columns)), key=lambda i: columns[i])

    def cell(value):
        if isinstance(value, float):
            return "nan" if math.isnan(value) else repr(value)
        return repr(value)

    return sorted(columns), sorted(tuple(cell(row[i]) for i in order) for row in rows)


def spark_rows(df):
    return canonical(df.columns, [tuple(row) for row in df.collect()])


def duckdb_rows(connection, sql):
    result = connection.sql(sql)
    return canonical(result.columns, result.fetchall())
