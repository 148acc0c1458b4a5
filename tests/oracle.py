"""A query's rows against its DuckDB SQL."""

import math
import os

import duckdb


def plain(x):
    if isinstance(x, float) and math.isnan(x):
        return None
    if isinstance(x, (list, tuple)):
        return tuple(map(plain, x))
    return float(x) if type(x).__name__ == "Decimal" else x


def duck(sf_dir):
    connection = duckdb.connect()
    connection.sql("SET TimeZone = 'UTC'")
    for name in os.listdir(sf_dir):
        table, path = name.removesuffix(".parquet"), f"{sf_dir}/{name}"
        connection.sql(f"CREATE VIEW {table} AS SELECT * FROM '{path + '/*.parquet' if os.path.isdir(path) else path}'")
    return connection


def rows_of_spark(df):
    columns = sorted(df.columns)
    return columns, sorted((tuple(plain(r[c]) for c in columns) for r in df.collect()), key=repr)


def rows_of_duck(connection, sql):
    result = connection.sql(sql)
    names = result.columns
    place = [names.index(c) for c in sorted(names)]
    return sorted(names), sorted((tuple(plain(r[i]) for i in place) for r in result.fetchall()), key=repr)
