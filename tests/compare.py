"""Compare a Spark result with the same query in DuckDB: columns, types, rows in any order."""

from __future__ import annotations

import glob
import os

import duckdb

# DuckDB name of each Spark type that appears in results.
TYPES = {
    "bigint": "BIGINT", "int": "INTEGER", "smallint": "SMALLINT", "double": "DOUBLE", "string": "VARCHAR",
    "boolean": "BOOLEAN", "date": "DATE", "timestamp_ntz": "TIMESTAMP",
}


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        con.execute(f"CREATE VIEW {os.path.basename(path)[:-8]} AS SELECT * FROM '{path}'")
    return con


def difference(spark_rows, con, sql: str) -> str | None:
    """None when equal, else what differs."""
    result = con.sql(sql)
    want_types = dict(zip(result.columns, map(str, result.types)))
    got_types = {f.name: TYPES.get(f.dataType.simpleString(), f.dataType.simpleString()) for f in spark_rows.schema}
    if got_types != want_types:
        odd = sorted(set(got_types.items()) ^ set(want_types.items()))
        return f"columns or types differ: {odd}"
    names = sorted(want_types)
    order = [result.columns.index(n) for n in names]
    want = sorted((tuple(row[i] for i in order) for row in result.fetchall()), key=repr)
    got = sorted((tuple(row) for row in spark_rows.select(*[f"`{n}`" for n in names]).collect()), key=repr)
    if len(got) != len(want):
        return f"{len(got)} rows, expected {len(want)}"
    for g, w in zip(got, want):
        if g != w:
            return f"got {dict(zip(names, g))}, expected {dict(zip(names, w))}"
    return None
