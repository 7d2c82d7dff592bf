"""Run one named query on Spark and its SQL on the checking engine, and compare every row."""

from __future__ import annotations

import glob
import os

import duckdb


def open_tables(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for path in sorted(glob.glob(f"{sf_dir}/*.parquet")):
        name = os.path.basename(path)[: -len(".parquet")]
        con.execute(f"create view {name} as select * from read_parquet('{path}')")
    return con


def sorted_rows(columns: list[str], rows: list[tuple]) -> list[tuple]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    picked = [tuple(row[i] for i in order) for row in rows]
    return sorted(picked, key=lambda row: tuple((v is None, str(type(v)), v if v is not None else 0) for v in row))


_TYPES = {
    "int": "INTEGER",
    "bigint": "BIGINT",
    "double": "DOUBLE",
    "string": "VARCHAR",
}


def compare(spark, con, name, query, sql, sf_dir) -> int:
    df = query(spark, sf_dir)
    got = [tuple(row) for row in df.collect()]
    cur = con.execute(sql)
    columns = [d[0] for d in cur.description]
    types = {d[0]: str(d[1]) for d in cur.description}
    want = cur.fetchall()
    assert sorted(df.columns) == sorted(columns), (name, df.columns, columns)
    for column, kind in df.dtypes:
        assert _TYPES[kind] == types[column], (name, column, kind, types[column])
    left, right = sorted_rows(df.columns, got), sorted_rows(columns, want)
    assert len(left) == len(right), (name, len(left), len(right))
    for a, b in zip(left, right):
        assert a == b, (name, a, b)
    return len(left)
