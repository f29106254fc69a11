"""Runs a query and its SQL over the same tables and compares the rows."""

from __future__ import annotations

import os

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()
ROOT = os.environ.get("TESTDATA_ROOT", "/root/testdata")


def connect(sf_dir: str):
    import duckdb

    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def sql_rows(con, sql: str) -> tuple[list[str], list[tuple]]:
    result = con.execute(sql)
    columns = [c[0] for c in result.description]
    return _by_name(columns, result.fetchall())


def spark_rows(df) -> tuple[list[str], list[tuple]]:
    return _by_name(df.columns, [tuple(r) for r in df.collect()])


def _by_name(columns: list[str], rows: list[tuple]) -> tuple[list[str], list[tuple]]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return (
        [columns[i] for i in order],
        sorted((tuple(r[i] for i in order) for r in rows), key=repr),
    )
