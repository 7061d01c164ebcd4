"""Compare a query's rows with its oracle's, in any order of rows and columns."""

from __future__ import annotations

import datetime as dt

import duckdb
from pyspark.sql import DataFrame

TABLES = (
    "region nation customer supplier part orders lineitem events "
    "documents embeddings pages benchmark labels conversations"
).split()


def oracle_rows(sql: str, sf_dir: str) -> tuple[list[str], list[tuple]]:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    result = con.execute(sql)
    columns = [c[0] for c in result.description]
    return columns, result.fetchall()


def _plain(value):
    if isinstance(value, dt.datetime):
        return value.replace(tzinfo=None).isoformat()
    if isinstance(value, dt.date):
        return value.isoformat()
    return value


def canonical(columns: list[str], rows: list[tuple]) -> list[str]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(repr([_plain(row[i]) for i in order]) for row in rows)


def mismatch(df: DataFrame, sql: str, sf_dir: str) -> str | None:
    """None where the results agree, else what differs."""
    columns, expected = oracle_rows(sql, sf_dir)
    actual = [tuple(row) for row in df.collect()]
    if sorted(df.columns) != sorted(columns):
        return f"columns {sorted(df.columns)} != {sorted(columns)}"
    a, e = canonical(df.columns, actual), canonical(columns, expected)
    if a != e:
        only_a, only_e = sorted(set(a) - set(e)), sorted(set(e) - set(a))
        return f"{len(a)} rows, oracle {len(e)}; only here {only_a[:2]}; only oracle {only_e[:2]}"
    if not a:
        return "no rows"
    return None
