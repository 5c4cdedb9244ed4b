"""Compare a Spark result with DuckDB's, regardless of row order."""

from __future__ import annotations

import duckdb

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages benchmark "
          "labels conversations").split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    return con


def rows_of(columns: list[str], rows: list) -> list[tuple]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(r[i] for i in order) for r in rows), key=repr)


def differences(frame, con, sql: str) -> str | None:
    """None if both hold the same columns, types and rows; else what differs."""
    got = frame.collect()
    relation = con.sql(sql)
    want_columns, want = relation.columns, relation.fetchall()
    if sorted(frame.columns) != sorted(want_columns):
        return f"columns {sorted(frame.columns)} != {sorted(want_columns)}"
    mine, theirs = rows_of(frame.columns, got), rows_of(want_columns, want)
    if len(mine) != len(theirs):
        return f"{len(mine)} rows != {len(theirs)}"
    kinds = dict(zip(want_columns, [str(t) for t in relation.types]))
    spark = dict(frame.dtypes)
    pairs = {"string": "VARCHAR", "int": "INTEGER", "bigint": "BIGINT", "double": "DOUBLE", "boolean": "BOOLEAN",
             "timestamp_ntz": "TIMESTAMP"}
    odd = {c: (t, kinds[c]) for c, t in spark.items()
           if kinds[c] != pairs.get(t, t.upper()) and kinds[c] != '"NULL"'}
    if odd:
        return f"types {odd}"
    for a, b in zip(mine, theirs):
        if a != b:
            return f"{sorted(frame.columns)}: {a} != {b}"
    return None
