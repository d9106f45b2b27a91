"""Compare a Spark result with the result of SQL on the same parquet tables."""

from __future__ import annotations

from pathlib import Path

import duckdb
import pyarrow as pa


def sql_connection(folder: str):
    connection = duckdb.connect()
    for file in sorted(Path(folder).glob("*.parquet")):
        connection.execute(f"CREATE VIEW {file.stem} AS SELECT * FROM read_parquet('{file}')")
    return connection


def _types(table: pa.Table) -> dict[str, str]:
    plain = {"large_string": "string", "timestamp[us, tz=UTC]": "timestamp[us]"}
    return {f.name: plain.get(str(f.type), str(f.type)) for f in table.schema}


def _rows(table: pa.Table) -> list[tuple]:
    names = sorted(table.column_names)
    columns = [table.column(n).to_pylist() for n in names]
    return sorted(zip(*columns), key=repr) if columns else []


def difference(spark_table: pa.Table, sql_table: pa.Table) -> str | None:
    """None if names, types and rows agree, else what differs."""
    a, b = _types(spark_table), _types(sql_table)
    if a != b:
        return f"schema {sorted(set(a.items()) ^ set(b.items()))}"
    x, y = _rows(spark_table), _rows(sql_table)
    if len(x) != len(y):
        return f"rows {len(x)} != {len(y)}"
    bad = [(p, q) for p, q in zip(x, y) if p != q]
    return f"{len(bad)} rows differ, first {bad[0]}" if bad else None
