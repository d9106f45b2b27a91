"""The queries that SQL can express against their SQL, on whole tables."""

from __future__ import annotations

import duckdb
import pytest
from compare import difference

import __spark_entry__ as entry_points
from ledgerloom.llm.checks import SQL

FOLDER = "/root/testdata/sf0.001"


@pytest.mark.parametrize("key", sorted(SQL))
def test_matches_sql(spark, key):
    con = duckdb.connect()
    for name in ("documents", "pages", "embeddings", "labels", "conversations"):
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{FOLDER}/{name}.parquet'")
    expected = con.execute(entry_points.oracle_sql()[key]).to_arrow_table()
    assert difference(entry_points.queries()[key](spark, FOLDER).toArrow(), expected) is None
