"""The queries that SQL can express, against DuckDB on the same tables."""

import duckdb
import pytest

from gridscan.llm import queries

from .conftest import SF


def rows(cells):
    return sorted(repr(tuple(x)) for x in cells)


@pytest.mark.parametrize("name", queries.ORACLE_SQL)
def test_query_equals_sql(spark, name):
    db = duckdb.connect()
    for t in ("documents", "pages", "conversations", "labels"):
        db.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    df = queries.QUERIES[name](spark, SF)
    got = db.execute(f"SELECT {', '.join(chr(34) + c + chr(34) for c in df.columns)} FROM ({queries.ORACLE_SQL[name]}) q").fetchall()
    assert rows(df.collect()) == rows(got)
