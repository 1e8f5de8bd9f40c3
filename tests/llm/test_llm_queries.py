"""Corpus queries beside their SQL, on the smallest data."""

import duckdb
import pytest
from compare import differences

from tributary.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def sql():
    connection = duckdb.connect()
    for name in ("documents", "embeddings", "pages", "labels", "conversations"):
        connection.sql(f"CREATE VIEW {name} AS SELECT * FROM '{SF}/{name}.parquet'")
    return connection


@pytest.mark.parametrize("name", [n for n, q in QUERIES.items() if q.sql])
def test_query_matches_sql(spark, sql, name):
    assert differences(QUERIES[name].build(spark, SF), sql.sql(QUERIES[name].sql)) == ""
