"""Every checked query against its SQL on the smallest data, and what their plans may not contain."""

import duckdb
import pytest
from compare import differences

import __spark_entry__ as contract
from tributary.workload.derived import RAW, land_raw, raw_cte
from tributary.workload.registry import QUERIES as LIBRARY

SF = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()
QUERIES, ORACLES = {n: q.build for n, q in LIBRARY.items()}, {n: q.sql for n, q in LIBRARY.items() if q.sql}


@pytest.fixture(scope="module")
def sql():
    connection = duckdb.connect()
    for table in TABLES:
        connection.sql(f"CREATE VIEW {table} AS SELECT * FROM '{SF}/{table}.parquet'")
    return connection


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLES)
    assert set(QUERIES) <= set(contract.queries()) and set(ORACLES) <= set(contract.oracle_sql())


def test_flagship(spark):
    assert contract.entry(spark).columns == ["segment", "nation", "customers"]


@pytest.mark.parametrize("name", list(RAW))
def test_raw_tables_mean_the_same_in_both_engines(spark, sql, name):
    landed = spark.read.parquet(land_raw(spark, SF, name))
    assert differences(landed, sql.sql(f"WITH {raw_cte([name])} SELECT * FROM raw_{name}")) == ""


@pytest.mark.parametrize("name", list(QUERIES))
def test_query_matches_sql(spark, sql, name):
    frame = QUERIES[name](spark, SF)
    plan = frame._jdf.queryExecution().executedPlan().toString()
    for unwanted in ("CartesianProduct", "BroadcastNestedLoopJoin", "EvalPython", "InPandas"):
        assert unwanted not in plan, unwanted
    assert differences(frame, sql.sql(ORACLES[name])) == ""


def test_plans_use_what_spark_offers(spark):
    def plan(name):
        return QUERIES[name](spark, SF)._jdf.queryExecution().executedPlan().toString()

    assert "WindowGroupLimit" in plan("top1_priority") and "Partial" in plan("top1_priority")
    filters = plan("filters_mix")
    assert "PushedFilters: [IsNotNull(l_returnflag)" in filters or "In(l_returnflag, [A,R])" in filters
    head = plan("headcount_summary")
    assert "c_acctbal" not in head and "c_name" not in head
