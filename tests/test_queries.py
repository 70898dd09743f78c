"""Every registered query against its reference SQL on the smallest tables, and plan checks."""

import pytest

import check_queries
from tallybook.plans.registry import QUERIES

PATH = "/root/testdata/sf0.001"
WITH_SQL = [n for n, q in QUERIES.items() if q.sql is not None]


@pytest.fixture(scope="module")
def duck():
    return check_queries.duckdb_views(PATH)


@pytest.mark.parametrize("name", WITH_SQL)
def test_equals_reference_sql(spark, duck, name):
    df = QUERIES[name].run(spark, PATH)
    cursor = duck.execute(QUERIES[name].oracle())
    names = [c[0] for c in cursor.description]
    assert check_queries.compare([tuple(r) for r in df.collect()], df.columns, cursor.fetchall(), names) is None


def plan(spark, name):
    return QUERIES[name].run(spark, PATH)._jdf.queryExecution().toString()


@pytest.mark.parametrize(
    "name", ["q1", "q2", "q3", "q4", "q5", "asof_fx", "industry_daily", "normalize_clean", "quarantine_log", "tx_detail"]
)
def test_no_row_pairs(spark, name):
    text = plan(spark, name)
    assert "NestedLoop" not in text and "CartesianProduct" not in text


def test_columns_are_pruned(spark):
    text = plan(spark, "fx_currency_mix").replace("\n", "")
    assert "ReadSchema: struct<o_orderkey:bigint,o_custkey:bigint,o_totalprice:double,o_orderdate:timestamp_ntz>" in text
    assert "ReadSchema: struct<ts:timestamp_ntz,user_id:bigint,event_type:string>" in plan(spark, "pipeline_status") or (
        "ReadSchema: struct<ts:timestamp_ntz,event_type:string>" in plan(spark, "pipeline_status")
    )


def test_filters_are_pushed(spark):
    assert "PushedFilters: [In(event_type, [error,signup])" in plan(spark, "normalize_clean")
