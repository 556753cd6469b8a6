"""Every named query against its SQL on a second engine, and the shape of the plans."""

from __future__ import annotations

import glob
import os

import duckdb
import pytest

import __spark_entry__ as contract
from riskflow.plans.oracle import ORACLE_SQL as SQL
from riskflow.plans.queries import QUERIES


@pytest.fixture(scope="module")
def oracle(sf_dir):
    connection = duckdb.connect()
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        name = os.path.basename(path).removesuffix(".parquet")
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    return connection


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def check_plan(df):
    plan = plan_of(df)
    for operator in ("CartesianProduct", "BroadcastNestedLoopJoin", "PythonUDF", "ArrowEval"):
        assert operator not in plan


def plain(value):
    return value.item() if hasattr(value, "item") else value


def content(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    names = [columns[i] for i in order]
    return names, sorted(repr(tuple(plain(row[i]) for i in order)) for row in rows)


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_equals_sql(spark, sf_dir, oracle, name):
    df = QUERIES[name](spark, sf_dir)
    check_plan(df)
    result = oracle.execute(SQL[name])
    columns = [column[0] for column in result.description]
    assert content(df.columns, df.collect()) == content(columns, result.fetchall())


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(SQL)))
def test_query_without_sql_gives_rows(spark, sf_dir, name):
    df = QUERIES[name](spark, sf_dir)
    check_plan(df)
    assert df.count() > 0


def test_contract_offers_every_query():
    assert set(QUERIES) <= set(contract.queries())
    assert set(SQL) <= set(contract.oracle_sql()) <= set(contract.queries())


def test_entry(spark):
    assert contract.entry(spark).columns == ["id", "positive", "message"]


def test_lookup_reaches_the_scan(spark, sf_dir):
    assert "PushedFilters: [In(o_orderkey" in plan_of(QUERIES["lookup_by_id"](spark, sf_dir))


def test_review_reads_the_key_only(spark, sf_dir):
    plan = plan_of(QUERIES["review_summary"](spark, sf_dir))
    assert "ReadSchema: struct<o_orderkey:bigint,o_custkey:bigint>" in plan
    assert "c_acctbal" not in plan
