"""Every registered query against its SQL, over whole tables."""

import os

import duckdb
import pytest

import __spark_entry__ as entry_points
from standins.keys import ORACLE, QUERIES


@pytest.fixture(scope="module")
def con(sf_dir):
    connection = duckdb.connect()
    connection.execute("SET TimeZone = 'UTC'")
    for f in sorted(os.listdir(sf_dir)):
        connection.execute(f"CREATE VIEW {f.removesuffix('.parquet')} AS SELECT * FROM '{sf_dir}/{f}'")
    return connection


def test_every_query_has_sql():
    assert set(ORACLE) == set(QUERIES) <= set(entry_points.queries())
    assert set(ORACLE) <= set(entry_points.oracle_sql()) <= set(entry_points.queries())


def test_entry_point(spark):
    df = entry_points.entry(spark)
    assert df.columns == ["fiscal_year", "fiscal_quarter", "channel", "gross_sales_inr", "line_count"] and df.count() > 0


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_sql(spark, sf_dir, con, name):
    df = QUERIES[name](spark, sf_dir)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "NestedLoopJoin" not in plan
    columns = sorted(df.columns)
    got = sorted((tuple(r[c] for c in columns) for r in df.collect()), key=repr)
    result = con.execute(ORACLE[name])
    names = [c[0] for c in result.description]
    want = sorted((tuple(row[names.index(c)] for c in columns) for row in result.fetchall()), key=repr)
    assert sorted(names) == columns
    assert got == want

