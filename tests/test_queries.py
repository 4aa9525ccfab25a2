import os

import pytest
from oracle import duck_rows, spark_rows

import __spark_entry__ as entry
from lodestrata.plans import catalogue

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.mark.parametrize("name", sorted(catalogue.ORACLES))
def test_query_equals_sql(spark, name):
    names, rows = spark_rows(catalogue.QUERIES[name](spark, SF))
    names_sql, rows_sql = duck_rows(catalogue.ORACLES[name], SF)
    assert names == names_sql
    assert len(rows) == len(rows_sql)
    assert rows == rows_sql
    assert rows


@pytest.mark.parametrize("name", sorted(set(catalogue.QUERIES) - set(catalogue.ORACLES)))
def test_query_without_sql_runs(spark, name):
    assert catalogue.QUERIES[name](spark, SF).count() > 0


def test_entry(spark):
    assert entry.entry(spark).count() > 0
    assert set(entry.oracle_sql()) <= set(entry.queries())
