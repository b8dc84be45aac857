"""Every registered query against DuckDB on the given tables."""

import pytest
from oracle_check import connect, differences

import __spark_entry__ as driver
from pyspark.sql import functions as F
from tunesmith import queries
from tunesmith.sources import layout

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return connect(FOLDER)


@pytest.mark.parametrize("name", sorted(driver.oracle_sql()))
def test_query_equals_sql(spark, con, name):
    assert differences(driver.queries()[name](spark, FOLDER), con, driver.oracle_sql()[name]) is None


def test_every_sql_has_a_query():
    assert set(driver.oracle_sql()) <= set(driver.queries())


def test_entry(spark):
    assert driver.entry(spark).columns == ["c_custkey", "c_name", "best"]
    assert driver.entry(spark).count() > 0


def test_footprint_of_sorted_files(spark):
    cond = F.col("o_orderdate") < F.lit("1995-07-01").cast("timestamp_ntz")
    row = layout.scan_footprint(spark, queries._orders_by_date(spark, FOLDER), cond).first()
    assert row["files_total"] == 8 and row["files_hit"] <= 2
    assert row["rows_hit"] < row["rows_total"] == 1500
