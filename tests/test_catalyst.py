"""Rewrites left to Catalyst: a Spark upgrade that stops doing one fails here."""

import pytest

from tunesmith.plans.inspect import plan_nodes, plan_text, settings
from tunesmith.sources.tables import table

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module", autouse=True)
def views(spark):
    for name in ("customer", "orders", "lineitem"):
        table(spark, FOLDER, name).createOrReplaceTempView(name)


def optimized(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_in_and_exists_become_semi_joins(spark):
    for cond in ("c_custkey IN (SELECT o_custkey FROM orders)", "EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey)"):
        assert "Join LeftSemi" in optimized(spark.sql(f"SELECT * FROM customer WHERE {cond}"))


def test_correlated_scalar_becomes_an_outer_join(spark):
    df = spark.sql("SELECT c_custkey, (SELECT max(o_totalprice) FROM orders WHERE o_custkey = c_custkey) FROM customer")
    assert "Join LeftOuter" in optimized(df)


def test_filter_goes_into_an_aggregated_view(spark):
    df = spark.sql("SELECT * FROM (SELECT o_custkey, count(*) FROM orders GROUP BY 1) WHERE o_custkey = 5")
    assert "EqualTo(o_custkey,5)" in plan_text(df)


def test_constant_crosses_a_join(spark):
    df = spark.sql("SELECT 1 FROM customer JOIN orders ON c_custkey = o_custkey WHERE c_custkey = 5")
    assert "EqualTo(c_custkey,5)" in plan_text(df) and "EqualTo(o_custkey,5)" in plan_text(df)


def test_outer_join_becomes_inner_under_a_filter(spark):
    df = spark.sql("SELECT * FROM customer LEFT JOIN orders ON c_custkey = o_custkey WHERE o_totalprice > 0")
    assert "Join Inner" in optimized(df)


def test_unused_left_join_is_dropped(spark):
    df = spark.sql("SELECT DISTINCT c_custkey FROM customer LEFT JOIN orders ON c_custkey = o_custkey")
    assert "Join" not in optimized(df)


def test_repeated_subplan_is_reused(spark):
    df = spark.sql(
        """WITH t AS (SELECT o_custkey, sum(o_totalprice) AS s FROM orders GROUP BY 1)
           SELECT a.o_custkey FROM t a JOIN t b ON a.o_custkey = b.o_custkey AND a.s >= b.s"""
    )
    with settings(spark, spark__sql__autoBroadcastJoinThreshold=-1):
        assert "ReusedExchange" in plan_nodes(df)


def test_rewrites_catalyst_lacks(spark):
    """If one of these starts to pass, the operator for it can go."""
    or_join = spark.sql("SELECT 1 FROM lineitem JOIN orders ON l_orderkey = o_orderkey OR l_partkey = o_custkey")
    assert "BroadcastNestedLoopJoin" in plan_nodes(or_join)
    fk = spark.sql("SELECT l_orderkey FROM lineitem JOIN orders ON l_orderkey = o_orderkey")
    assert "Join Inner" in optimized(fk)
    late = spark.sql("SELECT o_custkey, sum(l_tax) FROM lineitem JOIN orders ON l_orderkey = o_orderkey GROUP BY 1")
    assert optimized(late).count("Aggregate") == 1
