import random

import pytest
from oracle_check import same_rows
from pyspark.sql import functions as F

from tunesmith.operators import advanced_joins, rewrites
from tunesmith.plans.inspect import plan_nodes, settings
from tunesmith.plans.skew import ONE_SIDED

AGGS = {"n": ("rows", None), "total": ("sum", "v"), "known": ("count", "v"), "mean": ("avg", "v")}
SQL = "count(t.x) AS n, CAST(sum(t.v) AS BIGINT) AS total, count(t.v) AS known, avg(t.v) AS mean"


@pytest.fixture(scope="module")
def t(spark):
    rng = random.Random(1)
    rows = [(rng.choice(["a", "b", None, "hot", "hot", "hot"]), rng.choice([None, rng.randint(-20, 20)]), rng.choice([None, rng.randint(-5, 5)])) for _ in range(400)]
    return spark.createDataFrame(rows, "k string, x int, v int")


@pytest.fixture(scope="module")
def params(spark):
    rng = random.Random(2)
    rows = [(i, rng.choice(["a", "hot", "none", None]), *sorted((rng.randint(-25, 25), rng.randint(-25, 25)))) for i in range(40)]
    rows += [(40, "a", 5, -5), (41, "a", None, 3), (42, "hot", 3, None), (43, "a", 2, 2), (43, "a", 2, 2), (44, "hot", -99, 99)]
    return spark.createDataFrame(rows, "id int, key string, lo int, hi int")


@pytest.mark.parametrize("hot_rows", [None, 40])
def test_ranges_and_equal_keys(t, params, hot_rows):
    got = rewrites.sweep_params(t, params.distinct(), "x", "lo", "hi", AGGS, [("k", "key")], hot_rows)
    same_rows(got, f"SELECT p.*, {SQL} FROM (SELECT DISTINCT * FROM params) p LEFT JOIN t ON k = key AND x BETWEEN lo AND hi GROUP BY ALL", t=t, params=params)


@pytest.mark.parametrize("hot_rows", [None, 10])
def test_ranges_alone(t, params, hot_rows):
    got = rewrites.sweep_params(t, params.distinct(), "x", "lo", "hi", AGGS, hot_rows=hot_rows)
    same_rows(got, f"SELECT p.*, {SQL} FROM (SELECT DISTINCT * FROM params) p LEFT JOIN t ON x BETWEEN lo AND hi GROUP BY ALL", t=t, params=params)


def test_repeated_rows_of_parameters_are_answered_each(t, params):
    got = rewrites.sweep_params(t, params, "x", "lo", "hi", AGGS, [("k", "key")])
    assert got.count() == params.count() and got.where("id = 43").distinct().count() == 1


def test_no_rows_or_no_parameters(t, params):
    assert rewrites.sweep_params(t, params.limit(0), "x", "lo", "hi", AGGS).count() == 0
    empty = rewrites.sweep_params(t.limit(0), params, "x", "lo", "hi", AGGS, [("k", "key")])
    assert {(r["n"], r["total"], r["known"], r["mean"]) for r in empty.collect()} == {(0, None, 0, None)}


@pytest.mark.parametrize("limit", ["-1", "10485760"])
def test_a_sweep_scans_once_and_loops_nowhere(spark, t, params, tmp_path, limit):
    t.write.parquet(str(tmp_path / "t"))
    with settings(spark, spark__sql__autoBroadcastJoinThreshold=limit):
        got = rewrites.sweep_params(spark.read.parquet(str(tmp_path / "t")), params, "x", "lo", "hi", AGGS, [("k", "key")])
        nodes, text = plan_nodes(got), got._jdf.queryExecution().executedPlan().toString()
    assert not {"BroadcastNestedLoopJoin", "CartesianProduct"} & set(nodes)
    assert text.count(f"file:{tmp_path}/t") + text.count("Batched: true, DataFilters: [isnotnull(x") <= 2 and "k#" in text


def test_sweep_refuses_a_name_twice(t, params):
    with pytest.raises(ValueError, match="already"):
        rewrites.sweep_params(t, params, "x", "lo", "hi", {"id": ("rows", None)})


@pytest.mark.parametrize("name", ["params", "sql", "spark", "params_"])
def test_run_params_takes_tables_of_any_name(spark, t, name):
    p = spark.createDataFrame([(1,), (2,)], "lo int")
    got = rewrites.run_params(spark, f"SELECT count(*) AS n FROM {{{name}}} WHERE x = p.lo", p, **{name: t})
    same_rows(got, "SELECT lo, count(x) AS n FROM p LEFT JOIN t ON x = lo GROUP BY lo", p=p, t=t)


# A fact thinned by a bit map


@pytest.mark.parametrize("how", ["inner", ONE_SIDED[0]])
@pytest.mark.parametrize("bits", [1 << 20, 64, 100])
def test_reduced_join(spark, how, bits):
    fact = spark.range(500).select((F.col("id") % 60).cast("int").alias("k"), "id").unionByName(spark.createDataFrame([(None, 1)], "k int, id long"))
    dim = spark.createDataFrame([(3, "a"), (7, "b"), (7, "c"), (None, "d"), (999, "e")], "d long, w string")
    got = advanced_joins.reduced_join(fact, dim, [("k", "d")], how, limit=-1, bits=bits)
    sql = "SELECT * FROM fact JOIN dim ON k = d" if how == "inner" else "SELECT * FROM fact WHERE k IN (SELECT d FROM dim)"
    same_rows(got, sql, fact=fact, dim=dim)


def test_rows_without_a_partner_are_not_shuffled(spark):
    fact = spark.range(100_000).select(F.col("id").alias("k"), (F.col("id") * 2).alias("v"))
    dim = spark.range(0, 100_000, 1000).select(F.col("id").alias("d"), F.lit("x").alias("w"))
    kept = advanced_joins._with_partner(fact, dim, [("k", "d")], 1 << 20)
    # 100 partners, and what passes by chance: 100,000 * 100 / 2**20.
    assert 100 <= kept.count() < 140
    assert advanced_joins.reduced_join(fact, dim, [("k", "d")], limit=-1).count() == 100
    assert advanced_joins._with_partner(fact, dim.limit(0), [("k", "d")], 1 << 10).count() == 0


def test_reduced_join_of_two_text_keys_and_refusals(spark):
    fact = spark.createDataFrame([("a", 1, 5), ("b", 1, 6), (None, 1, 7), ("é", 2, 8)], "s string, i int, v int")
    dim = spark.createDataFrame([("a", 1), ("é", 2), ("b", 2)], "t string, j long")
    got = advanced_joins.reduced_join(fact, dim, [("s", "t"), ("i", "j")], limit=-1)
    assert sorted(r["v"] for r in got.collect()) == [5, 8]
    with pytest.raises(ValueError):
        advanced_joins.reduced_join(fact, dim, [("s", "t")], "left")
    with pytest.raises(TypeError):
        advanced_joins.reduced_join(fact, dim, [("v", "t")], limit=-1)
