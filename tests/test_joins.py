"""NULLs, ties and empty inputs in the join operators."""

import pytest
from oracle_check import same_rows
from pyspark.sql import functions as F

from tunesmith.operators import joins
from tunesmith.plans.inspect import settings


@pytest.fixture(scope="module")
def or_left(spark):
    return spark.sql("SELECT * FROM VALUES (1, 10), (2, NULL), (NULL, 20), (NULL, NULL) AS t(x, y)")


@pytest.fixture(scope="module")
def or_keys(spark):
    return spark.sql("SELECT * FROM VALUES (1), (10), (20), (NULL) AS t(k)")


THETA = {
    "inner": "SELECT a, b FROM l JOIN r ON a < b",
    "left": "SELECT a, b FROM l LEFT JOIN r ON a < b",
    "right": "SELECT a, b FROM l RIGHT JOIN r ON a < b",
    "full": "SELECT a, b FROM l FULL JOIN r ON a < b",
    "left_semi": "SELECT a FROM l WHERE EXISTS (SELECT 1 FROM r WHERE a < b)",
    "left_anti": "SELECT a FROM l WHERE NOT EXISTS (SELECT 1 FROM r WHERE a < b)",
}


@pytest.mark.parametrize("how", THETA)
@pytest.mark.parametrize("limit", [None, -1], ids=["broadcast", "grid"])
def test_theta_join(spark, how, limit):
    l = spark.sql("SELECT * FROM VALUES (1), (5), (5), (9), (NULL) AS t(a)").repartition(2)
    r = spark.sql("SELECT * FROM VALUES (0), (4), (6), (6), (NULL) AS t(b)").repartition(2)
    same_rows(joins.theta_join(l, r, F.col("a") < F.col("b"), how, limit), THETA[how], l=l, r=r)


@pytest.mark.parametrize("how", THETA)
def test_theta_join_of_empty(spark, how):
    l = spark.createDataFrame([(1,)], "a int")
    r = spark.createDataFrame([], "b int")
    same_rows(joins.theta_join(l, r, F.col("a") < F.col("b"), how, -1), THETA[how], l=l, r=r)


@pytest.mark.parametrize("limit", [None, -1])
def test_semi_anti_and_not_in_by_either_way(spark, or_left, or_keys, limit):
    on, known = [("x", "k")], or_keys.where("k IS NOT NULL")
    with settings(spark, spark__sql__autoBroadcastJoinThreshold="10485760" if limit is None else "-1"):
        assert joins.semi_join(or_left, or_keys, on).count() == 1
        assert joins.anti_join(or_left, or_keys, on, hot_rows=1).count() == 3
        assert joins.not_in(or_left, or_keys, on).count() == 0
        assert joins.not_in(or_left, known, on).count() == 1


@pytest.mark.parametrize("join", [joins.merge_join, joins.hash_join, joins.broadcast_join])
@pytest.mark.parametrize("how", ["inner", "left", "right", "full", "left_semi", "left_anti"])
def test_methods_agree(spark, or_left, or_keys, join, how):
    kind = {"inner": "JOIN", "left": "LEFT JOIN", "right": "RIGHT JOIN", "full": "FULL JOIN"}.get(how)
    no = "NOT" if how == "left_anti" else ""
    sql = (
        f"SELECT x, y, k FROM l {kind} r ON x = k"
        if kind
        else f"SELECT x, y FROM l WHERE {no} EXISTS (SELECT 1 FROM r WHERE x = k)"
    )
    same_rows(join(or_left, or_keys, [("x", "k")], how), sql, l=or_left, r=or_keys)


@pytest.mark.parametrize("how", ["left", "right", "full"])
def test_hash_join_builds_the_left_of_an_outer_join(or_left, or_keys, how):
    sql = f"SELECT x, y, k FROM l {how.upper()} JOIN r ON x = k"
    same_rows(joins.hash_join(or_left, or_keys, [("x", "k")], how, build="left"), sql, l=or_left, r=or_keys)


def test_hash_join_build_side(spark, or_left, or_keys):
    same_rows(
        joins.hash_join(or_left, or_keys, [("x", "k")], build="left"),
        "SELECT x, y, k FROM l JOIN r ON x = k",
        l=or_left,
        r=or_keys,
    )
    with pytest.raises(ValueError):
        joins.hash_join(or_left, or_keys, [("x", "k")], "left_semi", build="left")


def test_semi_and_anti_keep_nulls_apart(or_left, or_keys):
    assert joins.semi_join(or_left, or_keys, [("x", "k")]).count() == 1
    assert joins.anti_join(or_left, or_keys, [("x", "k")]).count() == 3


def test_not_in(or_left, or_keys):
    on = [("x", "k")]
    assert joins.not_in(or_left, or_keys, on).count() == 0
    known = or_keys.where("k IS NOT NULL")
    same_rows(joins.not_in(or_left, known, on), "SELECT * FROM l WHERE x NOT IN (SELECT k FROM r)", l=or_left, r=known)
    none = or_keys.where("false")
    same_rows(joins.not_in(or_left, none, on), "SELECT * FROM l WHERE x NOT IN (SELECT k FROM r)", l=or_left, r=none)


def test_scalar_lookup_without_partner(spark, or_left):
    inner = spark.createDataFrame([(1, 5), (1, 7), (None, 9)], "k int, v int")
    none = inner.where("false")
    for t in (inner, none):
        same_rows(
            joins.scalar_lookup(or_left, t, [("x", "k")], F.max("v"), "best"),
            "SELECT x, y, (SELECT max(v) FROM r WHERE k = x) AS best FROM l",
            l=or_left,
            r=t,
        )
        same_rows(
            joins.scalar_lookup(or_left, t, [("x", "k")], F.count("*"), "n", empty=0),
            "SELECT x, y, (SELECT count(*) FROM r WHERE k = x) AS n FROM l",
            l=or_left,
            r=t,
        )


def test_scalar_filter(spark, or_left):
    inner = spark.createDataFrame([(1, 5), (1, 7), (2, 1)], "k int, v int")
    same_rows(
        joins.scalar_filter(or_left, inner, [("x", "k")], F.max("v"), ">", F.col("y")),
        "SELECT x, y FROM l WHERE y > (SELECT max(v) FROM r WHERE k = x)",
        l=or_left,
        r=inner,
    )
    few = joins.scalar_filter(or_left, inner, [("x", "k")], F.count("*"), ">", F.lit(2), empty=0)
    same_rows(few, "SELECT x, y FROM l WHERE 2 > (SELECT count(*) FROM r WHERE k = x)", l=or_left, r=inner)


def test_top1_lookup(spark, or_left):
    inner = spark.createDataFrame([(1, 5, "a"), (1, 7, "b"), (None, 9, "c")], "k int, v int, w string")
    out = joins.top1_lookup(or_left, inner, [("x", "k")], [F.col("v").desc()], ["v", "w"])
    assert {tuple(r) for r in out.collect()} == {
        (1, 10, 7, "b"),
        (2, None, None, None),
        (None, 20, None, None),
        (None, None, None, None),
    }
