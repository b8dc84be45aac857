import datetime as dt
import random

import pytest
from oracle_check import same_rows
from pyspark.sql import functions as F

from tunesmith.operators import advanced_joins as adv


def at(minute):
    return dt.datetime(2024, 1, 1) + dt.timedelta(minutes=minute)


@pytest.mark.parametrize("hot_rows", [None, 5])
@pytest.mark.parametrize("width", [3, 0.1, 7.5])
def test_band_join(spark, hot_rows, width):
    rnd = random.Random(4)
    l = [(i, rnd.choice([-7.5, -0.3, -0.1, 0.0, 0.1, 0.2, 0.3, 3.0, 7.5, 30.0])) for i in range(80)] + [(99, None)]
    r = [(i, rnd.choice([-10.5, -0.2, 0.0, 0.1, 0.2, 0.3, 0.4, 6.0, 15.0])) for i in range(60)] + [(99, None)]
    l, r = spark.createDataFrame(l, "a int, x double"), spark.createDataFrame(r, "b int, y double")
    same_rows(
        adv.band_join(l, r, "x", "y", width, hot_rows=hot_rows),
        f"SELECT a, x, b, y FROM l JOIN r ON x BETWEEN y - CAST({width} AS DOUBLE) AND y + CAST({width} AS DOUBLE)",
        l=l,
        r=r,
    )


def test_band_join_with_key(spark):
    l = spark.createDataFrame([("p", 1, 5), ("q", 2, 5), (None, 3, 5)], "g string, a int, x int")
    r = spark.createDataFrame([("p", 10, 7), ("p", 11, 8), ("q", 12, 3), (None, 13, 5)], "g string, b int, y int")
    same_rows(
        adv.band_join(l, r, "x", "y", 2, keys="g"),
        "SELECT l.g, a, x, b, y FROM l JOIN r ON l.g = r.g AND x BETWEEN y - 2 AND y + 2",
        l=l,
        r=r,
    )
    with pytest.raises(ValueError):
        adv.band_join(l, r, "x", "y", 0)


@pytest.mark.parametrize("hot_rows", [None, 3])
def test_asof_join(spark, hot_rows):
    trades = [("a", at(5), 1), ("a", at(1), 2), ("a", at(0), 3), ("b", at(9), 4), ("z", at(9), 5), (None, at(9), 6)]
    trades += [("a", None, 7)] + [("a", at(i), 100 + i) for i in range(20)] + [("a", at(3), 200)] * 4
    quotes = [("a", at(1), 10, 1.0), ("a", at(5), 11, 2.0), ("a", at(5), 12, 3.0), ("b", at(10), 13, 4.0)]
    quotes += [(None, at(0), 14, 5.0), ("a", None, 15, 6.0)] + [("a", at(7), 20 + i, float(i)) for i in range(9)]
    t = spark.createDataFrame(trades, "sym string, ts timestamp_ntz, id bigint").repartition(3)
    q = spark.createDataFrame(quotes, "sym string, ts timestamp_ntz, qid bigint, px double").repartition(3)
    same_rows(
        adv.asof_join(t, q, "sym", "ts", tie="qid", hot_rows=hot_rows),
        """SELECT t.sym, t.ts, id, best.qid, best.px FROM (SELECT *, row_number() OVER () AS rn FROM t) t LEFT JOIN (
               SELECT rn, qid, px FROM (SELECT *, row_number() OVER () AS rn FROM t) t JOIN q
               ON q.sym = t.sym AND q.ts <= t.ts
               QUALIFY row_number() OVER (PARTITION BY rn ORDER BY q.ts DESC, qid DESC) = 1) best USING (rn)""",
        t=t.cache(),
        q=q,
    )


def test_asof_join_of_columns_that_are_never_null(spark):
    l = spark.range(30).select((F.col("id") % 2).alias("k"), "id")
    r = spark.range(30).select((F.col("id") % 2).alias("k"), "id", F.col("id").alias("w"))
    out = adv.asof_join(l, r, "k", "id", hot_rows=4)
    assert out.where("w = id").count() == 30


def test_asof_join_of_other_names(spark):
    l = spark.createDataFrame([(1, 10), (1, 3)], "a int, t int")
    r = spark.createDataFrame([(1, 4, "x")], "b int, u int, w string")
    out = adv.asof_join(l, r, [("a", "b")], ("t", "u"))
    assert {tuple(x) for x in out.collect()} == {(1, 10, 1, 4, "x"), (1, 3, None, None, None)}


@pytest.mark.parametrize("hot_rows", [None, 4])
def test_running_total(spark, hot_rows):
    rnd = random.Random(1)
    rows = [("hot" if i % 3 else None, i, rnd.choice([None, 1, 2, 5])) for i in rnd.sample(range(90), 90)]
    rows += [("cold", 1, 3), ("cold", 2, None), ("none", 1, None)]
    df = spark.createDataFrame(rows, "g string, i int, v bigint").repartition(3)
    same_rows(
        adv.running_total(df, ["g"], ["i"], "v", "s", hot_rows),
        "SELECT g, i, v, CAST(sum(v) OVER (PARTITION BY g ORDER BY i ROWS UNBOUNDED PRECEDING) AS BIGINT) AS s FROM t",
        t=df.cache(),
    )


def test_running_total_downwards_over_all(spark):
    df = spark.range(100).select((F.col("id") * 7 % 100).alias("i"), F.lit(1).alias("v")).repartition(3)
    out = adv.running_total(df, [], [F.col("i").desc()], "v", "s", hot_rows=9)
    assert {(r["i"], r["s"]) for r in out.collect()} == {(i, 100 - i) for i in range(100)}


def test_running_total_same_type_with_and_without_hot_groups(spark):
    df = spark.range(50).select((F.col("id") % 2).alias("g"), "id", F.lit(1.5).cast("decimal(18,2)").alias("v"))
    plain = adv.running_total(df, ["g"], ["id"], "v", "s")
    assert plain.schema["s"].dataType == adv.running_total(df, ["g"], ["id"], "v", "s", 5).schema["s"].dataType


@pytest.mark.parametrize("limit", [None, -1, 150])
@pytest.mark.parametrize("order", [(0, 1, 2, 3), (3, 2, 1, 0), (2, 0, 3, 1)])
def test_star_join(spark, limit, order):
    fact = spark.sql("SELECT * FROM VALUES (1, 1, 5), (1, 2, 6), (2, 1, 7), (9, 1, 8), (NULL, 1, 9) AS t(a, b, v)")
    d1 = spark.sql("SELECT * FROM VALUES (1, 'x', 7), (2, 'y', 8) AS t(a1, n, c1)")
    d2 = spark.sql("SELECT * FROM VALUES (1, 'p') AS t(b1, m)")
    # d3 is reached through d1, and d4 through d3.
    d3 = spark.sql("SELECT * FROM VALUES (7, 'deep', 4), (8, 'deep', 5) AS t(c2, o, e1)")
    d4 = spark.sql("SELECT * FROM VALUES (4, 'deeper') AS t(e2, q)")
    dims = [(d3, [("c1", "c2")]), (d1, [("a", "a1")]), (d4, [("e1", "e2")]), (d2, [("b", "b1")])]
    same_rows(
        adv.star_join(fact, [dims[i] for i in order], limit),
        "SELECT * FROM fact JOIN d1 ON a = a1 JOIN d2 ON b = b1 JOIN d3 ON c1 = c2 JOIN d4 ON e1 = e2",
        fact=fact,
        d1=d1,
        d2=d2,
        d3=d3,
        d4=d4,
    )


def test_star_join_without_a_key(spark):
    with pytest.raises(ValueError):
        adv.star_join(spark.range(1), [(spark.range(1).toDF("x"), [("nowhere", "x")])])
