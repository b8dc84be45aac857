import datetime as dt
import decimal
import random

import pytest
from oracle_check import same_rows
from pyspark.sql import functions as F

from tunesmith.plans.inspect import files_scanned, rows_scanned
from tunesmith.sources import skipping

SCHEMA = "id long, k int, s string, d date, t timestamp_ntz, x decimal(10,2), f double, m map<string,int>"


def rows(n=400, seed=1):
    rng = random.Random(seed)
    for i in range(n):
        k = rng.choice([None, rng.randint(-500, 500)])
        day = dt.date(2024, 1, 1) + dt.timedelta(days=rng.randint(0, 300))
        yield (i, k, rng.choice([None, "", "a", f"w{rng.randint(0, 900)}"]), day, dt.datetime(2024, 1, 1, rng.randint(0, 23), i % 60), decimal.Decimal(rng.randint(0, 9999)) / 100, rng.choice([0.0, float("nan"), rng.random()]), None)


COLS = ["k", "s", "d", "t", "x", "f"]


@pytest.fixture(scope="module")
def table(spark, tmp_path_factory):
    """Rows dealt over 20 files by a hash, so that no column is in any order."""
    folder = tmp_path_factory.mktemp("skipping")
    path, side = f"{folder}/t", f"{folder}/side"
    spark.createDataFrame(list(rows()), SCHEMA).repartition(20, "id").write.parquet(path)
    skipping.write_skipping(spark, path, COLS, side)
    return path, side


WANTED = [
    ({"k": [17, -3]}, "k IN (17, -3)"),
    ({"k": [None]}, "k IS NULL"),
    ({"k": [None, 40]}, "k IS NULL OR k = 40"),
    ({"k": [(450, None), (None, -450)]}, "k >= 450 OR k <= -450"),
    ({"k": [(490, 495), 3, None]}, "k BETWEEN 490 AND 495 OR k = 3 OR k IS NULL"),
    ({"k": [(None, None)]}, "k IS NOT NULL"),
    ({"k": []}, "false"),
    ({"k": [12345678901]}, "false"),
    ({"k": [17.0, 2.5]}, "k = 17"),
    ({"s": ["w17", ""]}, "s IN ('w17', '')"),
    ({"s": [("w88", None)], "k": [(0, None)]}, "s >= 'w88' AND k >= 0"),
    ({"d": [dt.date(2024, 5, 5)]}, "d = DATE '2024-05-05'"),
    ({"t": [dt.datetime(2024, 1, 1, 5, 7)]}, "t = TIMESTAMP '2024-01-01 05:07:00'"),
    ({"x": [decimal.Decimal("12.34"), 50]}, "x IN (12.34, 50)"),
    ({"f": [0.0]}, "f = 0"),
    ({"f": [(0.9, None)]}, "f >= 0.9"),
]


@pytest.mark.parametrize("wanted, cond", WANTED, ids=[c for _, c in WANTED])
def test_lookups_equal_the_plain_filter(spark, table, wanted, cond):
    path, side = table
    found = skipping.skipping_lookup(spark, path, side, wanted, ["id", "k"])
    same_rows(found, f"SELECT id, k FROM t WHERE {cond}", t=spark.read.parquet(path).drop("m"))


def test_a_point_lookup_opens_few_files(spark, table):
    path, side = table
    ids = spark.read.parquet(path).where("k IS NOT NULL").groupBy("k").count().where("count = 1").limit(3).collect()
    for row in ids:
        found = skipping.skipping_lookup(spark, path, side, {"k": [row["k"]]})
        # One file holds the value; the maps let others through by chance only.
        assert files_scanned(found) <= 4 and found.count() == 1
        assert rows_scanned(found) < 120
    assert files_scanned(spark.read.parquet(path).where(F.col("k") == ids[0]["k"])) == 20
    # No file holds this value, though it is between the least and the greatest of most.
    lost = next(v for v in range(-400, 400) if not spark.read.parquet(path).where(F.col("k") == v).count())
    assert files_scanned(skipping.skipping_lookup(spark, path, side, {"k": [lost]})) <= 3


def test_new_and_changed_files_are_opened_and_then_known(spark, tmp_path):
    path, side = f"{tmp_path}/t", f"{tmp_path}/side"
    spark.range(100).repartition(4, "id").write.parquet(path)
    skipping.write_skipping(spark, path, "id", side)
    assert skipping.extend_skipping(spark, path, side) == 0
    spark.range(1000, 1100).coalesce(1).write.mode("append").parquet(path)
    look = lambda v: skipping.skipping_lookup(spark, path, side, {"id": [v]})
    assert look(1050).count() == 1 and look(7).count() == 1
    assert skipping.files_to_open(spark, path, side, {"id": [5000]}).count() == 1
    assert skipping.extend_skipping(spark, path, side) == 1
    assert skipping.files_to_open(spark, path, side, {"id": [5000]}).count() == 0
    assert look(1050).count() == 1 and files_scanned(look(1050)) == 1
    spark.range(5000, 5001).coalesce(1).write.mode("overwrite").parquet(path)
    assert look(5000).count() == 1 and look(7).count() == 0


def test_partitioned_and_empty_tables(spark, tmp_path):
    path, side = f"{tmp_path}/p", f"{tmp_path}/ps"
    spark.range(60).select("id", (F.col("id") % 3).cast("string").alias("a b")).repartition(3, "id").write.partitionBy("a b").parquet(path)
    skipping.write_skipping(spark, path, ["id"], side)
    assert skipping.skipping_lookup(spark, path, side, {"id": [8, 59]}).count() == 2
    none, side = f"{tmp_path}/e", f"{tmp_path}/es"
    spark.range(0).write.parquet(none)
    skipping.write_skipping(spark, none, "id", side)
    assert skipping.skipping_lookup(spark, none, side, {"id": [8]}).count() == 0


def test_many_values_get_several_maps(spark, tmp_path):
    path, side = f"{tmp_path}/t", f"{tmp_path}/side"
    spark.range(40_000).select(F.xxhash64("id").alias("v")).repartition(4).write.parquet(path)
    skipping.write_skipping(spark, path, "v", side)
    assert spark.read.parquet(side).select(F.max("maps_v")).first()[0] >= 3
    one = spark.read.parquet(path).first()["v"]
    assert files_scanned(skipping.skipping_lookup(spark, path, side, {"v": [one]})) <= 2


def test_text_under_another_rule_has_no_maps(spark, tmp_path):
    path, side = f"{tmp_path}/t", f"{tmp_path}/side"
    spark.sql("SELECT id, (CASE WHEN id % 2 = 0 THEN 'Ab' ELSE 'zz' END) COLLATE UTF8_LCASE AS c FROM range(10)").write.parquet(path)
    skipping.write_skipping(spark, path, "c", side)
    assert "maps_c" not in spark.read.parquet(side).columns
    assert skipping.skipping_lookup(spark, path, side, {"c": ["aB"]}).count() == 5
