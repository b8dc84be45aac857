import datetime as dt
import decimal
import random

import pytest
from oracle_check import same_rows
from pyspark.sql import functions as F

from tunesmith.plans.inspect import files_scanned, rows_scanned
from tunesmith.sources import curves

FOLDER = "/root/testdata/sf0.1"


@pytest.fixture(scope="module")
def orders(spark):
    return spark.read.parquet(f"{FOLDER}/orders.parquet")


@pytest.fixture(scope="module")
def on_curve(spark, orders, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("curve") / "t")
    curves.write_zordered(orders, path, ["o_orderdate", "o_custkey"], 64)
    return path


MARCH = (dt.datetime(1997, 3, 1), dt.datetime(1997, 3, 31))


def test_a_range_on_either_key_scans_under_a_quarter(spark, orders, on_curve):
    total = orders.count()
    for box, cond in (({"o_custkey": (4000, 4500)}, "o_custkey BETWEEN 4000 AND 4500"), ({"o_orderdate": MARCH}, "o_orderdate BETWEEN TIMESTAMP_NTZ '1997-03-01' AND TIMESTAMP_NTZ '1997-03-31'")):
        found = curves.key_box(spark, on_curve, box)
        assert rows_scanned(found) < total / 4
        assert sorted(r["o_orderkey"] for r in found.collect()) == sorted(r["o_orderkey"] for r in orders.where(cond).collect())
    both = curves.key_box(spark, on_curve, {"o_custkey": (4000, 4500), "o_orderdate": MARCH})
    assert rows_scanned(both) < total / 16


def test_files_are_even_and_all_rows_are_there(spark, orders, on_curve):
    sizes = [r["n"] for r in spark.read.parquet(on_curve).groupBy(F.col("_metadata.file_path")).agg(F.count("*").alias("n")).collect()]
    assert len(sizes) == 64 and sum(sizes) == orders.count() and max(sizes) < 2 * sum(sizes) / 64


def odd_rows():
    rng = random.Random(4)
    for i in range(300):
        yield (i, rng.choice([None, "hot", "hot", "hot", f"s{rng.randint(0, 50)}"]), rng.choice([None, rng.randint(-9, 9)]), dt.date(2024, 1, 1) + dt.timedelta(days=i % 40), decimal.Decimal(i % 17) / 4, rng.random() < 0.5)


@pytest.mark.parametrize("keys", [["s", "k"], ["k", "d", "x"], ["s", "b"], ["d", "i"]], ids=str)
def test_boxes_on_any_types_equal_the_plain_filter(spark, tmp_path, keys):
    df = spark.createDataFrame(list(odd_rows()), "i int, s string, k int, d date, x decimal(8,2), b boolean")
    path = str(tmp_path / "t")
    curves.write_zordered(df, path, keys, 8)
    boxes = {"s": (("hot", None), "s >= 'hot'"), "k": ((-3, 4), "k BETWEEN -3 AND 4"), "d": ((None, dt.date(2024, 1, 9)), "d <= DATE '2024-01-09'"), "x": ((1, 2.5), "x BETWEEN 1 AND 2.5"), "b": ((None, None), "b IS NOT NULL"), "i": ((10, 99), "i BETWEEN 10 AND 99")}
    found = curves.key_box(spark, path, {k: boxes[k][0] for k in keys})
    same_rows(found, f"SELECT * FROM t WHERE {' AND '.join(boxes[k][1] for k in keys)}", t=df)
    assert spark.read.parquet(path).count() == 300


def test_a_value_that_most_rows_have_is_spread(spark, tmp_path):
    df = spark.range(40_000).select(F.when(F.col("id") % 10 < 9, 5).otherwise(F.col("id")).alias("a"), F.lit(1).alias("b"))
    curves.write_zordered(df, str(tmp_path / "t"), ["a", "b"], 8)
    sizes = [r["n"] for r in spark.read.parquet(str(tmp_path / "t")).groupBy(F.col("_metadata.file_path")).agg(F.count("*").alias("n")).collect()]
    assert sum(sizes) == 40_000 and max(sizes) < 15_000


def test_empty_table_and_refusals(spark, tmp_path):
    df = spark.createDataFrame([], "a int, t timestamp_ntz")
    curves.write_zordered(df, str(tmp_path / "e"), ["a", "t"], 4)
    assert curves.key_box(spark, str(tmp_path / "e"), {"a": (1, 2)}).columns == ["a", "t"]
    assert curves.key_box(spark, str(tmp_path / "e"), {"a": (1, 2)}).count() == 0
    with pytest.raises(ValueError, match="63 bits"):
        curves.write_zordered(df, str(tmp_path / "x"), ["a"] * 9)
    with pytest.raises(ValueError, match="taken"):
        curves.write_zordered(df.withColumn("t__day", F.lit(1)), str(tmp_path / "x"), ["a", "t"])


def test_interleaving(spark):
    df = spark.createDataFrame([(0b101, 0b011), (0b111, 0b000)], "a int, b int")
    assert [r[0] for r in df.select(curves.interleaved(["a", "b"], 3)).collect()] == [0b100111, 0b101010]


def test_scan_of_a_box_opens_few_files(spark, on_curve):
    # Spark opens files by their footers, so skipping shows in rows; all files are listed.
    found = curves.key_box(spark, on_curve, {"o_custkey": (1, 2)})
    assert files_scanned(found) == 64 and rows_scanned(found) < 150_000 / 4
