import re

import pytest
from pyspark.sql import functions as F

from tunesmith.plans.inspect import plan_text, settings
from tunesmith.sources import buckets
from tunesmith.sources.scratch import released

TYPES = ["inner", "left", "right", "full", "left_semi", "left_anti"]


def same(joined, plain):
    assert sorted(map(str, joined.select(plain.columns).collect())) == sorted(map(str, plain.collect()))


@pytest.fixture(scope="module")
def sides(spark):
    hot = [(0, i) for i in range(60)] + [(None, i) for i in range(30)]
    l = spark.createDataFrame([(k % 23, k) for k in range(80)] + hot, "a int, x int")
    r = spark.createDataFrame([(k % 31, k) for k in range(50)] + [(7, 100 + i) for i in range(40)] + [(None, 1), (None, 2)], "b int, y int")
    return l, r


def exchanges(df):
    return re.findall(r"Exchange (?:hash|range)partitioning", plan_text(df))


@pytest.mark.parametrize("how", TYPES)
@pytest.mark.parametrize("hot", [None, 20], ids=["all in buckets", "hot keys apart"])
def test_every_join_type(spark, sides, how, hot):
    l, r = sides
    with released(spark):
        left, right = buckets.write_bucketed(l, "a", 4, hot), buckets.write_bucketed(r, "b", 4, hot)
        assert (left.hot is not None) == (right.hot is not None) == bool(hot)
        same(buckets.bucketed_join(left, right, how=how, hot_rows=hot), l.join(r, l.a == r.b, how))


def test_hot_keys_are_in_no_bucket(spark, sides):
    with released(spark):
        stored = buckets.write_bucketed(sides[0], "a", 4, 20)
        assert stored.cold.where("a = 0 OR a IS NULL").count() == 0 and stored.rest.count() == 60 + 4 + 30
        assert stored.rows().count() == sides[0].count()


@pytest.mark.parametrize("how", TYPES)
def test_no_row_is_shuffled(spark, sides, how):
    with released(spark), settings(spark, spark__sql__autoBroadcastJoinThreshold=-1):
        left, right = (buckets.write_bucketed(t, k, 4) for t, k in zip(sides, "ab"))
        if how != "left_semi":
            assert not exchanges(buckets.bucketed_join(left, right, how=how))
        assert len(exchanges(sides[0].join(sides[1].hint("merge"), F.col("a") == F.col("b"), how))) == 2
        # One file a bucket.
        files = left.cold.select(F.col("_metadata.file_path")).distinct().count()
        assert files <= 4


def test_two_keys_and_grouping_by_them(spark):
    df = spark.range(500).select((F.col("id") % 7).alias("a"), (F.col("id") % 5).cast("string").alias("b"), "id")
    with released(spark):
        one, two = buckets.write_bucketed(df, ["a", "b"], 3), buckets.write_bucketed(df.drop("id").distinct(), ["a", "b"], 3)
        joined = buckets.bucketed_join(one, two)
        assert joined.count() == 500
        # Groups on the bucket keys need no shuffle either.
        assert not exchanges(one.cold.groupBy("a", "b").count())


def test_unfit_tables_are_refused(spark, sides):
    with released(spark):
        left, right = buckets.write_bucketed(sides[0], "a", 4), buckets.write_bucketed(sides[1], "b", 2)
        with pytest.raises(ValueError, match="shuffled"):
            buckets.bucketed_join(left, right)
        with pytest.raises(ValueError, match="bucket keys"):
            buckets.bucketed_join(left, right, [("x", "b")])


def test_released_drops_tables_and_files(spark, sides):
    with released(spark):
        stored = buckets.write_bucketed(sides[0], "a", 2)
        place = spark._jvm.org.apache.hadoop.fs.Path(spark.table(stored.name).inputFiles()[0])
        files = place.getFileSystem(spark._jsc.hadoopConfiguration())
        assert spark.catalog.tableExists(stored.name) and files.exists(place)
    assert not spark.catalog.tableExists(stored.name) and not files.exists(place)


def test_empty_sides(spark, sides):
    with released(spark):
        none = buckets.write_bucketed(sides[1].limit(0), "b", 4)
        left = buckets.write_bucketed(sides[0], "a", 4)
        assert buckets.bucketed_join(left, none).count() == 0
        assert buckets.bucketed_join(left, none, how="left").count() == sides[0].count()


def test_number_of_buckets_follows_the_size(spark, monkeypatch):
    df = spark.range(100_000)
    monkeypatch.setattr(buckets, "BUCKET_BYTES", 100_000)
    assert buckets.buckets_for(df) == 8 and buckets.buckets_for(df.limit(0), df) == 8


def test_buckets_follow_rows_in_memory_not_compressed_files(spark, monkeypatch, tmp_path):
    df = spark.range(60_000).select((F.col("id") % 3).alias("a"), F.lit(1).cast("long").alias("b"), F.repeat(F.lit("x"), F.lit(84)).alias("c"))
    df.write.parquet(f"{tmp_path}/alike")
    alike = spark.read.parquet(f"{tmp_path}/alike")
    monkeypatch.setattr(buckets, "BUCKET_BYTES", 600_000)
    assert buckets.buckets_for(alike) == 60_000 * (3 * 8 + 84) // 600_000 + 1
    # Narrow rows take far more than their values where they are sorted.
    monkeypatch.setattr(buckets, "HOT_ROWS", 1_000)
    assert buckets.buckets_for(alike.select("a"), alike.limit(10)) == 60
