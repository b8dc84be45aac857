import datetime as dt

import pytest
from pyspark.sql import functions as F

from tunesmith.operators import lookup
from tunesmith.plans.inspect import rows_scanned, settings
from tunesmith.sources import layout
from tunesmith.sources.tables import table

SF01 = "/root/testdata/sf0.1"


@pytest.fixture(scope="module")
def orders(spark):
    return table(spark, SF01, "orders")


def test_clustered_layout_skips_rows(spark, orders, tmp_path):
    path = str(tmp_path / "by-date")
    layout.write_clustered(orders, path, "o_orderdate", files=8)
    lo, hi = dt.datetime(1997, 3, 1), dt.datetime(1997, 3, 31)
    found = layout.key_range(spark, path, "o_orderdate", lo, hi)
    plain = orders.where("o_orderdate BETWEEN timestamp_ntz'1997-03-01' AND timestamp_ntz'1997-03-31'")
    assert found.columns == orders.columns
    assert found.exceptAll(plain).isEmpty() and plain.exceptAll(found).isEmpty()
    assert rows_scanned(plain) == 150_000
    assert rows_scanned(layout.key_range(spark, path, "o_orderdate", lo, hi, ["o_totalprice"])) < 40_000


def test_clustered_layout_equality_and_open_ranges(spark, orders, tmp_path):
    path = str(tmp_path / "by-customer")
    layout.write_clustered(orders, path, ["o_custkey", "o_orderdate"], files=8)
    assert layout.key_range(spark, path, "o_custkey", 77, 77).count() == orders.where("o_custkey = 77").count()
    assert layout.key_range(spark, path, "o_custkey", lo=14_000).count() == orders.where("o_custkey >= 14000").count()
    assert layout.key_range(spark, path, "o_custkey", hi=9).count() == orders.where("o_custkey <= 9").count()
    assert rows_scanned(layout.key_range(spark, path, "o_custkey", 77, 77)) < 40_000


def test_hot_value_fills_several_files(spark, tmp_path):
    path = str(tmp_path / "hot")
    df = spark.range(40_000).select(F.when(F.col("id") % 3 == 0, F.col("id")).otherwise(7).alias("k"), "id")
    layout.write_clustered(df, path, "k", files=8)
    sizes = [r["count"] for r in spark.read.parquet(path).groupBy(F.col("_metadata.file_path")).count().collect()]
    assert len(sizes) == 8 and max(sizes) < 10_000
    assert layout.clustering_factor(spark, path, "k").first()["switches"] == 7


def test_clustering_factor_tells_layouts_apart(spark, orders, tmp_path):
    good, bad = str(tmp_path / "good"), str(tmp_path / "bad")
    small = orders.where("o_custkey < 1000").select("o_orderkey")
    layout.write_clustered(small, good, "o_orderkey", files=4)
    small.repartition(4, F.xxhash64("o_orderkey")).write.parquet(bad)
    for hot_rows in (None, 500):
        a = layout.clustering_factor(spark, good, "o_orderkey", hot_rows).first()
        b = layout.clustering_factor(spark, bad, "o_orderkey", hot_rows).first()
        assert a["blocks"] == b["blocks"] == 4 and a["switches"] == 3
        assert b["switches"] > b["rows"] / 2
    # Brute force: walk all rows on the driver.
    walk = spark.read.parquet(bad).select("o_orderkey", F.col("_metadata.file_path").alias("f")).collect()
    files = [f for _, f in sorted((r["o_orderkey"], r["f"]) for r in walk)]
    assert b["switches"] == sum(x != y for x, y in zip(files, files[1:]))


def test_partitioned_layout_opens_only_its_folders(spark, orders, tmp_path):
    path = str(tmp_path / "by-status")
    layout.write_partitioned(orders, path, "o_orderstatus")
    found = layout.read_partitioned(spark, path, F.col("o_orderstatus") == "F", ["o_orderkey"])
    n = orders.where("o_orderstatus = 'F'").count()
    assert found.count() == n and rows_scanned(found) == n
    foot = layout.scan_footprint(spark, path, F.col("o_orderstatus") == "F").first()
    assert (foot["folders_total"], foot["folders_hit"], foot["rows_hit"]) == (3, 1, n)
    # Few files: not one per task and value.
    assert foot["files_total"] == 3


def test_footprint_of_unsorted_table_touches_every_file(spark, orders, tmp_path):
    path = str(tmp_path / "random")
    orders.repartition(8, F.xxhash64("o_orderkey")).write.parquet(path)
    cond = F.col("o_orderdate") < F.lit("1995-07-01").cast("timestamp_ntz")
    foot = layout.scan_footprint(spark, path, cond).first()
    assert foot["files_hit"] == foot["files_total"] == 8
    assert foot["rows_total"] == 150_000 and foot["rows_hit"] == orders.where(cond).count()
    assert foot["bytes_hit"] == foot["bytes_total"] > 0
    none = layout.scan_footprint(spark, path, F.lit(None).cast("boolean")).first()
    assert none["rows_hit"] == none["files_hit"] == none["bytes_hit"] == 0


def test_large_partition_value_is_split_over_files(spark, tmp_path):
    path = str(tmp_path / "hot")
    df = spark.range(200_000).select(
        F.when(F.col("id") % 10 == 0, "cold").otherwise("hot").alias("g"), "id", F.sha2(F.col("id").cast("string"), 256).alias("t")
    )
    with settings(spark, spark__sql__adaptive__advisoryPartitionSizeInBytes="2MB"):
        layout.write_partitioned(df.repartition(8), path, "g")
    found = spark.read.parquet(path)
    files = {r["g"]: r["n"] for r in found.groupBy("g").agg(F.count_distinct("_metadata.file_path").alias("n")).collect()}
    assert files["hot"] > 3 and files["cold"] <= 2
    assert found.count() == 200_000


def test_number_of_files_follows_the_size(spark, orders, monkeypatch):
    assert layout.files_for(orders) == 1 and layout.files_for(orders, least=8) == 8
    monkeypatch.setattr(layout, "FILE_BYTES", 500_000)
    assert layout.files_for(orders) == 6


def test_lookups_skip_rows_of_a_clustered_table(spark, orders, tmp_path):
    by_date, by_key = str(tmp_path / "by-date"), str(tmp_path / "by-key")
    layout.write_clustered(orders, by_date, "o_orderdate", files=8)
    layout.write_clustered(orders, by_key, "o_orderkey", files=8)
    dated, keyed = spark.read.parquet(by_date), spark.read.parquet(by_key)

    def plain(df):
        return sorted(tuple(r) for r in df.select(orders.columns).collect())

    days = spark.sql("SELECT timestamp_ntz'1995-02-03' AS day UNION ALL SELECT timestamp_ntz'1995-02-07'")
    spring = [(dt.datetime(1995, 3, 1), dt.datetime(1995, 3, 31))]
    found = lookup.in_list(dated, "o_orderdate", days, spring)
    assert plain(found) == plain(lookup.in_list(orders, "o_orderdate", days, spring))
    assert rows_scanned(found) < 50_000

    after = [dt.datetime(1995, 2, 3), 5_000]
    for ways in (("desc", "asc"), ("asc", "desc")):
        order = list(zip(["o_orderdate", "o_orderkey"], ways))
        page = lookup.keyset_page(dated, order, after, 30)
        assert plain(page) == plain(lookup.keyset_page(orders, order, after, 30))
        if ways[0] == "desc":
            assert rows_scanned(page) < 50_000

    dear = [("o_totalprice", "desc"), ("o_orderkey", "asc")]
    best = lookup.late_fetch(keyed, "o_orderkey", dear, 2, ["o_custkey", "o_orderpriority"])
    assert best.collect() == lookup.late_fetch(orders, "o_orderkey", dear, 2, ["o_custkey", "o_orderpriority"]).collect()
    assert rows_scanned(best) < 50_000
