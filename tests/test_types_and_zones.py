"""Results that must not depend on a list's length, the session's zone, names, or the order of rows."""

import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F, types as T

from tunesmith.operators import advanced_joins, design, lookup, workload
from tunesmith.plans.inspect import settings
from tunesmith.sources import layout

# Table, list, rows wanted: comparisons in the type that holds both sides.
LISTS = [
    ("VALUES 1, 2, 3", "VALUES 1.5, 3.0", ["3"]),
    ("VALUES 1.25BD, 2.00BD", "VALUES 1.254, 2.000", ["2.00"]),
    ("VALUES '01', '2', '3'", "VALUES 1, 2", ["01", "2"]),
    ("VALUES date'2024-01-01'", "VALUES timestamp_ntz'2024-01-01 12:00:00'", []),
    ("VALUES date'2024-01-01'", "VALUES timestamp_ntz'2024-01-01 00:00:00'", ["2024-01-01"]),
    ("VALUES 1, 7", "VALUES 8589934592, 7L", ["7"]),
    ("VALUES collate('a', 'UTF8_LCASE'), collate('b', 'UTF8_LCASE'), collate('c', 'UTF8_LCASE')", "VALUES 'a', 'C'", ["a", "c"]),
    ("VALUES 1, 2, NULL", "VALUES 1, 1, NULL", ["1"]),
]


@pytest.mark.parametrize("have, given, want", LISTS)
@pytest.mark.parametrize("literal", [1000, 1, 0])
def test_lists_of_any_length_and_type(spark, monkeypatch, have, given, want, literal):
    monkeypatch.setattr(lookup, "LITERAL_LIST", literal)
    df, values = spark.sql(f"SELECT col1 AS k FROM {have}"), spark.sql(f"SELECT col1 AS v FROM {given}")
    found = lookup.in_list(df, "k", values)
    assert sorted(str(r[0]) for r in found.collect()) == want


def test_bounds_keep_their_type(spark, tmp_path):
    df = spark.sql("SELECT col1 AS k FROM VALUES 1L, 2L, 3L")
    path = str(tmp_path / "t")
    layout.write_clustered(df, path, "k", files=1)
    assert sorted(r[0] for r in layout.key_range(spark, path, "k", lo=1.5).collect()) == [2, 3]
    assert sorted(r[0] for r in layout.key_range(spark, path, "k", hi=Decimal("2.5")).collect()) == [1, 2]
    assert sorted(r[0] for r in layout.key_range(spark, path, "k", lo=-(2**70)).collect()) == [1, 2, 3]
    assert sorted(r[0] for r in lookup.in_list(df, "k", df.where("false"), [(1.5, 3)]).collect()) == [2, 3]
    assert [r[0] for r in lookup.keyset_page(df, [("k", "asc")], [1.5], 9).collect()] == [2, 3]


@pytest.mark.parametrize("literal", [10_000, 0])
def test_late_fetch_by_a_collated_key(spark, monkeypatch, literal):
    monkeypatch.setattr(lookup, "LITERAL_KEYS", literal)
    df = spark.sql("SELECT collate(col1, 'UTF8_LCASE') AS k, col2 AS n FROM VALUES ('B', 1), ('a', 2), ('c', 3)")
    got = [r["n"] for r in lookup.late_fetch(df, "k", [("k", "asc"), ("n", "asc")], 2, ["n"]).collect()]
    assert got == [2, 1]


def test_zoned_keys_are_found_in_any_zone(spark, tmp_path):
    path = str(tmp_path / "z")
    at = dt.datetime(2024, 1, 1, 2, 30, tzinfo=dt.timezone.utc)
    layout.write_clustered(spark.createDataFrame([(at, 1)], "ts timestamp, id int"), path, "ts", files=1)
    for zone in ("UTC", "America/New_York", "Asia/Tokyo"):
        with settings(spark, spark__sql__session__timeZone=zone):
            lo, hi = at - dt.timedelta(hours=1), at + dt.timedelta(hours=1)
            assert layout.key_range(spark, path, "ts", lo, hi).count() == 1
            stored = spark.read.parquet(path)
            assert lookup.keyset_page(stored, [("ts", "asc"), ("id", "asc")], [lo, 0], 5).count() == 1
            assert lookup.in_list(stored, "ts", stored.select("ts")).count() == 1


def test_day_columns_of_the_user(spark, tmp_path):
    df = spark.sql("SELECT timestamp_ntz'2024-01-02 03:00:00' AS pay, 5 AS k, date'1999-01-01' AS other__day")
    path = str(tmp_path / "d")
    layout.write_clustered(df, path, "pay", files=1)
    assert layout.key_range(spark, path, "pay", lo=dt.datetime(2024, 1, 1)).columns == ["pay", "k", "other__day"]
    own = df.withColumnRenamed("other__day", "pay__day")
    with pytest.raises(ValueError, match="pay__day"):
        layout.write_clustered(own, str(tmp_path / "e"), "pay", files=1)
    layout.write_clustered(own, str(tmp_path / "f"), "k", files=1)
    assert layout.key_range(spark, str(tmp_path / "f"), "pay", lo=dt.datetime(2024, 1, 1)).collect() == own.collect()


def test_partitions_keep_values_and_types(spark, tmp_path):
    schema = T.StructType().add("code", T.StringType()).add("day", T.StringType()).add("v", T.IntegerType())
    rows = [("007", "2024-01-01", 1), ("7", "x", 2), (None, None, 3), ("1e3", "2024-01-01", 4)]
    df = spark.createDataFrame(rows, schema)
    path = str(tmp_path / "p")
    layout.write_partitioned(df, path, ["code", "day"])
    back = layout.written(spark, path)
    assert {f.name: f.dataType for f in back.schema} == {f.name: f.dataType for f in schema}
    assert sorted(map(tuple, back.select("code", "day", "v").collect()), key=str) == sorted(rows, key=str)
    assert layout.read_partitioned(spark, path, F.col("code") == "007").count() == 1
    assert layout.scan_footprint(spark, path, F.col("code") == "007").first()["rows_total"] == 4


def test_small_numbers_are_not_rounded_away(spark):
    one = design.column_selectivity(spark.range(4_000_000).select(F.lit(1).alias("x")), ["x"]).first()
    assert one["selectivity"] == 2.5e-7
    tiny = spark.createDataFrame([("a", 4e-8)] * 3, "g string, x double")
    assert [r["value"] for r in workload.response_percentiles(tiny, ["g"], "x", [0.5]).collect()] == [4e-8]
    means = workload.trace_profile(tiny, "g", F.col("x").cast("decimal(20,10)")).first()
    assert means["mean"] == pytest.approx(4e-8) and means["share"] == 1.0


def test_ties_do_not_follow_the_order_of_rows(spark):
    stamp = dt.datetime(2024, 1, 1)
    rows = [(1, 0, stamp), (2, 0, stamp + dt.timedelta(seconds=100)), (3, 0, stamp + dt.timedelta(seconds=100))]
    for given in (rows, rows[::-1]):
        log = spark.createDataFrame(given, "id int, s int, ts timestamp_ntz").repartition(3)
        assert [r["id"] for r in workload.wait_gaps(log, "s", "ts", 50, "id").collect()] == [2]
    left = spark.createDataFrame([(0, 9)], "s int, t int")
    found = set()
    for given in ([(0, 1, 5), (0, 1, 6), (0, 1, 7)], [(0, 1, 7), (0, 1, 6), (0, 1, 5)]):
        for parts in (1, 3):
            right = spark.createDataFrame(given, "s int, t int, v int").repartition(parts).withColumnRenamed("t", "u")
            found |= {r["v"] for r in advanced_joins.asof_join(left, right, ["s"], ("t", "u")).collect()}
    assert len(found) == 1


def test_no_predicate_names_a_column(spark):
    uses = spark.createDataFrame([("nothing", "eq", 1)], "column_name string, kind string, uses bigint")
    assert design.layout_candidates(spark.range(3).toDF("id"), uses).collect() == []
