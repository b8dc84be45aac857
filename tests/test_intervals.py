import datetime as dt
import random
import re

import pytest
from oracle_check import same_rows
from pyspark.sql import functions as F

from tunesmith.operators import advanced_joins
from tunesmith.operators.intervals import interval_join
from tunesmith.plans.inspect import plan_nodes, plan_text, settings

BASE = dt.datetime(2024, 3, 10)
KINDS = {
    "double": float,
    "long": int,
    "decimal(12,3)": lambda x: __import__("decimal").Decimal(int(x * 8)) / 8,
    "date": lambda x: (BASE + dt.timedelta(days=x)).date(),
    "timestamp_ntz": lambda x: BASE + dt.timedelta(hours=x),
    "timestamp": lambda x: BASE + dt.timedelta(hours=x),
}


def intervals(n, seed, make):
    rng = random.Random(seed)
    for i in range(n):
        start = rng.uniform(-100, 100)
        yield (i, rng.choice(["a", "b", None]), make(start), make(start + rng.choice([0, 0.001, 0.5, 1, 3, 40, 300, -1])))
    # A NULL end, touching ends, and the same interval twice.
    yield from [(n, "a", None, make(5)), (n + 1, "a", make(5), None), (n + 2, "b", make(1), make(2)), (n + 3, "b", make(2), make(3)), (n + 4, "b", make(2), make(3))]


@pytest.mark.parametrize("kind", KINDS)
@pytest.mark.parametrize("closed", [False, True])
def test_equals_the_nested_loop(spark, kind, closed):
    l = spark.createDataFrame(list(intervals(80, 1, KINDS[kind])), f"id long, k string, s {kind}, e {kind}")
    r = spark.createDataFrame(list(intervals(70, 2, KINDS[kind])), f"rid long, k string, rs {kind}, re {kind}")
    less = "<=" if closed else "<"
    same_rows(
        interval_join(l, r, ("s", "e"), ("rs", "re"), "k", closed).select("id", "k", "rid"),
        f"SELECT id, l.k, rid FROM l JOIN r ON l.k = r.k AND s {less} re AND rs {less} e AND s {less} e AND rs {less} re",
        l=l,
        r=r,
    )


def test_hot_bins_and_no_keys(spark):
    l = spark.range(300).select("id", (F.col("id") % 3).cast("double").alias("s"), (F.col("id") % 3 + 0.5).alias("e"))
    r = spark.range(40).select(F.col("id").alias("rid"), F.lit(0.25).alias("rs"), F.lit(1.25).alias("re"))
    assert interval_join(l, r, ("s", "e"), ("rs", "re"), hot_rows=50).count() == 200 * 40


def test_no_nested_loop(spark):
    l = spark.range(10).select("id", F.col("id").alias("s"), (F.col("id") * 3).alias("e"))
    r = spark.range(10).select(F.col("id").alias("rid"), F.col("id").alias("rs"), (F.col("id") + 1).alias("re"))
    with settings(spark, spark__sql__autoBroadcastJoinThreshold=-1):
        nodes = plan_nodes(interval_join(l, r, ("s", "e"), ("rs", "re")))
    assert not {"BroadcastNestedLoopJoin", "CartesianProduct"} & set(nodes) and "SortMergeJoin" in nodes


def test_long_and_short_intervals_meet_with_few_copies(spark):
    """A million times longer intervals: copies grow with the number of lengths, not with the length."""
    from tunesmith.operators import intervals as module

    l = spark.range(100).select("id", F.col("id").cast("double").alias("s"), (F.col("id") + 1_000_000.0).alias("e"))
    r = spark.range(1000).select(F.col("id").alias("rid"), F.col("id").cast("double").alias("rs"), (F.col("id") + 0.5).alias("re"))
    left, right = (module._levelled(df, ends, False) for df, ends in ((l, ("s", "e")), (r, ("rs", "re"))))
    assert module._in_bins(left, F.col("__level")).count() <= 3 * 100
    assert module._copied_up(right, left, True).count() <= 3 * 1000
    assert interval_join(l, r, ("s", "e"), ("rs", "re")).count() == sum(1 for a in range(100) for b in range(1000) if a < b + 0.5)


def test_rows_that_meet_in_a_bin_are_mostly_pairs(spark, monkeypatch):
    from tunesmith.operators import intervals as module

    met, join = [], module.skew_join
    monkeypatch.setattr(module, "skew_join", lambda *a, **k: met.append(join(*a, **k)) or met[-1])
    l = spark.range(400).select("id", (F.col("id") * 7).alias("s"), (F.col("id") * 7 + 300 + F.col("id") % 150).alias("e"))
    r = spark.range(400).select(F.col("id").alias("rid"), (F.col("id") * 7 + 3).alias("rs"), (F.col("id") * 7 + 250 + F.col("id") % 90).alias("re"))
    pairs = interval_join(l, r, ("s", "e"), ("rs", "re")).count()
    assert sum(m.count() for m in met) < 1.4 * pairs


def test_tasks_are_not_merged_and_conditions_compare_columns_alone(spark):
    """Few rows make very many pairs: AQE would put all bins into one task by their bytes."""
    l = spark.range(100).select("id", F.col("id").alias("s"), (F.col("id") + 50).alias("e"))
    r = spark.range(100).select(F.col("id").alias("rid"), F.col("id").alias("rs"), (F.col("id") + 40).alias("re"))
    joined = interval_join(l, r, ("s", "e"), ("rs", "re"))
    tasks = joined.select(F.spark_partition_id().alias("p")).distinct().count()
    joins = [x for x in plan_text(joined).splitlines() if "SortMergeJoin" in x]
    assert tasks > 8 and len(joins) == 2 and not any("POWER" in x for x in joins)


def test_late_columns_and_places_are_not_shuffled(spark):
    l = spark.range(300).select("id", F.col("id").alias("s"), (F.col("id") + 20).alias("e"))
    r = spark.range(100).select(F.col("id").alias("rid"), (F.col("id") * 3).alias("rs"), (F.col("id") * 3 + 7).alias("re"))
    late = ({"text": F.concat(F.lit("s"), F.col("s").cast("string"))}, {"twice": F.col("rs") * 2})
    for hot in ({}, {"hot_rows": 20}):
        joined = interval_join(l, r, ("s", "e"), ("rs", "re"), late=late, **hot)
        assert joined.columns == ["id", "s", "e", "text", "rid", "rs", "re", "twice"]
        want = {(i, j, f"s{i}", 6 * j) for i in range(300) for j in range(100) if i < 3 * j + 7 and 3 * j < i + 20}
        got = [tuple(x) for x in joined.select("id", "rid", "text", "twice").collect()]
        assert len(got) == len(want) and set(got) == want
    # What is shuffled is a side's own columns, a level and a bin.
    lines = plan_text(interval_join(l, r, ("s", "e"), ("rs", "re"), late=late)).splitlines()
    below = [lines[i + 1] for i, x in enumerate(lines) if "Exchange hashpartitioning(__at" in x]
    moved = [sorted(re.findall(r"(\w+)#", x[x.rindex("[", 0, x.rindex(", false, [")) :])) for x in below]
    assert sorted(moved) == [["__at", "__bin", "e", "id", "s"]] * 2 + [["__at", "__bin", "re", "rid", "rs"]] * 2
    with pytest.raises(ValueError, match="there already"):
        interval_join(l, r, ("s", "e"), ("rs", "re"), late=({"id": F.lit(1)}, {}))
    with pytest.raises(ValueError, match="both sides"):
        interval_join(l, r, ("s", "e"), ("rs", "re"), late=({"rid": F.lit(1)}, {}))


def test_each_pair_of_touching_and_equal_starts_comes_once(spark):
    l = spark.createDataFrame([(1, 0, 8), (2, 8, 16), (3, 5, 6), (4, 0, 8)], "id long, s int, e int")
    r = spark.createDataFrame([(1, 0.0, 8.0), (2, 5.0, 5.5), (3, 7.999, 8.0)], "rid long, rs double, re double")
    got = sorted(tuple(x) for x in interval_join(l, r, ("s", "e"), ("rs", "re")).select("id", "rid").collect())
    assert got == [(1, 1), (1, 2), (1, 3), (3, 1), (3, 2), (4, 1), (4, 2), (4, 3)]
    got = sorted(tuple(x) for x in interval_join(l, r, ("s", "e"), ("rs", "re"), closed=True).select("id", "rid").collect())
    assert got == [(1, 1), (1, 2), (1, 3), (2, 1), (2, 3), (3, 1), (3, 2), (4, 1), (4, 2), (4, 3)]


def test_endless_intervals(spark):
    inf = float("inf")
    l = spark.createDataFrame([(1, 0.0, inf), (2, -inf, inf), (3, 5.0, 6.0), (4, inf, inf)], "id long, s double, e double")
    r = spark.createDataFrame([(1, 1e300, 1e301), (2, 5.5, 5.6), (3, -1e308, -1e307)], "rid long, rs double, re double")
    got = sorted(tuple(x) for x in interval_join(l, r, ("s", "e"), ("rs", "re")).select("id", "rid").collect())
    assert got == [(1, 1), (1, 2), (2, 1), (2, 2), (2, 3), (3, 2)]


def test_empty_sides_and_refusals(spark):
    l = spark.createDataFrame([(1, 0.0, 1.0)], "id long, s double, e double")
    r = spark.createDataFrame([], "rid long, rs double, re double")
    assert interval_join(l, r, ("s", "e"), ("rs", "re")).count() == 0 and interval_join(r, l, ("rs", "re"), ("s", "e")).count() == 0
    with pytest.raises(ValueError, match="both sides"):
        interval_join(l, l, ("s", "e"), ("s", "e"))
    with pytest.raises(TypeError, match="different kinds"):
        interval_join(l, spark.createDataFrame([], "rid long, rs date, re date"), ("s", "e"), ("rs", "re"))


# Bands of dates and stamps


@pytest.mark.parametrize("kind, width, sql", [("timestamp_ntz", dt.timedelta(minutes=90), "INTERVAL 90 MINUTE"), ("timestamp", dt.timedelta(seconds=1), "INTERVAL 1 SECOND"), ("date", dt.timedelta(days=3), "INTERVAL 3 DAY")])
def test_bands_of_stamps(spark, kind, width, sql):
    l = spark.createDataFrame([(a, c) for a, _, c, _ in intervals(60, 3, KINDS[kind])], f"id long, s {kind}")
    r = spark.createDataFrame([(a, c) for a, _, c, _ in intervals(60, 3, KINDS[kind])], f"rid long, rs {kind}")
    same_rows(advanced_joins.band_join(l, r, "s", "rs", width).select("id", "rid"), f"SELECT id, rid FROM l JOIN r ON s BETWEEN rs - {sql} AND rs + {sql}", l=l, r=r)


@pytest.mark.parametrize("kind, end", [("tinyint", 127), ("int", 2**31 - 1), ("bigint", 2**63 - 1)])
def test_bands_at_the_end_of_a_type(spark, kind, end):
    l = spark.createDataFrame([(1, end), (2, end - 7), (3, -end - 1), (4, None)], f"id long, s {kind}")
    r = spark.createDataFrame([(1, end - 2), (2, -end), (3, None)], f"rid long, rs {kind}")
    got = sorted((x["id"], x["rid"]) for x in advanced_joins.band_join(l, r, "s", "rs", 5).collect())
    assert got == [(1, 1), (2, 1), (3, 2)]


def test_bands_of_other_kinds_are_refused(spark):
    l, r = spark.createDataFrame([(BASE,)], "s timestamp_ntz"), spark.createDataFrame([(1,)], "rs int")
    with pytest.raises(TypeError):
        advanced_joins.band_join(l, r, "s", "rs", 5)
    with pytest.raises(TypeError, match="timedelta"):
        advanced_joins.band_join(l, l.withColumnRenamed("s", "rs"), "s", "rs", 5)
    days = spark.createDataFrame([(BASE.date(),)], "s date")
    with pytest.raises(ValueError, match="whole days"):
        advanced_joins.band_join(days, days.withColumnRenamed("s", "rs"), "s", "rs", dt.timedelta(hours=5))
