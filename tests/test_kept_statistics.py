import datetime as dt
import random

import pytest
from oracle_check import same_rows
from pyspark.sql import functions as F

from tunesmith.operators import design, estimates, lookup, sketches, workload
from tunesmith.plans.inspect import plan_nodes, rows_scanned
from tunesmith.sources import layout

FOLDER = "/root/testdata/sf0.1"


# Sketches


def test_sketches_of_parts_together_are_near_the_truth(spark, tmp_path):
    path = str(tmp_path / "s")
    orders = spark.read.parquet(f"{FOLDER}/orders.parquet")
    first, later = orders.where("o_orderkey % 3 < 2"), orders.where("o_orderkey % 3 = 2")
    part = F.year("o_orderdate")
    cols = ["o_custkey", "o_totalprice", "o_orderkey", "o_orderpriority", "o_orderdate"]
    sketches.write_sketches(first, F.concat(F.lit("a"), part.cast("string")), path, cols)
    sketches.write_sketches(later, F.concat(F.lit("b"), part.cast("string")), path, cols)
    found = {r["column_name"]: r for r in sketches.sketched_stats(spark, path, ps=(0.1, 0.5, 0.9)).collect()}
    for c in cols:
        true = orders.select(F.count_distinct(c)).first()[0]
        assert abs(found[c]["distinct_values"] - true) <= max(0.05 * true, 1), c
        assert found[c]["rows"] == orders.count() and found[c]["null_rows"] == 0
    for c in ("o_custkey", "o_totalprice"):
        for p, q in zip((0.1, 0.5, 0.9), found[c]["quantiles"]):
            assert abs(orders.where(F.col(c) <= q).count() / orders.count() - p) < 0.02
    assert found["o_orderpriority"]["quantiles"] is None and found["o_orderdate"]["greatest"] is None


def test_a_part_that_comes_again_takes_the_place_of_its_lines(spark, tmp_path):
    path = str(tmp_path / "s")
    df = spark.createDataFrame([("x", 1), ("x", 2), ("y", 9), ("y", None)], "p string, v int")
    sketches.write_sketches(df, F.col("p"), path, ["v"])
    sketches.write_sketches(spark.createDataFrame([("x", 5)], "p string, v int"), F.col("p"), path, ["v"])
    row = sketches.sketched_stats(spark, path).first()
    assert (row["rows"], row["null_rows"], row["least"], row["greatest"], row["distinct_values"]) == (3, 1, 5.0, 9.0, 2)
    row = sketches.sketched_stats(spark, path, F.col("part") == "y").first()
    assert (row["rows"], row["distinct_values"], row["quantiles"]) == (2, 1, [9.0, 9.0, 9.0])


def test_sketches_of_empty_and_null_columns(spark, tmp_path):
    df = spark.createDataFrame([(None, None), (None, None)], "v int, s string")
    sketches.write_sketches(df, F.lit("all"), str(tmp_path / "n"))
    rows = {r["column_name"]: r for r in sketches.sketched_stats(spark, str(tmp_path / "n")).collect()}
    assert rows["v"]["null_rows"] == 2 and rows["v"]["distinct_values"] == 0 and rows["v"]["quantiles"] is None
    sketches.write_sketches(df.limit(0), F.lit("all"), str(tmp_path / "e"))
    assert sketches.sketched_stats(spark, str(tmp_path / "e")).count() == 0


def test_layout_candidates_from_stored_sketches(spark, tmp_path):
    orders = spark.read.parquet(f"{FOLDER}/orders.parquet")
    uses = spark.createDataFrame([("o_orderpriority", "eq", 25), ("o_custkey", "join", 30), ("o_totalprice", "range", 9), ("gone", "eq", 99)], "column_name string, kind string, uses bigint")
    sketches.write_sketches(orders, F.lit("all"), str(tmp_path / "s"), ["o_orderpriority", "o_custkey", "o_totalprice"])
    exact = design.layout_candidates(orders, uses, max_partitions=100)
    stored = design.layout_candidates(orders, uses, max_partitions=100, profile=sketches.sketched_profile(spark, str(tmp_path / "s")))
    ranks = [sorted((r["role"], r["rank"], r["column_name"]) for r in df.collect()) for df in (exact, stored)]
    assert ranks[0] == ranks[1] and ("bucket", 1, "o_custkey") in ranks[0]


# Join sizes


def test_keys_that_are_common_on_both_sides_are_estimated_exactly(spark):
    l = spark.createDataFrame([(k % 5,) for k in range(100)] + [(50 + k,) for k in range(40)] + [(None,)] * 9, "a int")
    r = spark.createDataFrame([(k % 5,) for k in range(60)] + [(70 + k,) for k in range(40)] + [(None,)] * 9, "b int")
    lines = {x["key"]: x for x in estimates.join_estimate(l, r, [("a", "b")], k=5, common=5, buckets=4).collect()}
    assert all(lines[k]["estimated_rows"] == lines[k]["actual_rows"] == 20 * 12 and lines[k]["q_error"] == 1 for k in range(5))
    # 20 keys of one row are on both sides.
    assert lines[None]["actual_rows"] == 20 and lines[None]["q_error"] < 2.5


def test_estimates_of_sides_without_a_common_key(spark):
    l, r = spark.range(100).toDF("a"), spark.range(1000, 1100).toDF("b")
    lines = estimates.join_estimate(l, r, [("a", "b")], common=3, buckets=4).collect()
    assert [tuple(x) for x in lines] == [(None, 0.0, 0.0, 1.0)]
    assert [tuple(x) for x in estimates.join_estimate(l.limit(0), r, [("a", "b")]).collect()] == [(None, 0.0, 0.0, 1.0)]


# Sessions


@pytest.mark.parametrize("hot_rows", [None, 30])
def test_sessions_equal_gaps_and_islands(spark, hot_rows):
    rng = random.Random(3)
    start = dt.datetime(2024, 3, 31)
    rows = [(rng.choice(["a", "b", None, "hot", "hot"]), start + dt.timedelta(minutes=rng.choice([0, 30, 31, 29]) * rng.randint(0, 90)), rng.randint(0, 9)) for _ in range(300)]
    log = spark.createDataFrame(rows + [("a", None, 5)], "u string, ts timestamp_ntz, ms int")
    got = workload.sessions(log, "u", "ts", "30 minutes", F.col("ms").cast("decimal(18,2)"), hot_rows)
    got = got.select("u", "session_start", "last_call", "calls", F.col("busy").cast("long").alias("busy"), F.col("longest_idle").cast("long").alias("longest_idle"), F.col("seconds").cast("long").alias("seconds"))
    same_rows(
        got,
        """WITH a AS (SELECT *, lag(ts) OVER (PARTITION BY u ORDER BY ts) AS b FROM log WHERE ts IS NOT NULL),
             c AS (SELECT *, sum(CASE WHEN b IS NULL OR ts - b >= INTERVAL 30 MINUTE THEN 1 ELSE 0 END) OVER (PARTITION BY u ORDER BY ts) AS s FROM a)
           SELECT u, min(ts) AS session_start, max(ts) AS last_call, count(*) AS calls, CAST(sum(ms) AS BIGINT) AS busy,
                  CAST(max(CASE WHEN ts - b < INTERVAL 30 MINUTE AND ts > b THEN epoch(ts) - epoch(b) END) AS BIGINT) AS longest_idle, CAST(epoch(max(ts)) - epoch(min(ts)) AS BIGINT) AS seconds
           FROM c GROUP BY u, s""",
        log=log,
    )


def test_sessions_shuffle_calls_once_where_no_user_is_hot(spark, monkeypatch):
    log = spark.range(200).select((F.col("id") % 7).alias("u"), F.timestamp_seconds(F.col("id") * 1000).alias("ts"))
    written = []
    monkeypatch.setattr(workload, "stored", lambda df, name="": written.append(name) or df)
    found = workload.sessions(log, "u", "ts", "1 hour")
    assert plan_nodes(found).count("Exchange") == 1 and not written
    # Times of users 0 to 6 are 7,000 seconds apart.
    assert found.count() == 200
    workload.sessions(log, "u", "ts", "1 hour", hot_rows=10)
    assert written == ["calls"]


@pytest.mark.parametrize("idle", ["0 seconds", "20 minutes", "1 day"])
@pytest.mark.parametrize("kind", ["int", "decimal(9,3)"])
def test_sessions_of_hot_and_other_users_are_alike(spark, idle, kind):
    rng = random.Random(5)
    start = dt.datetime(2024, 3, 31)
    rows = [(rng.choice(["a", "b", None]), start + dt.timedelta(minutes=10 * rng.randint(0, 40)), rng.choice([1, 2, None])) for _ in range(200)]
    log = spark.createDataFrame(rows, "u string, ts timestamp_ntz, ms int")
    one, other = (workload.sessions(log, "u", "ts", idle, F.col("ms").cast(kind), hot_rows) for hot_rows in (None, 20))
    assert one.dtypes == other.dtypes
    assert sorted(map(str, one.collect())) == sorted(map(str, other.collect()))


def test_no_calls_no_sessions(spark):
    log = spark.createDataFrame([("a", None)], "u string, ts timestamp_ntz")
    assert workload.sessions(log, "u", "ts", "1 hour").count() == 0


# Pages


@pytest.mark.parametrize("ways", [("asc", "asc"), ("desc", "asc"), ("asc", "desc")], ids=str)
def test_pages_of_a_directory_are_those_of_an_offset(spark, tmp_path, ways):
    rng = random.Random(6)
    t = spark.createDataFrame([(i, rng.choice([None, *range(8)])) for i in range(205)], "id int, v int")
    order = [("v", ways[0]), ("id", ways[1])]
    lookup.write_pages(t, order, 20, str(tmp_path / "p"), hot_rows=50)
    whole = lookup.top_n(t, lookup._sort(order), 1000).collect()
    for page in (1, 2, 6, 10, 11):
        assert lookup.open_page(t, order, 20, str(tmp_path / "p"), page).collect() == whole[20 * page - 20 : 20 * page]
    assert lookup.open_page(t, order, 20, str(tmp_path / "p"), 12).count() == 0
    with pytest.raises(ValueError):
        lookup.open_page(t, order, 20, str(tmp_path / "p"), 0)


def test_rows_scanned_for_a_page_are_few(spark, tmp_path):
    path, pages = str(tmp_path / "t"), str(tmp_path / "p")
    layout.write_clustered(spark.read.parquet(f"{FOLDER}/orders.parquet"), path, "o_orderkey", 16)
    t, order = spark.read.parquet(path), [("o_orderkey", "asc")]
    lookup.write_pages(t, order, 1000, pages)
    page = lookup.open_page(t, order, 1000, pages, 70)
    assert rows_scanned(page) < 25_000 and page.count() == 1000
    assert page.agg(F.min("o_orderkey")).first()[0] == t.where("true").orderBy("o_orderkey").offset(69_000).first()["o_orderkey"]


# Summaries


def test_a_summary_reads_new_files_only(spark, tmp_path):
    source, path = str(tmp_path / "t"), str(tmp_path / "s")
    first = spark.createDataFrame([("a", 1, 10), ("b", 1, None), ("a", 2, 5)], "g string, h int, v int")
    first.coalesce(1).write.parquet(source)
    assert lookup.refresh_summary(spark, source, ["g", "h"], ["v"], path) == 1
    spark.createDataFrame([("a", 1, 1), ("c", 3, 2)], "g string, h int, v int").coalesce(1).write.mode("append").parquet(source)
    assert lookup.refresh_summary(spark, source, ["g", "h"], ["v"], path) == 1
    assert lookup.refresh_summary(spark, source, ["g", "h"], ["v"], path) == 0
    got = lookup.from_summary(spark, f"{path}/{lookup.ROWS}", ["g"], {"n": ("rows", None), "total": ("sum", "v"), "mean": ("avg", "v"), "least": ("min", "v")})
    same_rows(got, "SELECT g, count(*) AS n, CAST(sum(v) AS BIGINT) AS total, avg(v) AS mean, min(v) AS least FROM t GROUP BY g", t=spark.read.parquet(source))
    first.coalesce(1).write.mode("overwrite").parquet(source)
    with pytest.raises(ValueError, match="changed or gone"):
        lookup.refresh_summary(spark, source, ["g", "h"], ["v"], path)


def test_the_smallest_summary_that_fits_is_taken(spark, tmp_path, monkeypatch):
    df = spark.range(100).select((F.col("id") % 2).alias("g"), "id", F.lit(1).alias("v"), F.lit(2).alias("w"))
    lookup.write_summary(df, ["g", "id"], ["v", "w"], str(tmp_path / "fine"))
    lookup.write_summary(df, ["g"], ["v"], str(tmp_path / "coarse"))
    used, plain = [], lookup.from_summary
    monkeypatch.setattr(lookup, "from_summary", lambda spark, path, *rest: (used.append(path.rsplit("/", 1)[1]), plain(spark, path, *rest))[1])
    paths = [str(tmp_path / "fine"), str(tmp_path / "coarse")]
    assert lookup.from_smallest(spark, paths, ["g"], {"t": ("sum", "v")}).count() == 2
    assert lookup.from_smallest(spark, paths, ["g"], {"t": ("avg", "w")}).count() == 2
    assert used == ["coarse", "fine"]
    with pytest.raises(ValueError, match="no summary"):
        lookup.from_smallest(spark, paths, ["x"], {"t": ("sum", "v")})
