import random

import pytest
from oracle_check import same_rows
from pyspark.sql import functions as F

from tunesmith.operators import design, statistics, workload


@pytest.fixture(scope="module")
def t(spark):
    rnd = random.Random(3)
    rows = [(rnd.choice([None, "a", "b"]), rnd.choice([None, 1, 2, 3]), rnd.randint(0, 40)) for _ in range(200)]
    return spark.createDataFrame(rows, "g string, v int, w int").repartition(4).cache()


@pytest.mark.parametrize("buckets", [1, 7, 64, 500])
@pytest.mark.parametrize("hot_rows", [None, 6])
def test_equi_height(t, buckets, hot_rows):
    same_rows(
        statistics.equi_height(t, "w", buckets, hot_rows),
        f"""SELECT b AS bucket, count(*) AS rows, min(w) AS low, max(w) AS high, count(DISTINCT w) AS distinct_values
            FROM (SELECT w, ntile({buckets}) OVER (ORDER BY w) AS b FROM t) GROUP BY b""",
        t=t,
    )


def test_equi_height_of_nothing(t):
    assert statistics.equi_height(t.where("w < 0"), "w", 4).count() == 0


def near(exact, sketched):
    """Distinct counts within a tenth, the other counts equal."""
    a, b = ({r["column_name"]: r for r in d.collect()} for d in (exact, sketched))
    return a.keys() == b.keys() and all(
        (a[c]["rows"], a[c]["null_rows"]) == (b[c]["rows"], b[c]["null_rows"])
        and abs(a[c]["distinct_values"] - b[c]["distinct_values"]) <= a[c]["distinct_values"] / 10
        for c in a
    )


def test_column_stats(t):
    sql = " UNION ALL ".join(
        f"""SELECT '{c}' AS column_name, count(*) AS rows, count(*) - count({c}) AS null_rows,
               count(DISTINCT {c}) AS distinct_values, CAST(min({c}) AS VARCHAR) AS min_value,
               CAST(max({c}) AS VARCHAR) AS max_value FROM t"""
        for c in ("g", "v", "w")
    )
    same_rows(statistics.column_stats(t), sql, t=t)
    exact, sketched = statistics.column_stats(t), statistics.column_stats(t, exact=False)
    assert near(exact, sketched)
    empty = t.where("false")
    same_rows(statistics.column_stats(empty), sql, t=empty)


def test_common_values_breaks_ties_by_value(spark):
    df = spark.createDataFrame([("b",), ("a",), ("c",), ("c",), (None,), (None,), (None,)], "x string")
    assert [tuple(r) for r in statistics.common_values(df, "x", 2).collect()] == [("c", 2), ("a", 1)]


def test_selectivity(t):
    sql = " UNION ALL ".join(
        f"""SELECT '{c}' AS column_name, count(*) AS rows, count(*) - count({c}) AS null_rows,
               count(DISTINCT {c}) AS distinct_values, count(DISTINCT {c}) / count(*) AS selectivity FROM t"""
        for c in ("g", "v", "w")
    )
    same_rows(design.column_selectivity(t, ["g", "v", "w"]).drop("max_rows"), sql, t=t)
    sketched = design.column_selectivity(t, ["g", "v", "w"], exact=False)
    assert near(design.column_selectivity(t, ["g", "v", "w"]), sketched)
    assert design.column_selectivity(t.where("false"), ["g"]).first()["selectivity"] is None


def test_prefix_selectivity_counts_null_as_a_value(t):
    sql = " UNION ALL ".join(
        f"""SELECT {n} AS prefix_length, '{', '.join(keys)}' AS prefix, count(*) AS distinct_keys, max(n) AS max_rows,
               sum(n) / count(*) AS avg_rows
            FROM (SELECT {', '.join(keys)}, count(*) AS n FROM t GROUP BY ALL)"""
        for n, keys in [(1, ["g"]), (2, ["g", "v"]), (3, ["g", "v", "w"])]
    )
    same_rows(design.prefix_selectivity(t, ["g", "v", "w"]), sql, t=t)


@pytest.mark.parametrize("hot_rows", [None, 5])
def test_order_switches(t, hot_rows):
    known = t.where("g IS NOT NULL")
    same_rows(
        design.order_switches(known, "w", "g", hot_rows).select("rows", "switches"),
        """SELECT count(*) AS rows, CAST(sum(CASE WHEN b <> g THEN 1 ELSE 0 END) AS BIGINT) AS switches
           FROM (SELECT g, lag(g) OVER (ORDER BY w, g) AS b FROM t)""",
        t=known,
    )


def test_layout_candidates_reject_skewed_bucket_keys(spark):
    df = spark.range(1000).select(F.when(F.col("id") < 400, 0).otherwise(F.col("id")).alias("hot"), "id", (F.col("id") % 4).alias("few"))
    uses = spark.createDataFrame([("hot", "join", 9), ("id", "join", 5), ("few", "eq", 3), ("gone", "eq", 1)], "column_name string, kind string, uses bigint")
    found = {(r["column_name"], r["role"]): r["score"] for r in design.layout_candidates(df, uses, 100).collect()}
    assert found == {("id", "bucket"): 5.0, ("few", "partition"): 3.0, ("few", "sort"): 2.25}


def test_layout_candidates_are_ranked_by_role(spark):
    df = spark.range(1000).select("id", (F.col("id") % 4).alias("few"), (F.col("id") % 10).alias("ten"))
    uses = spark.sql("SELECT * FROM VALUES ('few', 'eq', 3), ('ten', 'range', 8), ('id', 'range', 1) AS t(column_name, kind, uses)")
    ranks = {(r["role"], r["rank"]): r["column_name"] for r in design.layout_candidates(df, uses, 100).collect()}
    assert ranks == {
        ("partition", 1): "ten",
        ("partition", 2): "few",
        ("sort", 1): "ten",
        ("sort", 2): "few",
        ("sort", 3): "id",
    }


@pytest.mark.parametrize("hot_rows", [None, 10])
def test_percentiles(t, hot_rows):
    sql = " UNION ALL ".join(
        f"SELECT g, CAST({p} AS DOUBLE) AS p, quantile_cont(w, {p}) AS value FROM t GROUP BY g"
        for p in (0, 0.33, 0.5, 1)
    )
    same_rows(workload.response_percentiles(t, ["g"], "w", [0, 0.33, 0.5, 1], hot_rows=hot_rows), sql, t=t)


def test_percentiles_by_sketch(t):
    rows = workload.response_percentiles(t, ["g"], "w", [0.5], exact=False).collect()
    exact = {r["g"]: r["value"] for r in workload.response_percentiles(t, ["g"], "w", [0.5]).collect()}
    assert all(abs(r["value"] - exact[r["g"]]) <= 1 for r in rows) and len(rows) == len(exact)


def test_cardinality_check_leaves_nulls_out(spark, t):
    r = spark.createDataFrame([(1, 0), (1, 0), (2, 0), (None, 0)], "k int, z int")
    row = workload.cardinality_check(t, r, [("v", "k")]).first()
    assert row["actual_rows"] == t.join(r, F.col("v") == F.col("k")).count()
    assert (row["left_rows"], row["right_rows"], row["left_keys"], row["right_keys"]) == (200, 4, 3, 2)
    assert row["estimated_rows"] == pytest.approx(200 * 4 / 3)
    assert workload.cardinality_check(t.where("false"), r, [("v", "k")]).first()["actual_rows"] == 0


def test_cardinality_check_of_huge_groups(spark):
    big = spark.range(3000).select(F.lit(1).alias("k"))
    row = workload.cardinality_check(big, big, "k").first()
    assert row["actual_rows"] == row["estimated_rows"] == 9_000_000


def test_trace_profile_shares(t):
    rows = workload.trace_profile(t, "g", F.col("w").cast("decimal(18,2)")).collect()
    assert abs(sum(r["share"] for r in rows) - 1) < 1e-5
    assert sum(r["calls"] for r in rows) == 200


@pytest.mark.parametrize("hot_rows", [None, 10])
def test_wait_gaps(spark, hot_rows):
    df = spark.sql(
        """SELECT IF(id % 10 = 0, 'cold', 'hot') AS s, id,
                  timestamp_ntz'2024-03-10 01:00:00' + make_dt_interval(0, 0, 0, id * id * 1.25) AS ts FROM range(60)"""
    ).repartition(3)
    same_rows(
        workload.wait_gaps(df, "s", "ts", 60, "id", hot_rows).select("id", F.col("gap_seconds").cast("double").alias("gap")),
        """SELECT id, (epoch_us(ts) - epoch_us(p)) / 1e6 AS gap FROM
           (SELECT *, lag(ts) OVER (PARTITION BY s ORDER BY ts) AS p FROM t) WHERE epoch_us(ts) - epoch_us(p) >= 60e6""",
        t=df.cache(),
    )


def test_wait_gaps_do_not_depend_on_the_session_zone(spark):
    # Clocks in this zone skip an hour in between; a stamp without a zone does not.
    df = spark.sql(
        "SELECT 1 AS s, ts FROM VALUES (timestamp_ntz'2024-03-10 01:30:00'), (timestamp_ntz'2024-03-10 03:30:00') AS t(ts)"
    )
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        assert [float(r["gap_seconds"]) for r in workload.wait_gaps(df, "s", "ts", 1, ()).collect()] == [7200.0]
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_response_windows(spark):
    df = spark.sql(
        "SELECT ts, v FROM VALUES (timestamp_ntz'2024-01-01 00:59:59', 1), (timestamp_ntz'2024-01-01 01:00:00', 2),"
        " (timestamp_ntz'2024-01-01 01:30:00', NULL) AS t(ts, v)"
    )
    rows = workload.response_windows(df, "ts", "1 hour", F.col("v").cast("decimal(18,2)")).orderBy("window_start").collect()
    assert [(r["calls"], r["total"], r["mean"]) for r in rows] == [(1, 1.0, 1.0), (2, 2.0, 2.0)]


def test_statement_reuse(spark):
    texts = [
        "select a from t where x = 1 and s = 'it''s 5'",
        "SELECT a  FROM t\nWHERE x = 22.5e3 and s = ''",
        "select a from t where x = 1 and s = 'it''s 5'",
        "select a1 from t2 where x = 7",
        None,
    ]
    df = spark.createDataFrame([(s,) for s in texts], "q string")
    found = {tuple(r) for r in workload.statement_reuse(df, "q").collect()}
    assert found == {("select a from t where x = ? and s = ?", 3, 2), ("select a1 from t2 where x = ?", 1, 1)}
