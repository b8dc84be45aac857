import random

import pytest
from oracle_check import same_rows
from pyspark.sql import functions as F

from tunesmith.operators import lookup
from tunesmith.plans.inspect import settings


@pytest.fixture(scope="module")
def t(spark):
    rnd = random.Random(2)
    rows = [(i, rnd.choice([None, "a", "b", "c"]), rnd.choice([None, 1, 2, 3, 9])) for i in range(300)]
    return spark.createDataFrame(rows, "id int, g string, v int").repartition(4).cache()


@pytest.mark.parametrize("ways", [("asc", "asc"), ("desc", "asc"), ("asc", "desc"), ("desc", "desc")])
def test_pages_cover_the_table_once(t, ways):
    order = [("v", ways[0]), ("id", ways[1])]
    seen, after = [], None
    while True:
        page = lookup.keyset_page(t, order, after, 70).collect()
        if not page:
            break
        seen += [r["id"] for r in page]
        after = [page[-1]["v"], page[-1]["id"]]

    def key(r):
        v = r["v"] if r["v"] is not None else 0
        return (r["v"] is None, v if ways[0] == "asc" else -v, r["id"] if ways[1] == "asc" else -r["id"])

    assert seen == [r["id"] for r in sorted(t.collect(), key=key)]


@pytest.mark.parametrize("cut", [0, 1000], ids=["ranked", "teams"])
def test_top_n_that_is_too_much_for_one_task(spark, t, monkeypatch, cut):
    order = [F.col("v").desc_nulls_last(), F.col("id")]
    few = lookup.top_n(t, order, 40).collect()
    monkeypatch.setattr(lookup, "ONE_TASK_BYTES", 1)
    monkeypatch.setattr(lookup, "scan_tasks", lambda df: 5)
    with settings(spark, spark__sql__optimizer__windowGroupLimitThreshold=cut):
        assert lookup.top_n(t, order, 40, hot_rows=50).collect() == few


@pytest.mark.parametrize("n", [2, 150])
@pytest.mark.parametrize("way", ["cut", "teams", "ranked", "ranked in parts"])
def test_top_n_per_group(spark, t, n, way, monkeypatch):
    if way == "teams":
        monkeypatch.setattr(lookup, "ONE_TASK_BYTES", 1)
        monkeypatch.setattr(lookup, "scan_tasks", lambda df: 5)
    cut = 0 if "ranked" in way else 1000
    with settings(spark, spark__sql__optimizer__windowGroupLimitThreshold=cut):
        same_rows(
            lookup.top_n_per_group(
                t, ["g"], [F.col("v").asc_nulls_last(), F.col("id")], n, 20 if way == "ranked in parts" else None
            ),
            f"SELECT * FROM t QUALIFY row_number() OVER (PARTITION BY g ORDER BY v NULLS LAST, id) <= {n}",
            t=t,
        )


@pytest.mark.parametrize("literal", [10_000, 0])
def test_late_fetch(t, monkeypatch, literal):
    monkeypatch.setattr(lookup, "LITERAL_KEYS", literal)
    same_rows(
        lookup.late_fetch(t, "id", [("v", "desc"), ("id", "asc")], 25, ["g"]),
        "SELECT * FROM t ORDER BY v DESC NULLS LAST, id LIMIT 25",
        t=t,
    )


def test_late_fetch_with_repeated_and_null_keys(t):
    # v is no key: many rows share one, and some have none.
    same_rows(
        lookup.late_fetch(t, "v", [("id", "asc")], 25, ["g"]), "SELECT * FROM t ORDER BY id LIMIT 25", t=t
    )


@pytest.mark.parametrize("limit", [None, -1])
@pytest.mark.parametrize("literal", [1000, 0])
def test_in_list(spark, t, limit, literal, monkeypatch):
    monkeypatch.setattr(lookup, "LITERAL_LIST", literal)
    values = spark.createDataFrame([(1,), (1,), (77,), (None,), (120,)], "k int")
    same_rows(
        lookup.in_list(t, "id", values, [(100, 130), (125, 140)], limit),
        "SELECT * FROM t WHERE id IN (1, 77, 120) OR id BETWEEN 100 AND 140",
        t=t,
    )
    same_rows(lookup.in_list(t, "v", values, limit=limit), "SELECT * FROM t WHERE v = 1", t=t)
    same_rows(lookup.in_list(t, "v", values, [(2, 3)], limit), "SELECT * FROM t WHERE v <= 3", t=t)
    none = values.where("false")
    assert lookup.in_list(t, "v", none, limit=limit).isEmpty()
    same_rows(lookup.in_list(t, "v", none, [(2, 3)], limit), "SELECT * FROM t WHERE v IN (2, 3)", t=t)


def test_summary_rolls_up(spark, t, tmp_path):
    path = str(tmp_path / "summary")
    lookup.write_summary(t.withColumn("odd", F.col("id") % 2), ["g", "odd"], ["v"], path)
    aggs = {f: (f, "v") for f in ("sum", "count", "avg", "min", "max")} | {"n": ("rows", None)}
    same_rows(
        lookup.from_summary(spark, path, ["g"], aggs),
        """SELECT g, CAST(sum(v) AS BIGINT) AS sum, count(v) AS count, avg(v) AS avg, min(v) AS min, max(v) AS max,
                  count(*) AS n FROM t GROUP BY g""",
        t=t,
    )
