import re

import numpy as np
from pyspark.sql import functions as F, types as T

from tunesmith.llm import rabitq as R
from tunesmith.plans.inspect import plan_nodes, plan_text

SCHEMA = T.StructType([T.StructField("vec_id", T.LongType()), T.StructField("embedding", T.ArrayType(T.FloatType())), T.StructField("RANK", T.StringType()), T.StructField("dim", T.StringType())])


def brute(rows, k=10, of=100):
    """Rows are (id, vector); every query against every other row."""
    out = []
    for q, a in rows:
        if q % of == 0:
            found = sorted((float(np.sqrt(np.cumsum((np.float64(a) - np.float64(b)) ** 2)[-1])), c) for c, b in rows if c != q and len(a) == len(b))
            out += [(q, r + 1, c, s) for r, (s, c) in enumerate(found[:k])]
    return sorted(out)


def run(spark, rows, k=10, of=100):
    df = spark.createDataFrame([(i, None if v is None else [None if x is None else float(x) for x in v], None, "d") for i, v in rows], SCHEMA)
    return sorted(map(tuple, R.nearest(df, F.col("vec_id") % of == 0, k).collect()))


def clustered(n, dim, seed=1):
    rng = np.random.default_rng(seed)
    centers = rng.standard_normal((5, dim)) * 2
    return [(k, np.float32(centers[k % 5] + rng.standard_normal(dim))) for k in range(n)]


def test_recall_against_brute_force(spark, monkeypatch):
    monkeypatch.setattr(R, "BLOCK_BYTES", 60_000)
    monkeypatch.setattr(R, "QUERY_BLOCK", 7)
    rows = clustered(3000, 40)
    got, want = run(spark, rows), brute(rows)
    assert len(got) == len(want) and len({(g[0], g[2]) for g in got} & {(w[0], w[2]) for w in want}) >= 0.99 * len(want)


def test_bounds_hold_and_spare_work():
    rows = clustered(4000, 64)
    ids, vectors = np.array([r[0] for r in rows]), np.array([r[1] for r in rows], np.float64)
    centroids = R.fit_cells(vectors[:500])
    codes = R.codes_of(vectors, centroids)
    queries = R.Queries(ids[:20], vectors[:20], centroids)
    wrong = 0
    for cell in np.unique(codes["cell"]):
        own = codes["cell"] == cell
        guess, least = queries.lower_bounds(cell, codes["length"][own], codes["own"][own], codes["signs"][own])
        true = ((vectors[:20, None] - vectors[own][None]) ** 2).sum(2)
        wrong += (least > true).sum()
        assert abs((guess - true) / true.mean()).mean() < 0.1
    assert wrong <= 0.001 * 20 * 4000
    best = R.Best(queries, 10)
    best.meet(ids, vectors, codes)
    assert best.compared < 0.5 * 20 * 4000


def test_odd_rows(spark):
    bad = [(100, None), (200, []), (300, [0.0, 0.0]), (400, [1.0, None]), (500, [float("nan"), 1.0]), (600, [float("inf"), 1.0])]
    good = [(0, [1.0, 0.0]), (1, [1.0, 0.0]), (2, [1.0, 0.0]), (2, [1.0, 0.0]), (3, [0.0, 1.0]), (700, [1.0, 2.0, 3.0]), (701, [1.0, 2.0, 4.0]), (800, [5.0])]
    want = [(0, 1, 1, 0.0), (0, 2, 2, 0.0), (0, 3, 3, float(np.sqrt(2.0))), (700, 1, 701, 1.0)]
    assert run(spark, bad + good + [(None, [1.0, 0.0])]) == want
    assert run(spark, [(5, [2.0, 2.0]), (5, [1.0, 1.0]), (0, [1.0, 1.0])]) == [(0, 1, 5, 0.0)]
    assert run(spark, []) == [] and run(spark, [(0, [1.0])]) == []


def test_many_equal_vectors(spark):
    rows = [(k, [1.0, 2.0, 2.0]) for k in range(300)]
    assert run(spark, rows) == brute(rows)


def test_copies_of_queries_are_not_broadcast_and_chunks_are_bounded(spark, monkeypatch):
    monkeypatch.setattr(R, "BLOCK_BYTES", 60_000)
    monkeypatch.setattr(R, "QUERY_BLOCK", 7)
    rows = clustered(3000, 40)
    df = spark.createDataFrame([(i, [float(x) for x in v], None, "d") for i, v in rows], SCHEMA)
    nodes = plan_nodes(R.nearest(df, F.col("vec_id") % 100 == 0))
    assert "BroadcastExchange" not in nodes and "SortMergeJoin" not in nodes
    monkeypatch.setattr(R, "CHUNK_BYTES", 30_000)
    found = R.nearest(df, F.col("vec_id") % 100 == 0)
    assert re.findall(r"direct_shuffle_partition_id\(chunk#\d+\), (\d+)\)", plan_text(found)) == [str(-(-3000 * 40 * 8 // 30_000))]
    got, want = sorted(map(tuple, found.collect())), brute(rows)
    assert len(got) == len(want) and len({(g[0], g[2]) for g in got} & {(w[0], w[2]) for w in want}) >= 0.99 * len(want)


def test_sample_of_low_hashes_is_that_of_all(spark, monkeypatch):
    monkeypatch.setattr(R, "SAMPLE", 50)
    rows = spark.range(3000).select("id", F.array("id").alias("v"))
    assert R._sample(rows, 3000) == rows.orderBy(F.xxhash64("id"), "id").limit(50).select("v").collect()
    # Hashes that are all alike and high: the rows come all the same.
    alike = spark.range(300).select(F.lit(1).alias("id"), F.array("id").alias("v"))
    assert len(R._sample(alike, 300)) == 50
