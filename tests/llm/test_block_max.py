import math

import numpy as np
import pytest
from pyspark.sql import functions as F, types as T

from tunesmith.llm import block_max


def brute(rows, every, k, scale=256):
    """Rows are (id, vector); the smallest vector of an id counts."""
    known = {}
    for i, v in rows:
        if i is None or not v or any(x is None or not math.isfinite(x) for x in v):
            continue
        whole = [math.floor(min(max(scale * float(x), -(2.0**63)), 2.0**63 - 1024)) for x in v]
        known[i] = min(known.get(i, whole), whole)
    found = []
    for q, v in known.items():
        if q % every == 0:
            scored = sorted((-sum(a * b for a, b in zip(v, w)), i) for i, w in known.items() if i != q and len(w) == len(v))
            found += [(q, r + 1, i, -s) for r, (s, i) in enumerate(scored[:k])]
    return sorted(found)


def frame(spark, rows, kind="float"):
    schema = T.StructType().add("vec_id", "long").add("embedding", T.ArrayType(T.FloatType() if kind == "float" else T.DoubleType())).add("Score", "string").add("query_id", T.MapType(T.StringType(), T.IntegerType()))
    return spark.createDataFrame([(i, v, "x", None) for i, v in rows], schema)


def found(df, every=50, k=5):
    return sorted(map(tuple, block_max.top_products(df, F.col("vec_id") % every == 0, k).collect()))


def vectors(n, dim, seed=1):
    rng = np.random.default_rng(seed)
    return [(i, [float(np.float32(x)) for x in rng.standard_normal(dim)]) for i in range(n)]


@pytest.mark.parametrize("block, part, chunk_rows", [(128, 4096, 2048), (3, 7, 40)])
def test_equals_all_products(spark, monkeypatch, block, part, chunk_rows):
    for name, value in (("BLOCK", block), ("PART", part), ("CHUNK_ROWS", chunk_rows)):
        monkeypatch.setattr(block_max, name, value)
    rows = vectors(300, 6)
    assert found(frame(spark, rows), 10) == brute(rows, 10, 5)


def test_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = vectors(40, 3) + [(k, [0.5, 0.5, 0.5]) for k in range(100, 130)]  # ties
    rows += [(0, [9.0, 9.0, 9.0]), (200, [0.0, 0.0, 0.0]), (None, [1.0, 1.0, 1.0]), (250, None), (300, []), (350, [1.0, nan, 1.0]), (400, [1.0, inf, 1.0]), (450, [None, 1.0, 1.0])]
    rows += [(500, [1.0, 2.0]), (501, [2.0, 1.0]), (550, [1.0]), (50, [-1.0, -2.0, -3.0]), (50, [-1.0, -2.0, -3.0])]
    got = found(frame(spark, rows))
    assert got == brute(rows, 50, 5)
    assert [r for r in got if r[0] == 500] == [(500, 1, 501, 2 * 2 * 65536)] and not [r for r in got if r[0] == 550]


def test_large_components_are_exact(spark):
    rows = [(i, [x, y]) for i, (x, y) in enumerate([(3e6, 1.0), (3e6, 2.0), (-3e6, 5.0), (1.0, 7e5), (3e6, 2.0)])]
    assert found(frame(spark, rows, "double"), 1) == brute(rows, 1, 5)
    # Beyond 64 bits the nearest long counts, and so ids decide.
    rows = [(0, [1e12]), (1, [1e12]), (2, [3e12]), (3, [-1e12]), (4, [1e300])]
    got = found(frame(spark, rows, "double"), 50)
    assert [r[2] for r in got] == [1, 2, 4, 3] and got[0][3] == 2**63 - 1 and got[-1][3] == -(2**63) + 2


def test_empty_tables(spark):
    df = frame(spark, vectors(3, 2))
    assert found(df.limit(0)) == [] and found(df.where("vec_id > 0")) == [] and found(df.where("vec_id = 0")) == []


def test_blocks_below_the_kth_score_are_not_scored():
    rng = np.random.default_rng(2)
    centres = rng.integers(-300, 300, (20, 16))
    rows = np.repeat(centres, 200, axis=0) + rng.integers(-8, 9, (4000, 16))
    chunk = block_max.Chunk(np.arange(4000), rows, block_max.fit_cells(rows[::4].astype(float), 64, 4), np.float64)
    scores, ids, scored = chunk.best(np.arange(0, 4000, 50), rows[::50], 5)
    assert scored < 0.3 * 80 * len(chunk.most)
    want = rows @ rows[0]
    want[0] = -(10**9)
    assert scores[0].tolist() == sorted(want, reverse=True)[:5]


def test_bounds_hold():
    rng = np.random.default_rng(5)
    rows, queries = rng.integers(-99, 99, (500, 5)), rng.integers(-99, 99, (40, 5)).astype(np.float64)
    chunk = block_max.Chunk(np.arange(500), rows, np.zeros((1, 5)), np.float64)
    best = np.maximum.reduceat(queries @ chunk.rows.T, np.arange(0, 500, block_max.BLOCK), axis=1)
    assert (chunk.bounds(queries) >= best).all()
