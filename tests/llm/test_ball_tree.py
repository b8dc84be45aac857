import math
import random
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import types as T

from tunesmith.llm import ball_tree

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
SMALL = {c: c + 32 for c in range(65, 91)}


def terms(text):
    return TERM.findall((text or "").translate(SMALL))


def brute(docs, items, k):
    tallies = [(i, Counter(terms(t))) for i, t in docs]
    sizes = [sum(c.values()) for _, c in tallies]
    n_docs, n_terms = sum(1 for s in sizes if s), sum(sizes)
    df = Counter(t for _, c in tallies for t in c)
    asked = {}
    for i, t in items:
        if i is not None:
            asked.setdefault(i, set()).update(terms(t))
    rows = []
    for item, own in asked.items():
        scored = []
        for (doc, c), n in zip(tallies, sizes):
            score = 0
            for t in own & set(c):
                w = math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1)))
                score += w * ((1_000_000_000 * c[t]) // (1000 * c[t] + 20 * (50 + (50 * n * n_docs) // n_terms)))
            if score > 0 and doc is not None:
                scored.append((-score, doc))
        rows += [(item, k + 1, doc, -s) for k, (s, doc) in enumerate(sorted(scored)[:k])]
    return sorted(rows)


def frames(spark, docs, items):
    schema = T.StructType().add("doc_id", "long").add("text", "string").add("RANK", "string").add("Item_Id", T.MapType(T.StringType(), T.IntegerType()))
    return spark.createDataFrame([(i, t, "x", None) for i, t in docs], schema), spark.createDataFrame(items, "item_id long, text string")


def found(docs, items, k=50):
    return sorted(map(tuple, ball_tree.ranked(docs, items, k).collect()))


@pytest.mark.parametrize("text", ["", None, "A-b_c  D9", "İß ÀÉ x\x00y\x7fz", "٣½²", "a" * 10, " x\x85y\xa0z"])
def test_terms(text):
    assert [t.decode() for t in ball_tree.terms_of(text)] == terms(text)


@pytest.mark.parametrize("leaf, block", [(1, 5), (2, 64), (32, 4096)])
def test_equals_all_scores(spark, monkeypatch, leaf, block):
    monkeypatch.setattr(ball_tree, "LEAF", leaf)
    monkeypatch.setattr(ball_tree, "BLOCK", block)
    rng = random.Random(leaf)
    words = [f"w{int(rng.paretovariate(0.7))}" for _ in range(400)]
    docs = [(i, " ".join(rng.choices(words, k=rng.randint(0, 40)))) for i in range(300)]
    docs += [(1000 + i, docs[7][1]) for i in range(40)]  # ties
    docs += [(5, "w1 w2"), (5, "w1 w2"), (None, "w1 w1"), (2000, None), (2001, "--"), (2002, "w1 " * 50_000)]
    items = [(i, " ".join(rng.choices(words, k=6))) for i in range(20)] + [(3, "w1 zzz"), (None, "w1"), (50, None), (51, "none of these"), (52, "w1")]
    assert found(*frames(spark, docs, items), 7) == brute(docs, items, 7)


def test_slices_give_the_same(spark, monkeypatch):
    docs = [(i, f"a{i % 7} b{i % 5} c") for i in range(100)]
    items = [(i, f"a{i} b{i} c") for i in range(9)]
    whole = brute(docs, items, 50)
    assert found(*frames(spark, docs, items)) == whole
    monkeypatch.setattr(ball_tree, "SLICE_BYTES", 20)
    assert found(*frames(spark, docs, items)) == whole


def test_empty_tables(spark):
    docs, items = frames(spark, [(1, "a")], [(1, "a")])
    assert found(docs.limit(0), items) == [] and found(docs, items.limit(0)) == [] and found(docs.where("doc_id > 1"), items) == []


def random_block(n, clusters, rng, size=60):
    """Documents with most terms of their cluster, and none of another's."""
    rows, width = [], size // clusters
    for i in range(n):
        own = rng.choice(5, 4, replace=False) if rng.random() < 0.5 else np.arange(4)
        rows.append((np.sort(np.append(own, rng.integers(5, width))) + (i % clusters) * width, rng.integers(90_000, 100_000, 5)))
    edges = np.arange(0, 5 * n + 1, 5)
    return ball_tree.Vectors(np.arange(n), edges, np.concatenate([c for c, _ in rows]), np.concatenate([v for _, v in rows]).astype(np.int64))


def test_balls_hold_their_documents_and_bounds_their_scores():
    rng = np.random.default_rng(3)
    docs, weights = random_block(300, 6, rng), rng.integers(0, 5000, 60)
    items = ball_tree.Items(np.arange(8), [np.sort(rng.choice(60, 6, replace=False)) for _ in range(8)], weights, 5)
    tree = ball_tree.BallTree(docs, items.root)
    for (a, b), (terms_, mean, radius) in zip(tree.spans, tree.balls):
        part = tree.docs.part(a, b)
        bounds = items.bound(terms_, mean, radius)
        for item in range(8):
            dense = np.zeros(60, np.int64)
            dense[items.rows[item]] = weights[items.rows[item]]
            assert part.product(dense).max() <= bounds[item]
    assert sorted(tree.docs.ids.tolist()) == list(range(300))


def test_subtrees_are_pruned_where_documents_lie_in_groups():
    rng = np.random.default_rng(4)
    docs, weights = random_block(2000, 10, rng, 600), np.full(600, 1000)
    items = ball_tree.Items(np.arange(10), [np.arange(5) + 60 * i for i in range(10)], weights, 5)
    ball_tree.BallTree(docs, items.root).search(items)
    assert items.scored < 0.35 * 2000 * 10


def test_scores_beyond_64_bits_on_the_way():
    # 50 * n * N is over 64 bits here.
    n, tf = np.array([4_000_000_000_000]), np.array([3])
    m = 50 + (50 * 4_000_000_000_000 * 10**9) // 10**18
    assert ball_tree.term_scores(tf, n, 10**9, 10**18).tolist() == [(3 * 10**9) // (3000 + 20 * m)]
