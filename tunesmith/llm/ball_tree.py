"""Ranked lexical search by exact inner products over sparse ball trees (op11).

1. The items' terms are the vocabulary. Each document becomes a sparse vector: its distinct
   terms of the vocabulary with their occurrences, next to its number of terms. Numbers of
   documents and terms, and each term's documents, are counted over all of them.
2. A task takes its documents in blocks. A block's vectors (a term's score times the root of its
   weight) are put in a ball tree: a node has the mean of its documents and a radius that all of
   them are within, and is split in two halves by two documents far apart.
3. No document of a node scores higher for an item than the item's inner product with the mean
   plus the item's length, over the terms the node has, times the radius, rounded up. Nodes
   are opened best first, until the bound is below the item's k-th score so far.
4. Documents of a leaf are scored exactly in 64-bit integers.

An item's best of all blocks of a task are kept together, so later blocks are pruned more. The
items are taken in slices of bounded size; every document meets every slice.
"""

from __future__ import annotations

import heapq
import math
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from tunesmith.llm.common import quoted
from tunesmith.sources.scratch import stored

# Bytes of items in a slice; documents and vector entries of a block; documents of a leaf.
SLICE_BYTES, BLOCK, BLOCK_ENTRIES, LEAF = 1 << 20, 4096, 1 << 20, 32
# Bounds are raised by this part of their size, and by one, against rounding.
SLACK = 1e-9
#: Weight, saturation and length constants of the score: fixed values.
WEIGHT_SCALE, TF_SCALE, TF_STEP, LENGTH_STEP, BASE, SLOPE = 1000, 1_000_000_000, 1000, 20, 100, 50

_SPLIT = bytes(c + 32 if 0x41 <= c <= 0x5A else c if c >= 0x80 or chr(c).isalnum() else 0x20 for c in range(256))


def terms_of(text: str | None) -> list[bytes]:
    """Letters, digits and all beyond ASCII make terms; only A-Z are made small."""
    return (text or "").encode().translate(_SPLIT).split()


# Sparse vectors


class Vectors:
    """Documents as rows of (term, occurrences): ``ids``, and ``edges`` into ``cols`` and ``values``."""

    def __init__(self, ids: np.ndarray, edges: np.ndarray, cols: np.ndarray, values: np.ndarray):
        self.ids, self.edges, self.cols, self.values = ids, edges, cols, values

    def __len__(self) -> int:
        return len(self.ids)

    def taken(self, rows: np.ndarray) -> Vectors:
        sizes = np.diff(self.edges)[rows]
        edges = np.concatenate([[0], np.cumsum(sizes)])
        at = np.repeat(self.edges[rows] - edges[:-1], sizes) + np.arange(edges[-1])
        return Vectors(self.ids[rows], edges, self.cols[at], self.values[at])

    def part(self, a: int, b: int) -> Vectors:
        low, high = self.edges[a], self.edges[b]
        return Vectors(self.ids[a:b], self.edges[a : b + 1] - low, self.cols[low:high], self.values[low:high])

    def product(self, dense: np.ndarray) -> np.ndarray:
        """Inner product of every row with one dense vector; no row is empty."""
        return np.add.reduceat(self.values * dense[self.cols], self.edges[:-1])


def term_scores(tf: np.ndarray, n: np.ndarray, documents: int, terms: int) -> np.ndarray:
    """What one unit of a term's weight gives a document with ``n`` terms."""
    wide = object if 50 * int(n.max(initial=0)) * documents >= 1 << 62 else np.int64
    m = (BASE - SLOPE + (SLOPE * n.astype(wide) * documents) // max(terms, 1)).astype(np.int64)
    return (TF_SCALE * tf) // (TF_STEP * tf + LENGTH_STEP * m)


class Items:
    """The items of a slice as sparse rows of weights, with their best documents so far."""

    def __init__(self, ids: np.ndarray, rows: list[np.ndarray], weights: np.ndarray, k: int):
        self.ids, self.rows, self.k = ids, rows, k
        self.weights = weights
        self.root = np.sqrt(weights.astype(np.float64))
        # Which items hold a term.
        owner = np.repeat(np.arange(len(rows)), [len(r) for r in rows])
        terms = np.concatenate(rows) if rows else np.zeros(0, np.int64)
        turn = np.argsort(terms, kind="stable")
        self.holders = owner[turn]
        self.holder_edges = np.searchsorted(terms[turn], np.arange(len(weights) + 1))
        self.scores = [np.zeros(0, np.int64) for _ in rows]
        self.found = [np.zeros(0, np.int64) for _ in rows]
        self.least = np.ones(len(rows), np.int64)
        self.dense = np.zeros(len(weights), np.int64)
        self.scored = 0

    def bound(self, terms: np.ndarray, mean: np.ndarray, radius: float) -> np.ndarray:
        """Per item: no document of a node (its terms, their means, the radius) scores higher."""
        sizes = self.holder_edges[terms + 1] - self.holder_edges[terms]
        total = int(sizes.sum())
        at = np.repeat(self.holder_edges[terms] - np.cumsum(sizes) + sizes, sizes) + np.arange(total)
        owner, term = self.holders[at], np.repeat(np.arange(len(terms)), sizes)
        root = self.root[terms]
        product = np.bincount(owner, (mean * root)[term], minlength=len(self.ids))
        length = np.sqrt(np.bincount(owner, (root * root)[term], minlength=len(self.ids)))
        return (product + length * radius) * (1 + SLACK) + 1

    def meet(self, item: int, docs: Vectors) -> None:
        """Score the documents of a leaf exactly."""
        row = self.rows[item]
        self.dense[row] = self.weights[row]
        scores = docs.product(self.dense)
        self.dense[row] = 0
        self.scored += len(docs)
        good = scores >= self.least[item]
        if not good.any():
            return
        scores = np.concatenate([self.scores[item], scores[good]])
        found = np.concatenate([self.found[item], docs.ids[good]])
        order = np.lexsort((found, -scores))[: self.k]
        self.scores[item], self.found[item] = scores[order], found[order]
        if len(order) == self.k:
            self.least[item] = max(scores[order[-1]], 1)

    def results(self) -> pa.RecordBatch:
        columns = [np.repeat(self.ids, [len(s) for s in self.scores]), *(np.concatenate(x) if x else np.zeros(0, np.int64) for x in (self.found, self.scores))]
        return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], ["item_id", "doc_id", "score"])


class BallTree:
    """Nodes over ranges of a block's documents; a node's halves come after it."""

    def __init__(self, docs: Vectors, root: np.ndarray):
        """``root`` holds the square roots of the terms' weights; ``docs`` have whole-number values."""
        scaled = Vectors(docs.ids, docs.edges, docs.cols, docs.values * root[docs.cols])
        size = len(root)
        order = np.arange(len(docs))
        self.spans, self.halves, self.balls = [], [], []
        todo = [(0, len(docs), -1)]
        while todo:
            a, b, above = todo.pop()
            own = scaled.taken(order[a:b])
            mean = np.bincount(own.cols, own.values, minlength=size) / (b - a)
            squares = np.add.reduceat(own.values * own.values, own.edges[:-1])
            middle = float(mean @ mean)
            apart = squares - 2 * own.product(mean) + middle
            radius = math.sqrt(float(np.maximum(apart + 1e-12 * (squares + middle), 0).max()))
            terms = np.unique(own.cols)
            node = len(self.spans)
            self.spans.append((a, b))
            self.halves.append(None)
            self.balls.append((terms, mean[terms], radius))
            if above >= 0:
                self.halves[above] = (*(self.halves[above] or ()), node)
            if b - a > LEAF:
                one = own.part(*(int(apart.argmax()) + np.array([0, 1])).tolist())
                to_one = self._products(own, one, size)
                far = squares + one.values @ one.values - 2 * to_one
                other = own.part(*(int(far.argmax()) + np.array([0, 1])).tolist())
                # A document's place between the two; ties keep the order there was.
                lean = far - (squares + other.values @ other.values - 2 * self._products(own, other, size))
                order[a:b] = order[a:b][np.argsort(lean, kind="stable")]
                half = (a + b) // 2
                todo += [(half, b, node), (a, half, node)]
        self.docs = docs.taken(order)

    @staticmethod
    def _products(rows: Vectors, one: Vectors, size: int) -> np.ndarray:
        dense = np.zeros(size)
        dense[one.cols] = one.values
        return rows.product(dense)

    def search(self, items: Items) -> None:
        bounds = np.array([items.bound(*ball) for ball in self.balls])
        for item in np.flatnonzero(bounds[0] >= items.least).tolist():
            # A bound equal to the k-th score may hide a document of equal score and smaller id.
            heap = [(-bounds[0, item], 0)]
            while heap and -heap[0][0] >= items.least[item]:
                _, node = heapq.heappop(heap)
                if self.halves[node] is None:
                    items.meet(item, self.docs.part(*self.spans[node]))
                    continue
                for half in self.halves[node]:
                    if bounds[half, item] >= items.least[item]:
                        heapq.heappush(heap, (-bounds[half, item], half))


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[np.ndarray, ...]]:
    """Blocks of documents with a term of the vocabulary: ids, n, edges, terms, occurrences."""
    held, docs, entries = [], 0, 0
    for batch in batches:
        ids, n = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("doc_id", "n"))
        lists = batch.column("terms")
        sizes = np.diff(lists.offsets.to_numpy())
        edges = np.concatenate([[0], np.cumsum(sizes)])
        terms, tfs = lists.flatten().to_numpy(), batch.column("tfs").flatten().to_numpy()
        start = 0
        while start < len(ids):
            room = np.searchsorted(edges, edges[start] + BLOCK_ENTRIES - entries, "right") - 1
            stop = min(max(int(room), start + (not held)), start + BLOCK - docs, len(ids))
            if stop > start:
                a, b = edges[start], edges[stop]
                held.append((ids[start:stop], n[start:stop], sizes[start:stop], terms[a:b], tfs[a:b]))
                docs, entries = docs + stop - start, entries + b - a
            if stop < len(ids):
                yield tuple(map(np.concatenate, zip(*held)))
                held, docs, entries = [], 0, 0
            start = stop
    if held:
        yield tuple(map(np.concatenate, zip(*held)))


def _slice(spark: SparkSession, docs: DataFrame, items: list, k: int) -> DataFrame:
    """Best documents of the items of one slice, per task."""
    known: dict[bytes, set] = {}
    for row in items:
        known.setdefault(row["item_id"], set()).update(terms_of(row["text"]))
    place = {t: i for i, t in enumerate(sorted(set().union(*known.values())))}

    def vectors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, counts, lists, tfs = [], [], [], []
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                found = terms_of(text.as_py())
                if not found:
                    continue
                tally: dict[int, int] = {}
                for t in found:
                    if (i := place.get(t)) is not None:
                        tally[i] = tally.get(i, 0) + 1
                ids.append(doc_id)
                counts.append(len(found))
                lists.append(list(tally))
                tfs.append(list(tally.values()))
            columns = [pa.array(ids, pa.int64()), pa.array(counts, pa.int64()), pa.array(lists, pa.list_(pa.int32())), pa.array(tfs, pa.list_(pa.int64()))]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "n", "terms", "tfs"])

    made = stored(docs.mapInArrow(vectors, "doc_id long, n long, terms array<int>, tfs array<long>"), "vectors")

    def tally(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        holders = np.zeros(len(place), np.int64)
        for batch in batches:
            holders += np.bincount(batch.column(0).flatten().to_numpy(), minlength=len(place))
        some = np.flatnonzero(holders)
        yield pa.RecordBatch.from_arrays([pa.array(some, pa.int64()), pa.array(holders[some])], ["term", "df"])

    n_docs, n_terms = made.agg(F.count("*"), F.coalesce(F.sum("n"), F.lit(0))).first()
    weights = np.zeros(len(place), np.int64)
    # At most as many rows as the slice has terms.
    for term, df in made.select("terms").mapInArrow(tally, "term long, df long").groupBy("term").agg(F.sum("df")).collect():
        weights[term] = math.floor(WEIGHT_SCALE * math.log((2 * n_docs + 2) / (2 * df + 1)))
    rows = [np.array(sorted(place[t] for t in terms), np.int64) for terms in known.values()]
    names = np.array(list(known), np.int64)

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        items = Items(names, rows, weights, k)
        for ids, n, sizes, terms, tfs in _blocks(batches):
            scores = term_scores(tfs, np.repeat(n, sizes), n_docs, n_terms)
            BallTree(Vectors(ids, np.concatenate([[0], np.cumsum(sizes)]), terms, scores), items.root).search(items)
        yield items.results()

    there = made.where(F.col("doc_id").isNotNull() & (F.size("terms") > 0))
    return there.mapInArrow(search, "item_id long, doc_id long, score long")


def ranked(df: DataFrame, items: DataFrame, k: int = 50, text: str = "text", key: str = "doc_id", item_key: str = "item_id", item_text: str = "text") -> DataFrame:
    """The ``k`` best documents of each item: item_id, rank (from 1), doc_id, score.

    Equal scores go by ascending id; documents that score 0 are left out. Null texts have no
    term. Documents with a null id count in the statistics and are not returned; documents
    that repeat are ranked each. Items with a null id take no part; rows with one item id are
    one item with the terms of all of them. Empty tables give no row.
    """
    asked = items.where(quoted(item_key).isNotNull()).select(quoted(item_key).cast("long").alias("item_id"), quoted(item_text).alias("text"))
    docs = df.select(quoted(key).cast("long").alias("doc_id"), quoted(text).alias("text"))
    size = asked.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0]
    slices = max(1, -(-size // SLICE_BYTES))
    parts = [asked.where(F.pmod(F.xxhash64("item_id"), F.lit(slices)) == s).collect() for s in range(slices)]
    found = reduce(DataFrame.unionByName, [_slice(df.sparkSession, docs, part, k) for part in parts])
    order = Window.partitionBy("item_id").orderBy(F.desc("score"), "doc_id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("item_id", "rank", "doc_id", "score")
