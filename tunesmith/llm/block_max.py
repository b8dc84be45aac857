"""Exact top-k inner products by block-at-a-time pruning (op13).

Components become whole numbers. Rows are dealt out to chunks by a hash of their id, and a
task orders a chunk's rows by cell and id and cuts that order into ranges of ``BLOCK`` rows.
A block holds its rows in a forward index (one line per row) and, per component, the largest
and the smallest value in it. For a query the sum of its best possible products per component
bounds every score of a block. Blocks are taken in the order of that bound, and each is scored
whole, until the next bound is below the query's k-th score.

Many queries are served at a time: in each round every open query asks for its next block, and
queries that ask for one block are scored in one product. Cells only decide which rows are
neighbours in a chunk; they are fitted on a bounded sample and change no result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from tunesmith.llm.common import quoted
from tunesmith.llm.rabitq import cell_of, fit_cells
from tunesmith.plans.sizing import shuffle_partitions
from tunesmith.sources.scratch import stored

SCALE = 256
# Rows of a block; bytes of a chunk at eight per component, and rows that are worth a chunk; queries of a part.
BLOCK, CHUNK_BYTES, CHUNK_ROWS, PART = 128, 16 << 20, 2048, 4096
# Cells, and the bounded sample of rows that they are fitted on.
CELLS, SAMPLE = 64, 2048
# Its negative is a 64-bit number too.
LOWEST = np.iinfo(np.int64).min + 1


def usable(vector: Column) -> Column:
    """Not null, not empty, all components finite."""
    return vector.isNotNull() & (F.size(vector) > 0) & ~F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))


def whole_numbers(vector: Column, scale: int = SCALE) -> Column:
    """floor(scale * x) of each component, in double precision; beyond 64 bits the nearest such number."""
    return F.transform(vector, lambda x: F.floor(scale * x.cast("double")))


def _kind(largest: int, dim: int) -> tuple[str, type]:
    """The narrowest column type for such components, and a type in which products of rows are exact."""
    column = "smallint" if largest < 1 << 15 else "int" if largest < 1 << 31 else "bigint"
    total = largest * largest * dim
    return column, np.float32 if total < 1 << 24 else np.float64 if total < 1 << 53 else object


def _clipped(scores: np.ndarray) -> np.ndarray:
    """Whole scores as 64-bit numbers; what is beyond them becomes the nearest one above LOWEST."""
    return (np.clip(scores, LOWEST + 1, np.iinfo(np.int64).max) if scores.dtype == object else scores).astype(np.int64)


class Chunk:
    """Rows in blocks, each with its components' largest and smallest values."""

    def __init__(self, ids: np.ndarray, rows: np.ndarray, centroids: np.ndarray, exact: type):
        # Ties in the order go by id, so the blocks are the same in every run.
        order = np.lexsort((ids, cell_of(rows.astype(np.float64), centroids)))
        self.ids, self.exact = ids[order], exact
        self.rows = rows[order].astype(exact)
        starts = np.arange(0, len(ids), BLOCK)
        self.most = np.maximum.reduceat(self.rows, starts, axis=0)
        self.least = np.minimum.reduceat(self.rows, starts, axis=0)

    def bounds(self, queries: np.ndarray) -> np.ndarray:
        """Queries x blocks: no row of the block scores higher."""
        zero = queries * 0
        return _clipped(np.maximum(queries, zero) @ self.most.T + np.minimum(queries, zero) @ self.least.T)

    def best(self, ids: np.ndarray, queries: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, int]:
        """Scores and ids of each query's ``k`` best (LOWEST where there are fewer), and the blocks scored."""
        queries = queries.astype(self.exact)
        bounds = self.bounds(queries)
        order = np.argsort(-bounds, axis=1, kind="stable")
        bounds = np.take_along_axis(bounds, order, axis=1)
        scores, found = np.full((len(ids), k), LOWEST), np.full((len(ids), k), np.iinfo(np.int64).max)
        scored, at = 0, 0
        open_ = np.arange(len(ids))
        while len(open_) and at < order.shape[1]:
            # A bound equal to the k-th score may hide a row of equal score and smaller id.
            open_ = open_[bounds[open_, at] >= scores[open_, -1]]
            asked = order[open_, at]
            turn = np.argsort(asked, kind="stable")
            for group in np.split(open_[turn], np.flatnonzero(np.diff(asked[turn])) + 1):
                if len(group):
                    self._score(order[group[0], at], group, ids, queries, scores, found)
            scored, at = scored + len(open_), at + 1
        return scores, found, scored

    def _score(self, block: int, group: np.ndarray, ids: np.ndarray, queries: np.ndarray, scores: np.ndarray, found: np.ndarray) -> None:
        k = scores.shape[1]
        rows, own = self.rows[block * BLOCK : (block + 1) * BLOCK], self.ids[block * BLOCK : (block + 1) * BLOCK]
        new = _clipped(queries[group] @ rows.T)
        new[ids[group][:, None] == own[None, :]] = LOWEST
        better = new.max(axis=1) >= scores[group, -1]
        group, new = group[better], new[better]
        if not len(group):
            return
        if new.shape[1] > k:
            # All but those that tie with or beat the k-th best of the block are out.
            new = np.where(new >= -np.partition(-new, k - 1, axis=1)[:, k - 1 : k], new, LOWEST)
        both = np.concatenate([scores[group], new], axis=1)
        names = np.concatenate([found[group], np.broadcast_to(own, new.shape)], axis=1)
        first = np.lexsort((names, -both), axis=-1)[:, :k]
        scores[group], found[group] = np.take_along_axis(both, first, axis=1), np.take_along_axis(names, first, axis=1)


def _matrix(batch: pa.RecordBatch, dim: int) -> np.ndarray:
    return batch.column("v").flatten().to_numpy(zero_copy_only=False).reshape(-1, dim)


def _runs(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[tuple[tuple, pa.RecordBatch]]:
    """Each run of rows of one key, in order."""
    for batch in batches:
        if not batch.num_rows:
            continue
        values = np.column_stack([batch.column(c).to_numpy(zero_copy_only=False) for c in keys])
        edges = [0, *(np.flatnonzero((values[1:] != values[:-1]).any(axis=1)) + 1).tolist(), batch.num_rows]
        for a, b in zip(edges, edges[1:]):
            yield tuple(values[a].tolist()), batch.slice(a, b - a)


def top_products(df: DataFrame, is_query: Column, k: int = 5, key: str = "vec_id", vector: str = "embedding", scale: int = SCALE) -> DataFrame:
    """The ``k`` rows of largest inner product for each query row: query_id, rank (from 1), vec_id, score (long).

    ``is_query`` is a condition on the key. Ties go to the smaller id; a query is no candidate
    of its own. Rows without an id, and vectors that are null, empty or hold a null or a
    component that is not finite, take no part; vectors of zeros do. Vectors of different
    lengths are never compared. Of rows with one id the smallest vector counts. With fewer
    than ``k`` candidates all are returned; an empty table gives no row. Scores beyond 64 bits
    count as the nearest long.
    """
    rows = df.where(usable(quoted(vector)) & quoted(key).isNotNull()).select(quoted(key).cast("long").alias("id"), whole_numbers(quoted(vector), scale).alias("v"), is_query.alias("q"))
    rows = stored(rows.groupBy("id", "q").agg(F.min("v").alias("v")).withColumn("dim", F.size("v")), "whole-vectors")
    least, most = F.min(F.array_min("v")), F.max(F.array_max("v"))
    seen = rows.agg(F.count("*").alias("n"), F.count_if("q").alias("q"), F.max("dim").alias("dim"), F.sum("dim").alias("cells"), least.alias("least"), most.alias("most")).first()
    largest = max(abs(seen["least"] or 0), abs(seen["most"] or 0), 1)
    column, exact = _kind(largest, seen["dim"] or 1)
    tasks = min(shuffle_partitions(df.sparkSession), -(-seen["n"] // CHUNK_ROWS))
    chunks = max(1, tasks, -(-(seen["cells"] or 0) * 8 // CHUNK_BYTES))
    parts = max(1, -(-seen["q"] // PART))
    commonest = rows.groupBy("dim").count().orderBy(F.desc("count"), "dim").limit(1).collect()
    fitted = {}
    for dim in (r["dim"] for r in commonest):
        sample = rows.where(F.col("dim") == dim).orderBy(F.xxhash64("id"), "id").limit(SAMPLE).select("v").collect()
        fitted[dim] = fit_cells(np.array([r["v"] for r in sample], dtype=np.float64).reshape(-1, dim), CELLS, 4)

    narrow = F.col("v").cast(f"array<{column}>").alias("v")
    dealt = [F.pmod(F.xxhash64("id"), F.lit(chunks)).cast("int"), F.pmod(F.xxhash64("id", F.lit(1)), F.lit(parts)).cast("int")]
    every = [F.explode(F.sequence(F.lit(0), F.lit(n - 1))) for n in (chunks, parts)]
    index = rows.select("dim", dealt[0].alias("chunk"), every[1].alias("part"), F.lit(0).alias("role"), "id", narrow)
    asked = rows.where("q").select("dim", every[0].alias("chunk"), dealt[1].alias("part"), F.lit(1).alias("role"), "id", narrow)
    keys = ["dim", "chunk", "part"]
    met = index.unionByName(asked).repartition(max(chunks * parts, 1) if chunks * parts < shuffle_partitions(df.sparkSession) else shuffle_partitions(df.sparkSession), *keys)

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, held, chunk = None, [], None
        for (*place, role), batch in _runs(batches, [*keys, "role"]):
            if place != at:
                at, held, chunk = place, [], None
            ids, vectors = batch.column("id").to_numpy(zero_copy_only=False), _matrix(batch, place[0])
            if role == 0:
                held.append((ids, vectors))
                continue
            if chunk is None:
                if not held:
                    continue
                whole, held = [np.concatenate(x) for x in zip(*held)], []
                chunk = Chunk(*whole, fitted.get(place[0], np.zeros((1, place[0]))), exact)
            scores, found, _ = chunk.best(ids, vectors, k)
            there = scores > LOWEST
            columns = [np.repeat(ids, there.sum(axis=1)), found[there], scores[there]]
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], ["query_id", "vec_id", "score"])

    found = met.sortWithinPartitions(*keys, "role").mapInArrow(search, "query_id long, vec_id long, score long")
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
