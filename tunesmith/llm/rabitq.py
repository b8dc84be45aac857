"""Nearest neighbours by randomly rotated one-bit codes (op1).

Each vector is taken relative to its cell's centroid, rotated at random and kept as its
signs, with two correction scalars: the length, and the inner product of the rotated unit
vector with its own sign vector. A query's inner product with a vector is estimated from
the packed signs (the query in 8-bit planes, "and" and bit counts) and the scalars; an error
bound says how far off the estimate may be. Only vectors whose lower bound of the distance
is within the tenth best exact distance so far are compared exactly.

Every query meets every vector: vectors are dealt out to chunks of bounded size, a task for
each, and each query is sent to each chunk once. A task codes its chunk once, holds it and
meets a block of queries at a time. Copies of queries are shuffled, never broadcast: Spark's
estimates do not see that they are copies.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from tunesmith.llm.common import quoted
from tunesmith.plans.sizing import shuffle_partitions
from tunesmith.sources.scratch import stored

# Bytes of vectors that are coded at once and worth a chunk; bytes of a chunk, about, at most; queries in a block, and bytes of its estimates.
BLOCK_BYTES, CHUNK_BYTES, QUERY_BLOCK, MATRIX_BYTES = 2 << 20, 16 << 20, 256, 8 << 20
# Chunks for each core, as long as they are no larger than that.
WAVES = 4
# Cells, and the bounded sample of vectors that their centroids are fitted on.
CELLS, SAMPLE, ROUNDS = 16, 2048, 8
# The bound holds for a vector with a probability of 1 - 2 exp(-c BOUND**2).
BOUND, BITS, SEED = 3.0, 8, 7


@lru_cache(4)
def rotation(dim: int) -> np.ndarray:
    q, r = np.linalg.qr(np.random.default_rng([SEED, dim]).standard_normal((dim, dim)))
    return q * np.sign(np.diag(r))


def fit_cells(sample: np.ndarray, cells: int = CELLS, rounds: int = ROUNDS) -> np.ndarray:
    """Centroids by k-means on a sample, first ones far apart."""
    if not len(sample):
        return np.zeros((1, sample.shape[1]))
    centroids = [sample.mean(0)]
    nearest = ((sample - centroids[0]) ** 2).sum(1)
    while len(centroids) < min(cells, len(sample)) and nearest.max() > 0:
        centroids.append(sample[nearest.argmax()])
        nearest = np.minimum(nearest, ((sample - centroids[-1]) ** 2).sum(1))
    found = np.array(centroids)
    for _ in range(rounds):
        own = cell_of(sample, found)
        for k in range(len(found)):
            if (own == k).any():
                found[k] = sample[own == k].mean(0)
    return found


def cell_of(vectors: np.ndarray, centroids: np.ndarray) -> np.ndarray:
    return ((centroids**2).sum(1)[None, :] - 2 * vectors @ centroids.T).argmin(1)


def packed(bits: np.ndarray) -> np.ndarray:
    """Rows of booleans as rows of 64-bit words."""
    pad = -bits.shape[-1] % 64
    wide = np.concatenate([bits, np.zeros((*bits.shape[:-1], pad), bool)], axis=-1) if pad else bits
    return np.packbits(wide, axis=-1, bitorder="little").view("<u8")


def codes_of(vectors: np.ndarray, centroids: np.ndarray) -> dict[str, np.ndarray]:
    """Cell, length, correction scalar and packed signs of each vector."""
    cell = cell_of(vectors, centroids)
    rest = vectors - centroids[cell]
    length = np.sqrt((rest**2).sum(1))
    unit = (rest / np.where(length > 0, length, 1)[:, None]) @ rotation(vectors.shape[1])
    own = np.abs(unit).sum(1) / np.sqrt(vectors.shape[1])
    return {"cell": cell.astype("<i4"), "length": length, "own": np.where(length > 0, own, 1.0), "signs": packed(unit > 0)}


class Queries:
    """A block of queries, prepared for each cell when first asked for."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray, centroids: np.ndarray):
        self.ids, self.vectors, self.centroids = ids, vectors, centroids
        self.turned = vectors @ rotation(vectors.shape[1])
        self.cells: dict[int, tuple] = {}

    def of_cell(self, cell: int) -> tuple:
        if cell not in self.cells:
            rest = self.turned - self.centroids[cell] @ rotation(self.vectors.shape[1])
            length = np.sqrt((rest**2).sum(1))
            unit = rest / np.where(length > 0, length, 1)[:, None]
            low = unit.min(1)
            step = np.maximum((unit.max(1) - low) / ((1 << BITS) - 1), 1e-300)
            whole = np.rint((unit - low[:, None]) / step[:, None]).astype(np.uint32)
            planes = [packed((whole >> b & 1).astype(bool)) for b in range(BITS)]
            self.cells[cell] = length, low, step, (low[:, None] + step[:, None] * whole).sum(1), planes
        return self.cells[cell]

    def lower_bounds(self, cell: int, length: np.ndarray, own: np.ndarray, signs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Estimated squared distances to a cell's vectors, and their lower bounds: queries x vectors."""
        dim = self.vectors.shape[1]
        far, low, step, total, planes = self.of_cell(cell)
        counts = np.zeros((len(self.ids), len(length)), np.int32)
        for b, plane in enumerate(planes):
            for word in range(signs.shape[1]):
                counts += np.bitwise_count(plane[:, None, word] & signs[None, :, word]).astype(np.int32) << b
        ones = np.bitwise_count(signs).sum(1, dtype=np.int64)
        product = (2 * (step[:, None] * counts + low[:, None] * ones[None, :]) - total[:, None]) / np.sqrt(dim)
        guess = product / own
        error = BOUND * np.sqrt(np.maximum(1 - own**2, 0)) / own / np.sqrt(max(dim - 1, 1)) + step[:, None] / 2 * np.sqrt(dim) / own
        base, scale = length**2 + (far**2)[:, None], 2 * length * far[:, None]
        return base - scale * guess, base - scale * (guess + error) - 1e-9 * base


class Best:
    """The nearest rows found so far for each query of a block."""

    def __init__(self, queries: Queries, k: int):
        self.queries, self.k = queries, k
        self.found = [(np.zeros(0), np.zeros(0, np.int64)) for _ in queries.ids]
        self.compared = 0

    def _compare(self, i: int, rows: np.ndarray, ids: np.ndarray, vectors: np.ndarray) -> None:
        self.compared += len(rows)
        rest = vectors[rows] - self.queries.vectors[i]
        if len(rows) > self.k:
            squares = np.einsum("ij,ij->i", rest, rest)
            # However the squares are added up, those beyond the k-th by more than rounding are out.
            close = squares <= np.partition(squares, self.k - 1)[self.k - 1] * (1 + 1e-9) + 1e-300
            rows, rest = rows[close], rest[close]
        # A running sum adds up in order, so equal vectors get equal scores anywhere.
        scores = np.sqrt(np.cumsum(rest * rest, axis=1)[:, -1]) if len(rows) else np.zeros(0)
        scores, ids = np.concatenate([self.found[i][0], scores]), np.concatenate([self.found[i][1], ids[rows]])
        order = np.lexsort((ids, scores))[: self.k]
        self.found[i] = scores[order], ids[order]

    def meet(self, ids: np.ndarray, vectors: np.ndarray, codes: dict[str, np.ndarray]) -> None:
        n = len(self.queries.ids)
        guess, least = np.empty((n, len(ids))), np.empty((n, len(ids)))
        for cell in np.unique(codes["cell"]):
            rows = np.flatnonzero(codes["cell"] == cell)
            guess[:, rows], least[:, rows] = self.queries.lower_bounds(cell, codes["length"][rows], codes["own"][rows], codes["signs"][rows])
        for i, own in enumerate(self.queries.ids):
            others = ids != own
            first = np.argpartition(guess[i], self.k)[: self.k + 1] if len(ids) > self.k + 1 else np.arange(len(ids))
            self._compare(i, first[others[first]], ids, vectors)
            full = len(self.found[i][0]) == self.k
            near = least[i] <= self.found[i][0][-1] ** 2 if full else np.ones(len(ids), bool)
            near[first] = False
            self._compare(i, np.flatnonzero(near & others), ids, vectors)

    def rows(self) -> pa.RecordBatch:
        counts = [len(s) for s, _ in self.found]
        owners = np.repeat(self.queries.ids, counts)
        scores = np.concatenate([s for s, _ in self.found] or [np.zeros(0)])
        ids = np.concatenate([i for _, i in self.found] or [np.zeros(0, np.int64)])
        return pa.RecordBatch.from_arrays([pa.array(owners, pa.int64()), pa.array(ids, pa.int64()), pa.array(scores, pa.float64())], ["query_id", "vec_id", "score"])


def usable(vector: Column) -> Column:
    """Not null, not empty, all components finite, not all zero."""
    odd = F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return vector.isNotNull() & (F.size(vector) > 0) & ~odd & F.exists(vector, lambda x: x != 0)


def _runs(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, int, pa.RecordBatch]]:
    """Each run of rows of one length and role, in order."""
    for batch in batches:
        if not batch.num_rows:
            continue
        dims, roles = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("dim", "role"))
        edges = [0, *(np.flatnonzero((dims[1:] != dims[:-1]) | (roles[1:] != roles[:-1])) + 1).tolist(), batch.num_rows]
        for a, b in zip(edges, edges[1:]):
            yield int(dims[a]), int(roles[a]), batch.slice(a, b - a)


def _arrays(batch: pa.RecordBatch, dim: int) -> tuple[np.ndarray, np.ndarray]:
    """Ids and vectors of a batch."""
    vectors = batch.column("v").flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, dim)
    return batch.column("id").to_numpy(zero_copy_only=False), vectors


def _coded(vectors: np.ndarray, centroids: np.ndarray) -> dict[str, np.ndarray]:
    """``codes_of`` in blocks of bounded size."""
    step = max(1, BLOCK_BYTES // (8 * vectors.shape[1]))
    parts = [codes_of(vectors[a : a + step], centroids) for a in range(0, len(vectors), step)]
    return {c: np.concatenate([x[c] for x in parts]) for c in parts[0]}


def _sample(rows: DataFrame, n: int) -> list:
    """The SAMPLE rows of least hash among ``n``. Rows of a low hash are looked at first, as each task sends as many as are asked for."""
    digest, few = F.xxhash64("id"), min(SAMPLE, n)
    low = rows if n <= 4 * SAMPLE else rows.where(digest < F.lit(4 * SAMPLE * 2**64 // n - 2**63))
    found = low.orderBy(digest, "id").limit(SAMPLE).select("v").collect()
    return found if len(found) == few else rows.orderBy(digest, "id").limit(SAMPLE).select("v").collect()


def _centroids(vectors: DataFrame, dim: int, n: int) -> np.ndarray:
    sample = _sample(vectors.where(F.col("dim") == dim), n)
    return fit_cells(np.array([r["v"] for r in sample], dtype=np.float64).reshape(-1, dim))


def nearest(df: DataFrame, is_query: Column, k: int = 10, key: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """The ``k`` nearest rows of each query row: query_id, rank (from 1), vec_id, score (Euclidean distance).

    ``is_query`` is a condition on the key. Ties go to the smaller id. Rows without an id or
    with an unusable vector take no part; vectors of different lengths are never compared.
    Of rows with one id the smallest vector counts, so repeated rows count once, and a query
    is no candidate of its own. With fewer than ``k`` candidates all are returned.
    """
    rows = df.where(usable(quoted(vector)) & quoted(key).isNotNull()).select(quoted(key).cast("long").alias("id"), quoted(vector).alias("v"), is_query.alias("q"))
    rows = stored(rows.groupBy("id", "q").agg(F.min("v").alias("v")).withColumn("dim", F.size("v")), "vectors")
    sizes = {r["dim"]: r["n"] for r in rows.groupBy("dim").agg(F.count("*").alias("n")).orderBy(F.desc("n")).limit(1).collect()}
    # Cells are fitted for the commonest length; vectors of another length have one cell at zero.
    cells = {dim: _centroids(rows, dim, n) for dim, n in sizes.items()}
    spark = df.sparkSession
    size = 8 * (rows.agg(F.sum("dim")).first()[0] or 0)
    tasks = min(shuffle_partitions(spark), WAVES * spark.sparkContext.defaultParallelism)
    chunks = max(1, min(-(-size // BLOCK_BYTES), tasks), -(-size // CHUNK_BYTES))
    index = rows.select("dim", F.pmod(F.xxhash64("id"), F.lit(chunks)).cast("int").alias("chunk"), F.lit(0).alias("role"), "id", "v")
    asked = rows.where("q").select("dim", F.explode(F.sequence(F.lit(0), F.lit(chunks - 1))).alias("chunk"), F.lit(1).alias("role"), "id", "v")
    met = index.unionByName(asked).repartitionById(chunks, "chunk").sortWithinPartitions("dim", "role", "id")

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, held, codes = None, [], None
        for dim, role, batch in _runs(batches):
            if dim != at:
                at, held, codes = dim, [], None
            ids, vectors = _arrays(batch, dim)
            if role == 0:
                held.append((ids, vectors))
                continue
            if not held:
                continue
            fitted = cells.get(dim, np.zeros((1, dim)))
            if codes is None:
                held = [tuple(np.concatenate(x) for x in zip(*held))]
                codes = _coded(held[0][1], fitted)
            step = max(1, min(QUERY_BLOCK, MATRIX_BYTES // (8 * len(held[0][0]))))
            for a in range(0, len(ids), step):
                best = Best(Queries(ids[a : a + step], vectors[a : a + step], fitted), k)
                best.meet(*held[0], codes)
                yield best.rows()

    found = met.mapInArrow(search, "query_id long, vec_id long, score double")
    order = Window.partitionBy("query_id").orderBy("score", "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
