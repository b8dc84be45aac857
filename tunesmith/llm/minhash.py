"""Near-duplicate documents by MinHash bands and sequential Bayesian verification (op3).

1. Every whole text becomes its set of distinct word shingles (64-bit hashes), and that a
   MinHash signature, band hashes and a 128-bit digest. Texts with one digest are one class;
   all that follows is on classes, so copies cost nothing more.
2. Classes that share a band meet in that band's bucket. Their signatures are compared in
   batches; after each batch a pair is dropped if, given the matches so far and a uniform
   prior, its similarity reaches the threshold with a probability under ``MISS``. Of the
   pairs left a bucket returns a spanning forest only, never all pairs.
3. The forests' components are clusters of candidates. Members of a cluster meet with their
   full sets. Pairs that pass the sequential test are verified exactly on the sets, most
   matches first, unless verified links join them already; verified links are returned.
4. Components of the verified links give each row its smallest reachable id.

Buckets and clusters over a block's size are cut into blocks, and each pair of blocks is a
task of its own, so memory is bounded and no pair is left out.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Callable, Iterator
from functools import lru_cache
from itertools import repeat

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, functions as F

from tunesmith.llm.common import lookup_join, quoted
from tunesmith.llm.components import Forest, components
from tunesmith.sources.scratch import stored

WORDS, PERCENT = 5, 80
# Rows of a band; the probability that a pair at the threshold shares no band, and that of the sequential test.
ROWS, BAND_MISS, MISS = 6, 1e-5, 1e-7
# Signature values compared at a time; members and bytes of sets in a block; pairs and shingles looked at at once.
BATCH, BLOCK, BLOCK_BYTES, PAIRS, SHINGLES = 30, 2048, 16 << 20, 1 << 17, 1 << 15
# Rows that are signed and given out at once.
SIGNED_ROWS = 256
SEED = 11


def bands_for(percent: int) -> int:
    return math.ceil(math.log(BAND_MISS) / math.log(1 - (percent / 100) ** ROWS))


@lru_cache(4)
def _permutations(n: int) -> tuple[np.ndarray, np.ndarray]:
    rng = np.random.default_rng(SEED)
    return rng.integers(0, 1 << 63, n, np.uint64) * np.uint64(2) + np.uint64(1), rng.integers(0, 1 << 63, n, np.uint64)


def _mixed(x: np.ndarray) -> np.ndarray:
    """A fixed bijection of 64-bit numbers that spreads their bits (splitmix64's constants)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


@lru_cache(1)
def shingler() -> Callable[[str], np.ndarray]:
    """The sorted distinct shingle hashes of a text: letters A-Z made small, words cut at blanks, tabs and line ends."""
    weight = _mixed(np.arange(1, WORDS + 1, dtype=np.uint64)) | np.uint64(1)

    def of(text: str) -> np.ndarray:
        found = text.encode().lower().split()
        if not found:
            return np.zeros(0, np.uint64)
        h = np.frombuffer(b"".join(map(xxhash.xxh3_64_digest, found, repeat(SEED))), "<u8")
        if len(h) < WORDS:
            return _mixed((h * weight[: len(h)]).sum(keepdims=True) + np.uint64(len(h)))
        total = h[: len(h) - WORDS + 1] * weight[0]
        for k in range(1, WORDS):
            total += h[k : len(h) - WORDS + 1 + k] * weight[k]
        return np.unique(_mixed(total))

    return of


def signatures(sets: list[np.ndarray], n: int) -> np.ndarray:
    """The ``n`` minimum hashes of each set, none of which is empty."""
    a, b = _permutations(n)
    if not sets:
        return np.empty((0, n), np.uint64)
    out, start = np.empty((len(sets), n), np.uint64), 0
    while start < len(sets):
        stop, size = start, 0
        while stop < len(sets) and (size < SHINGLES or stop == start):
            size += len(sets[stop])
            stop += 1
        block = np.concatenate(sets[start:stop])
        edges = np.cumsum([0] + [len(s) for s in sets[start : stop - 1]])
        for k in range(n):
            out[start:stop, k] = np.minimum.reduceat(block * a[k] + b[k], edges)
        start = stop
    return out


def band_hashes(values: np.ndarray, bands: int) -> np.ndarray:
    h = np.zeros((len(values), bands), np.uint64) + _mixed(np.arange(bands, dtype=np.uint64) + np.uint64(1))
    for k in range(ROWS):
        h = _mixed(h * np.uint64(0x9E3779B97F4A7C15) + values[:, k : bands * ROWS : ROWS])
    return h.view(np.int64)


_SIGNED = pa.schema([("doc_id", pa.int64()), ("k1", pa.int64()), ("k2", pa.int64()), ("n", pa.int64()), ("digest", pa.binary()), ("sig", pa.binary()), ("bands", pa.list_(pa.int64()))])


def signed(docs: DataFrame, percent: int) -> DataFrame:
    """doc_id, k1, k2 of each row, and of its whole text the set size, digest of the set, signature (a byte per value) and band hashes.

    Rows go out a few hundred at a time, so a worker holds little more than the batch it is given.
    """
    bands = bands_for(percent)

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        of = shingler()
        for batch in batches:
            for start in range(0, batch.num_rows, SIGNED_ROWS):
                some = batch.slice(start, SIGNED_ROWS)
                found = [of(t.as_py() or "") for t in some.column("text")]
                sets = [x for x in found if len(x)]
                values = signatures(sets, bands * ROWS)
                rows = iter(zip(values.astype(np.uint8), band_hashes(values, bands)))
                sigs, hashes, digests = [], [], []
                for x in found:
                    sig, own = next(rows) if len(x) else (None, None)
                    sigs.append(None if sig is None else sig.tobytes())
                    hashes.append(own)
                    digests.append(hashlib.blake2b(x.tobytes(), digest_size=16).digest() if len(x) else None)
                columns = [some.column("doc_id"), some.column("k1"), some.column("k2"), pa.array([len(x) for x in found], pa.int64())]
                yield pa.RecordBatch.from_arrays([*columns, pa.array(digests, pa.binary()), pa.array(sigs, pa.binary()), pa.array(hashes, pa.list_(pa.int64()))], schema=_SIGNED)
            pa.default_memory_pool().release_unused()

    return docs.select("doc_id", "k1", "k2", "text").mapInArrow(sign, "doc_id long, k1 long, k2 long, n long, digest binary, sig binary, bands array<long>")


# Sequential test


@lru_cache(8)
def least_matches(n: int, percent: int) -> list[tuple[int, int]]:
    """(values compared, least matches to go on) after each batch.

    A pair goes on while the posterior probability, from a uniform prior, that its similarity
    is at the threshold or above is ``MISS`` or more. Chance matches of signature bytes only
    make a pair go on longer.
    """
    grid = np.linspace(0, 1, 20_001)[1:-1]
    high = grid >= percent / 100
    found = []
    for k in [*range(BATCH, n, BATCH), n]:
        for m in range(k + 1):
            logs = m * np.log(grid) + (k - m) * np.log1p(-grid)
            p = np.exp(logs - logs.max())
            if p[high].sum() / p.sum() >= MISS:
                break
        found.append((k, m))
    return found


def promising(sigs: np.ndarray, i: np.ndarray, j: np.ndarray, percent: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The pairs that pass every batch, and their matches."""
    matches, start = np.zeros(len(i), np.int32), 0
    for k, least in least_matches(sigs.shape[1], percent):
        matches = matches + (sigs[i, start:k] == sigs[j, start:k]).sum(1, dtype=np.int32)
        on = matches >= least
        i, j, matches, start = i[on], j[on], matches[on], k
        if not len(i):
            break
    return i, j, matches


def surviving(sigs: np.ndarray, sides: np.ndarray | None, percent: int) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of a group (of two blocks: across) that pass the test, most matches first."""
    found, n = [], len(sigs)
    if sides is None:
        first, partners = np.arange(n - 1), [np.arange(i + 1, n) for i in range(n - 1)]
    else:
        first, other = np.flatnonzero(sides == 0), np.flatnonzero(sides == 1)
        partners = [other] * len(first)
    at = 0
    while at < len(first):
        stop, size = at, 0
        while stop < len(first) and (size < PAIRS or stop == at):
            size += len(partners[stop])
            stop += 1
        i = np.repeat(first[at:stop], [len(p) for p in partners[at:stop]])
        found.append(promising(sigs, i, np.concatenate(partners[at:stop]), percent))
        at = stop
    if not found:
        return np.zeros(0, int), np.zeros(0, int)
    i, j, matches = (np.concatenate(x) for x in zip(*found))
    order = np.argsort(-matches, kind="stable")
    return i[order], j[order]


def _forest(nodes: list[int], pairs: Iterator[tuple[int, int]], linked: Callable[[int, int], bool]) -> list[tuple[int, int]]:
    """Of the pairs, in order, those that join two trees and are linked."""
    forest, found = Forest(), []
    for i, j in pairs:
        if forest.root(nodes[i]) != forest.root(nodes[j]) and linked(i, j):
            forest.join(nodes[i], nodes[j])
            found.append((nodes[i], nodes[j]))
    return found


def _groups(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[list[dict]]:
    """Rows of one key after another, from batches in the order of the keys."""
    at, group = None, []
    for batch in batches:
        for row in batch.to_pylist():
            key = tuple(row[k] for k in keys)
            if key != at and group:
                yield group
                group = []
            at = key
            group.append(row)
    if group:
        yield group


def _dealt(rows: DataFrame, group: str, parts: Column) -> DataFrame:
    """Rows of a group in the tasks of its block pairs: columns p <= q, and side (null inside one block)."""
    parts = parts.cast("int")
    rows = rows.withColumn("__parts", parts).withColumn("__own", F.pmod(F.xxhash64("node"), F.col("__parts")).cast("int"))
    rows = rows.withColumn("__other", F.explode(F.sequence(F.lit(0), F.col("__parts") - 1)))
    rows = rows.withColumn("p", F.least("__own", "__other")).withColumn("q", F.greatest("__own", "__other"))
    rows = rows.withColumn("side", F.when(F.col("p") != F.col("q"), (F.col("__own") == F.col("q")).cast("int")))
    return rows.drop("__parts", "__own", "__other").repartition(group, "p", "q").sortWithinPartitions(group, "p", "q")


def _edges(pairs: list[tuple[int, int]]) -> pa.RecordBatch:
    a, b = zip(*pairs) if pairs else ((), ())
    return pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], ["a", "b"])


def _arrays(group: list[dict]) -> tuple[list[int], np.ndarray, np.ndarray | None]:
    sigs = np.frombuffer(b"".join(r["sig"] for r in group), np.uint8).reshape(len(group), -1)
    sides = None if group[0]["side"] is None else np.array([r["side"] for r in group])
    return [r["node"] for r in group], sigs, sides


def _candidate_edges(classes: DataFrame, percent: int) -> DataFrame:
    rows = classes.select("node", F.explode("bands").alias("bucket"))
    sizes = rows.groupBy("bucket").agg(F.count("*").alias("n")).where("n > 1").withColumn("size", F.col("n"))
    met = lookup_join(rows, stored(sizes, "buckets"), "bucket", "n", "inner").join(classes.select("node", "sig"), "node")

    def test(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = []
        for group in _groups(batches, ["bucket", "p", "q"]):
            nodes, sigs, sides = _arrays(group)
            i, j = surviving(sigs, sides, percent)
            found += _forest(nodes, zip(i.tolist(), j.tolist()), lambda i, j: True)
            if len(found) > PAIRS:
                yield _edges(found)
                found = []
        yield _edges(found)

    return stored(_dealt(met, "bucket", F.ceil(F.col("size") / BLOCK)).mapInArrow(test, "a long, b long").distinct(), "candidates")


def _verified_edges(docs: DataFrame, classes: DataFrame, clusters: DataFrame, percent: int, repeated: bool) -> DataFrame:
    members = clusters.join(classes.select("node", "k1", "k2", "sig", "n"), "node")
    members = stored(members.withColumnRenamed("root", "cluster"), "members")
    sizes = members.groupBy("cluster").agg(F.count("*").alias("rows"), F.greatest(F.ceil(F.count("*") / BLOCK), F.ceil(F.sum("n") * 8 / BLOCK_BYTES)).alias("parts"))
    members = lookup_join(members, stored(sizes, "clusters"), "cluster", "rows")
    texts = docs.select("k1", "k2", "text")
    texts = texts.dropDuplicates(["k1", "k2"]) if repeated else texts
    joined = texts.join(members.drop("n"), ["k1", "k2"])

    @F.arrow_udf("binary")
    def full(texts: pa.Array) -> pa.Array:
        of = shingler()
        return pa.array([of(t.as_py() or "").tobytes() for t in texts], pa.binary())

    sets = joined.select("cluster", "parts", "node", "sig", full("text").alias("set"))

    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = []
        for group in _groups(batches, ["cluster", "p", "q"]):
            nodes, sigs, sides = _arrays(group)
            whole = [np.frombuffer(r["set"], "<u8") for r in group]

            def linked(i: int, j: int) -> bool:
                a, b = len(whole[i]), len(whole[j])
                if 100 * min(a, b) < percent * max(a, b):
                    return False
                both = a + b - len(np.union1d(whole[i], whole[j]))
                return 100 * both >= percent * (a + b - both)

            i, j = surviving(sigs, sides, percent)
            found += _forest(nodes, zip(i.tolist(), j.tolist()), linked)
            if len(found) > PAIRS:
                yield _edges(found)
                found = []
        yield _edges(found)

    return stored(_dealt(sets, "cluster", F.col("parts")).mapInArrow(verify, "a long, b long"), "links")


def _grouped(df: DataFrame, text: str, key: str, percent: int) -> tuple[DataFrame, bool]:
    """Per row: doc_id, k1, k2 (hashes that name the row), n, component_id, and first, the key hash of the row to keep."""
    docs = df.select(quoted(key).cast("long").alias("doc_id"), quoted(text).alias("text"))
    docs = docs.withColumn("k1", F.xxhash64("doc_id", "text")).withColumn("k2", F.xxhash64("text", F.lit(SEED), "doc_id"))
    rows = stored(signed(docs, percent), "signed")
    # Nulls come last, so that an id is preferred to none.
    order = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "k1", "k2")
    classes = rows.where("n > 0").groupBy("digest").agg(F.count("*").alias("copies"), F.min(order).alias("least"), F.first("n").alias("n"), F.first("sig").alias("sig"), F.first("bands").alias("bands"))
    classes = stored(classes.select(F.monotonically_increasing_id().alias("node"), "digest", "copies", "least", "least.k1", "least.k2", "n", "sig", "bands"), "classes")
    clusters = components(_candidate_edges(classes, percent))
    repeated = bool(rows.where("n > 0").groupBy("k1", "k2").agg(F.count("*").alias("c")).where("c > 1").limit(1).count())
    links = _verified_edges(docs, classes, clusters, percent, repeated)
    rooted = classes.select("node", "digest", "copies", "least").join(components(links), "node", "left")
    rooted = stored(rooted.withColumn("root", F.coalesce("root", "node")), "rooted")
    firsts = rooted.groupBy("root").agg(F.count("*").alias("c"), F.min("least").alias("first"))
    named = stored(lookup_join(rooted.select("root", "digest", "copies"), firsts, "root", "c").select("digest", "copies", "first"), "named")
    found = lookup_join(rows.select("doc_id", "k1", "k2", "n", "digest"), named, "digest", "copies")
    return found.withColumn("component_id", F.when(F.col("n") > 0, F.col("first.doc_id")).otherwise(F.col("doc_id"))), repeated


def near_duplicates(df: DataFrame, percent: int = PERCENT, text: str = "text", key: str = "doc_id") -> DataFrame:
    """Per row: doc_id, n_shingles, component_id, kept.

    Rows are linked if 100 times the intersection of their shingle sets is ``percent`` times
    the union or more. ``component_id`` is the smallest id that a row reaches over links, its
    own included; ``kept`` says that it is the row's own. Texts without words (null, empty)
    have no shingle and are linked with nothing. A null id is no component's name unless no
    row of it has an id; rows that repeat share their component. An empty table gives no row.
    """
    found, _ = _grouped(df, text, key, percent)
    return found.select("doc_id", F.col("n").alias("n_shingles"), "component_id", F.col("doc_id").eqNullSafe(F.col("component_id")).alias("kept"))


def one_of_each(df: DataFrame, percent: int = PERCENT, text: str = "text", key: str = "doc_id") -> DataFrame:
    """``df`` with one row of each component: the one of the smallest id, a null id being the largest.

    Rows without words all stay. Of rows that repeat with one id and text any one stays.
    """
    found, repeated = _grouped(df, text, key, percent)
    stay = found.where((F.col("n") == 0) | (F.col("k1").eqNullSafe(F.col("first.k1")) & F.col("k2").eqNullSafe(F.col("first.k2"))))
    stay = stay.select(F.col("k1").alias("__k1"), F.col("k2").alias("__k2"), (F.col("n") == 0).alias("__wordless")).distinct()
    names, plain = list(df.columns), df.toDF(*[f"c{k}" for k in range(len(df.columns))])
    key, text = F.col(f"c{names.index(key)}").cast("long"), F.col(f"c{names.index(text)}")
    keyed = plain.withColumn("__k1", F.xxhash64(key, text)).withColumn("__k2", F.xxhash64(text, F.lit(SEED), key))
    kept = keyed.join(stay, ["__k1", "__k2"])
    if repeated:
        kept = kept.where("__wordless").unionByName(kept.where("not __wordless").dropDuplicates(["__k1", "__k2"]))
    return kept.select(*plain.columns).toDF(*names)
