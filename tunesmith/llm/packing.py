"""Documents packed into training sequences by non-negative least squares (op8).

A document's ids are cut at multiples of the window; whole windows are sequences of their
own. What is left of each document has a length under the window. All sets of two or three
such lengths that fill a window are enumerated, and the repeat counts of these sets are
solved by non-negative least squares against the histogram of lengths (Kosec et al. 2021),
rounded, and lowered where they ask for more pieces than there are. The residual lengths are
packed greedily, longest first and filled up with the longest that fits; what would leave
more than ``SLACK`` places empty is laid end to end instead and cut at the window.

The histogram has a row per length, whatever the data; only it reaches the driver. A piece
is found by its length and its number among the pieces of that length, which come from
counts per bucket and length and a running number inside a bucket.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from tunesmith.llm.common import quoted
from tunesmith.sources.scratch import new_path

WINDOW, SLACK, ROUNDS = 1024, 8, 400
# Documents, about, in a bucket.
BUCKET = 200_000


def combinations(lengths: np.ndarray, window: int) -> np.ndarray:
    """All sets of two or three of the lengths that sum to the window, as rows; 0 stands for no third."""
    there = np.zeros(window + 1, bool)
    there[lengths] = True
    pairs = [(a, window - a, 0) for a in lengths if 2 * a <= window and there[window - a]]
    found = [np.array(pairs, np.int64).reshape(-1, 3)]
    for a in lengths:
        if 3 * a > window:
            continue
        b = lengths[(lengths >= a) & (2 * lengths <= window - a)]
        b = b[there[window - a - b]]
        found.append(np.column_stack([np.full(len(b), a), b, window - a - b]))
    return np.concatenate(found)


def least_squares(sets: np.ndarray, counts: np.ndarray, rounds: int = ROUNDS) -> np.ndarray:
    """Repeat counts x >= 0 that make sum(x * pieces of a set) come closest to the histogram.

    Accelerated projected gradient, started anew where the error rises; each set has at most
    three entries, so a step costs three gathers and three sums.
    """
    if not len(sets):
        return np.zeros(0)
    size, cells = len(counts), sets.ravel()

    def pieces(x):
        out = np.bincount(cells, np.repeat(x, 3), size)
        out[0] = 0
        return out

    def against(r):
        return r[sets].sum(1)

    v = np.ones(len(sets))
    for _ in range(15):
        v = against(pieces(v))
        norm = np.sqrt(v @ v)
        v /= norm
    step = 1 / (1.05 * norm)
    target = counts.astype(np.float64)
    target[0] = 0
    x = ahead = np.zeros(len(sets))
    t, error = 1.0, np.inf
    for _ in range(rounds):
        rest = pieces(ahead) - target
        after = np.maximum(ahead - step * against(rest), 0)
        now = rest @ rest
        if now > error:
            t, ahead = 1.0, x
            error = np.inf
            continue
        error, further = now, (1 + np.sqrt(1 + 4 * t * t)) / 2
        ahead = after + (t - 1) / further * (after - x)
        x, t = after, further
    return x


@dataclass
class Plan:
    """Where the pieces of each length go.

    ``segments``: rows (length, first, base, times, offset) in order; the pieces of a length
    from number ``first`` on lie, ``times`` in a row from ``offset``, in sequences from
    ``base`` on. ``covered``: per length, the pieces in segments. The others, and only they,
    are laid end to end from place ``streamed`` of their length on, in sequences from
    ``stream`` on. Whole windows are sequences from ``whole`` on.
    """

    window: int
    segments: np.ndarray
    covered: np.ndarray
    streamed: np.ndarray
    whole: int
    stream: int

    def place(self, rest: np.ndarray, number: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Sequence and offset of the start of each piece of length ``rest``."""
        planned = number < self.covered[rest]
        sequence, offset = np.empty_like(number), np.empty_like(number)
        if planned.any():
            keys = (self.segments[:, 0] << 44) + self.segments[:, 1]
            at = np.searchsorted(keys, (rest[planned] << 44) + number[planned], "right") - 1
            _, first, base, times, start = self.segments[at].T
            copy, slot = np.divmod(number[planned] - first, times)
            sequence[planned], offset[planned] = base + copy, start + slot * rest[planned]
        loose = ~planned
        place = self.streamed[rest[loose]] + (number[loose] - self.covered[rest[loose]]) * rest[loose]
        sequence[loose], offset[loose] = self.stream + place // self.window, place % self.window
        return sequence, offset


def plan_of(counts: np.ndarray, whole: int, window: int = WINDOW, slack: int = SLACK) -> Plan:
    """A plan for ``counts[n]`` pieces of each length n under the window, and ``whole`` full windows."""
    counts = counts.astype(np.int64).copy()
    counts[0] = 0
    left, used = counts.copy(), np.zeros(window, np.int64)
    segments, base = [], whole

    def take(lengths: list[tuple[int, int]], copies: int) -> None:
        nonlocal base
        offset = 0
        for n, times in lengths:
            segments.append((n, used[n], base, times, offset))
            offset += n * times
            used[n] += copies * times
            left[n] -= copies * times
        base += copies

    sets = combinations(np.flatnonzero(counts), window)
    x = least_squares(sets, counts)
    # Rounded sums along the sets, so that many small counts keep their total.
    repeats = np.diff(np.floor(np.cumsum(x) + 0.5), prepend=0.0).astype(np.int64)
    for k in np.argsort(-repeats, kind="stable"):
        if repeats[k] <= 0:
            break
        own: dict[int, int] = {}
        for n in sets[k].tolist():
            if n:
                own[n] = own.get(n, 0) + 1
        copies = min(int(repeats[k]), *(int(left[n]) // times for n, times in own.items()))
        if copies:
            take(sorted(own.items()), copies)

    loose = np.zeros(window, np.int64)
    while left.any():
        longest = int(np.flatnonzero(left)[-1])
        gap, chosen = window, []
        at = longest
        while gap and at:
            times = min(int(left[at]), gap // at)
            if times:
                chosen.append((at, times))
                gap -= at * times
            fit = np.flatnonzero(left[: min(at - 1, gap) + 1])
            at = int(fit[-1]) if len(fit) else 0
        if gap <= slack:
            take(chosen, min(int(left[n]) // times for n, times in chosen))
        else:
            loose[longest], left[longest] = left[longest], 0
    table = np.array(sorted(segments), np.int64).reshape(-1, 5)
    streamed = np.concatenate([[0], np.cumsum(loose * np.arange(window))[:-1]])
    return Plan(window, table, used, streamed, 0, base)


def pieces(df: DataFrame, ids: Callable, window: int = WINDOW, text: str = "text", key: str = "doc_id") -> DataFrame:
    """Per piece: doc_id, start, length, doc_tokens, sequence_id, offset, ids (binary, little-endian 32-bit).

    ``ids`` makes a binary column of ids, end id included, from the text column. Sequences
    are filled from 0 without gaps up to ``window``; a document without ids gives no piece.
    Null keys and repeated rows are packed like others; an empty table gives no row.
    """
    spark = df.sparkSession
    encoded = df.select(quoted(key).alias("doc_id"), ids(F.coalesce(quoted(text), F.lit(""))).alias("ids"))
    path = new_path(spark, "tokens")
    encoded = encoded.select(F.monotonically_increasing_id().alias("row"), "doc_id", (F.octet_length("ids") / 4).cast("long").alias("doc_tokens"), "ids")
    encoded.write.option("compression", "zstd").parquet(path)
    tokens = spark.read.schema(encoded.schema).parquet(path)

    sizes = tokens.select("row", "doc_tokens", F.floor(F.col("doc_tokens") / window).alias("windows"), (F.col("doc_tokens") % window).alias("rest"))
    buckets = max(1, -(-sizes.count() // BUCKET))
    sizes = sizes.withColumn("bucket", F.pmod(F.xxhash64("row"), F.lit(buckets)).cast("int"))
    counts = sizes.groupBy("bucket", "rest").agg(F.count("*").alias("n"), F.sum("windows").alias("windows"))
    histogram = np.zeros(window, np.int64)
    whole = 0
    for r in counts.groupBy("rest").agg(F.sum("n").alias("n"), F.sum("windows").alias("windows")).collect():
        histogram[r["rest"]] = r["n"]
        whole += r["windows"]
    plan = plan_of(histogram, whole, window)

    # Numbers of a bucket's first piece of each length, and of its first whole window.
    before = (Window.unboundedPreceding, -1)
    lengths = counts.withColumn("first", F.coalesce(F.sum("n").over(Window.partitionBy("rest").orderBy("bucket").rowsBetween(*before)), F.lit(0)))
    firsts = counts.groupBy("bucket").agg(F.sum("windows").alias("w"))
    firsts = firsts.select("bucket", F.coalesce(F.sum("w").over(Window.orderBy("bucket").rowsBetween(*before)), F.lit(0)).alias("first_window"))
    numbered = sizes.withColumn("k", F.row_number().over(Window.partitionBy("bucket", "rest").orderBy("row")) - 1)
    numbered = numbered.withColumn("w", F.coalesce(F.sum("windows").over(Window.partitionBy("bucket").orderBy("row").rowsBetween(*before)), F.lit(0)))
    numbered = numbered.join(lengths.select("bucket", "rest", "first"), ["bucket", "rest"]).join(firsts, "bucket")
    numbered = numbered.select("row", "windows", "rest", (F.col("first") + F.col("k")).alias("number"), (F.col("first_window") + F.col("w")).alias("window"))

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            row, windows, rest, number, first = (batch.column(c).to_numpy(zero_copy_only=False).astype(np.int64) for c in ("row", "windows", "rest", "number", "window"))
            sequence, offset = plan.place(rest, number)
            cut = (offset + rest > window) & (rest > 0)
            n = windows + (rest > 0) + cut
            doc = np.repeat(np.arange(len(row)), n)
            at = np.arange(len(doc)) - np.repeat(np.cumsum(n) - n, n)
            full = at < windows[doc]
            second = at == windows[doc] + 1
            head = np.minimum(rest, window - offset)[doc]
            length = np.where(full, window, np.where(second, rest[doc] - head, head))
            start = np.where(second, windows[doc] * window + head, at * window)
            out = [row[doc], start, length, np.where(full, plan.whole + first[doc] + at, sequence[doc] + second), np.where(full | second, 0, offset[doc])]
            yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in out], ["row", "start", "length", "sequence_id", "offset"])

    placed = numbered.mapInArrow(assign, "row long, start long, length long, sequence_id long, offset long")
    joined = placed.join(tokens, "row")
    part = F.substring(F.col("ids"), (4 * F.col("start") + 1).cast("int"), (4 * F.col("length")).cast("int"))
    return joined.select("doc_id", "start", "length", "doc_tokens", "sequence_id", "offset", part.alias("ids"))


def digests(packed: DataFrame) -> DataFrame:
    """``pieces`` with ``ids_crc32`` in place of the ids."""
    return packed.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")
