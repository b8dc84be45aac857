"""Token counts by byte-pair merging with a heap and a linked list (op10).

Every pre-token starts as its bytes in a linked list. A heap holds the adjacent pairs that
have a rank; the pair of lowest rank, and of those the leftmost, is merged, and the pairs at
its two sides are pushed. A popped pair whose symbols have changed meanwhile is skipped. A
pre-token's count is its bytes less the merges made: identifiers are never looked up.
"""

from __future__ import annotations

import heapq
import json
from collections.abc import Callable

import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from tunesmith.llm.common import quoted
from tunesmith.llm.tokens import ByteLevel, letters_of, worker_kept

LIMIT = 512


def merge_ranks(path: str) -> dict[tuple[str, str], int]:
    with open(path, encoding="utf-8") as file:
        merges = json.load(file)["model"]["merges"]
    return {tuple(m if isinstance(m, list) else m.split(" ")): rank for rank, m in enumerate(merges)}


def merged_count(symbols: list[str], ranks: dict[tuple[str, str], int]) -> int:
    """Symbols left of a list when no adjacent pair has a rank any more."""
    n = len(symbols)
    if n < 2:
        return n
    symbols = list(symbols)
    after, before = list(range(1, n + 1)), list(range(-1, n - 1))
    heap = [(rank, i, pair) for i, pair in enumerate(zip(symbols, symbols[1:])) if (rank := ranks.get(pair)) is not None]
    heapq.heapify(heap)
    left = n
    while heap:
        _, i, (a, b) = heapq.heappop(heap)
        j = after[i]
        if symbols[i] != a or j >= n or symbols[j] != b:
            continue
        symbols[i], symbols[j] = a + b, ""
        k = after[i] = after[j]
        left -= 1
        if k < n:
            before[k] = i
            pair = (symbols[i], symbols[k])
            if (rank := ranks.get(pair)) is not None:
                heapq.heappush(heap, (rank, i, pair))
        if (h := before[i]) >= 0:
            pair = (symbols[h], symbols[i])
            if (rank := ranks.get(pair)) is not None:
                heapq.heappush(heap, (rank, h, pair))
    return left


def counter(path: str) -> Callable[[str], int]:
    """Number of tokens of a text; one worker keeps the counts of the pieces it has met."""
    return worker_kept(("counts", path), lambda: _counter(path))


def _counter(path: str) -> Callable[[str], int]:
    ranks = merge_ranks(path)
    return ByteLevel(lambda pretoken: merged_count(list(letters_of(pretoken)), ranks), 1, sum)


def token_count(text: Column, path: str) -> Column:
    """The number of tokens of a whole text under a byte-level vocabulary like byte_bpe_50k.json.

    A null or empty text has 0 tokens; a text of any length is counted whole. Other columns,
    repeated rows and empty tables are not touched by it.
    """

    @F.arrow_udf("long")
    def count(texts: pa.Array) -> pa.Array:
        of = counter(path)
        return pa.array([of(t) if t else 0 for t in texts.to_pylist()], pa.int64())

    return count(text)


def token_counts(df: DataFrame, path: str, text: str = "text", key: str = "doc_id", limit: int = LIMIT) -> DataFrame:
    """Per row: key, ``n_bytes`` (UTF-8), ``n_tokens``, and ``over_limit`` (more tokens than ``limit``).

    Null keys are kept; rows that repeat are counted each.
    """
    counted = df.select(quoted(key).alias(key), F.coalesce(F.octet_length(quoted(text)), F.lit(0)).cast("long").alias("n_bytes"), token_count(quoted(text), path).alias("n_tokens"))
    return counted.withColumn("over_limit", F.col("n_tokens") > limit)
