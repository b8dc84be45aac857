"""Tables stored in buckets of a join key, and joins of them that move no row.

Two tables with the same number of buckets of their join keys are joined bucket by bucket.
A bucket is one file and one task, so keys with very many rows are kept out of the buckets, in
a table of their own, and joined by ``skew_join``.

Bucketed tables are known to the session's catalog by a generated name; their files are in the
scratch folder. Both go when a ``released`` block ends.
"""

from __future__ import annotations

import math
import uuid
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, functions as F

from tunesmith.functions.exact import null_safe
from tunesmith.plans.sizing import if_small, rows_and_bytes
from tunesmith.plans.skew import HOT_ROWS, equi_join, few_rows, hot_keys, key_pairs, sketch_keys, skew_join, split_hot
from tunesmith.sources.scratch import drop_later, new_path, stored

BUCKET_BYTES = 256 << 20


@dataclass(frozen=True)
class Bucketed:
    """A table in ``buckets`` of ``keys``; ``hot`` has the keys that are not in them and ``rest`` their rows."""

    spark: SparkSession
    name: str
    keys: tuple[str, ...]
    buckets: int
    hot: DataFrame | None
    rest: DataFrame | None

    @property
    def cold(self) -> DataFrame:
        return self.spark.table(self.name)

    def rows(self) -> DataFrame:
        """All rows, in no order."""
        return self.cold if self.rest is None else self.cold.unionByName(self.rest)


def buckets_for(*tables: DataFrame) -> int:
    """Buckets for tables that are to be joined: of ``HOT_ROWS`` rows and ``BUCKET_BYTES`` at most, on average.

    A task sorts a whole bucket in memory, where rows take their full width. So they are counted:
    files are compressed, and an estimate that goes by them says little.
    """
    counted = [rows_and_bytes(t) for t in tables]
    return max(1, *(math.ceil(max(rows / HOT_ROWS, size / BUCKET_BYTES)) for rows, size in counted))


def write_bucketed(df: DataFrame, keys, buckets: int | None = None, hot_rows: int | None = None) -> Bucketed:
    """Store ``df`` in buckets of ``keys``, sorted by them, one file each.

    The rows of a key (NULL is one too) with more than ``hot_rows`` rows are stored apart.
    """
    spark, keys = df.sparkSession, [keys] if isinstance(keys, str) else list(keys)
    buckets = buckets or buckets_for(df)
    hot, rest, cold = None, None, df
    if hot_rows is not None or not few_rows(df, HOT_ROWS):
        hot_rows = hot_rows or HOT_ROWS
        (seen,) = sketch_keys([(df, keys)], hot_rows, null_is_key=True)
        if seen.likely is not None:
            found = stored(hot_keys(df, keys, seen.likely, hot_rows, null_is_key=True).drop("__skew_n"), "hot")
            if not found.isEmpty():
                hot = found
                cold, apart = split_hot(df, keys, hot)
                rest = stored(apart, "hot-rows")
    name = f"bucketed_{uuid.uuid4().hex}"
    drop_later(name)
    # Each task holds whole buckets, so that a bucket is one file.
    dealt = cold.repartition(buckets, *keys)
    dealt.write.bucketBy(buckets, *keys).sortBy(*keys).option("path", new_path(spark, "buckets")).saveAsTable(name)
    return Bucketed(spark, name, tuple(keys), buckets, hot, rest)


def _matching(rows: DataFrame, keys, hot: DataFrame, how: str) -> DataFrame:
    """The rows with one of the hot keys ("left_semi"), or the others ("left_anti")."""
    return rows.join(if_small(hot), null_safe(keys, hot.columns), how)


def bucketed_join(l: Bucketed, r: Bucketed, on=None, how: str = "inner", hot_rows: int | None = None) -> DataFrame:
    """Equi join of two bucketed tables on their bucket keys; the rows in buckets are not shuffled.

    ``on`` has key pairs in the order of the bucket keys, which it is when left out. The keys
    fall into two sets, those that are hot in either table and all others; each is joined by
    itself, so every join type is possible.
    """
    pairs = key_pairs(on or list(zip(l.keys, r.keys)))
    if [a for a, _ in pairs] != list(l.keys) or [b for _, b in pairs] != list(r.keys):
        raise ValueError(f"not the bucket keys {l.keys}, {r.keys}")
    if l.buckets != r.buckets:
        raise ValueError(f"{l.buckets} and {r.buckets} buckets: one table would be shuffled")
    # The rows of its own hot keys are not in a table's buckets already.
    left = l.cold if r.hot is None else _matching(l.cold, l.keys, r.hot, "left_anti")
    right = r.cold if l.hot is None else _matching(r.cold, r.keys, l.hot, "left_anti")
    out = equi_join(left, right.hint("merge"), pairs, how)
    if l.hot is None and r.hot is None:
        return out
    return out.unionByName(skew_join(_hot_rows(l, r.hot), _hot_rows(r, l.hot), pairs, how, hot_rows=hot_rows or HOT_ROWS))


def _hot_rows(table: Bucketed, others: DataFrame | None) -> DataFrame:
    """A table's rows with a key that is hot in it or in the other table."""
    found = [] if table.rest is None else [table.rest]
    if others is not None:
        found.append(_matching(table.cold, table.keys, others, "left_semi"))
    return found[0] if len(found) == 1 else found[0].unionByName(found[1])
