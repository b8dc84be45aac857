"""Equi joins that hold when one key has a third of all rows.

Key hashes are counted in a fixed number of buckets (added up map-side). A bucket
with few rows holds no hot key; the keys of the others are counted exactly, so every
hot key is found. They stay in a table and never come to the driver. A hot key with ``n`` rows on
the left is cut into ``a`` cells and its right rows are copied to each of them;
a key that is hot on the right is cut into ``b`` cells the other way round. The
join keys become (keys, a, b), so every matching pair meets in exactly one cell.
With no hot key the plan is an ordinary join.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from tunesmith.functions.exact import all_of, any_null, null_safe, spread_hash
from tunesmith.plans.sizing import (
    broadcast_limit,
    estimated_bytes,
    if_small,
    measured_bytes,
    one_task_reads,
    shuffle_partitions,
)
from tunesmith.sources.scratch import stored

# Rows of one key that a single task handles without trouble.
HOT_ROWS = 2_000_000
# Buckets that key hashes are counted in; a bucket number is 4 bytes, so a list of them is under 1 MB.
BUCKETS = 1 << 17

ONE_SIDED = ("left_semi", "left_anti")


def key_pairs(on) -> list[tuple[str, str]]:
    """``"k"``, ``["a", "b"]`` or ``[("left_name", "right_name")]``."""
    on = [on] if isinstance(on, str) else list(on)
    return [(k, k) if isinstance(k, str) else tuple(k) for k in on]


def equi_join(l: DataFrame, r: DataFrame, on, how: str = "inner") -> DataFrame:
    """Join on key pairs. A key of one name on both sides comes out once."""
    pairs = key_pairs(on)
    shared = [a for a, b in pairs if a == b]
    clash = (set(l.columns) & set(r.columns)) - set(shared)
    if clash and how not in ONE_SIDED:
        raise ValueError(f"columns on both sides that are not join keys: {sorted(clash)}")
    wanted = [b for _, b in pairs] if how in ONE_SIDED else r.columns
    renamed = r.select([F.col(c).alias(f"__r_{c}") for c in wanted])
    joined = l.join(renamed, all_of([F.col(a) == F.col(f"__r_{b}") for a, b in pairs]), how)
    if how in ONE_SIDED:
        return joined
    both = how in ("right", "full")
    left_out = [
        F.coalesce(F.col(c), F.col(f"__r_{c}")).alias(c) if both and c in shared else F.col(c)
        for c in l.columns
    ]
    right_out = [F.col(f"__r_{c}").alias(c) for c in r.columns if c not in shared]
    return joined.select(left_out + right_out)


@dataclass
class Sketch:
    """What one pass over the key columns of a side found."""

    likely: DataFrame | None  # buckets of key hashes that may hold a hot key; None if there is none
    nulls: int  # rows with a NULL among the keys
    rows: int = 0  # of the side


def _bucket(keys) -> Column:
    return F.pmod(F.xxhash64(*[F.col(k) for k in keys]), F.lit(BUCKETS)).cast("int")


def sketch_keys(sides, hot_rows: int, null_is_key: bool = False) -> list[Sketch]:
    """Count the key hashes of one or more (table, keys) by bucket, in one job.

    ``null_is_key`` counts NULL as a key, as grouping does; a join does not. Every
    key with more than ``hot_rows`` rows is in a bucket with more than that, so none
    is missed, however many there are; ``hot_keys`` leaves the other buckets out.
    """
    if not sides:
        return []
    digests = [
        df.select(F.lit(i).alias("side"), F.when(F.lit(True) if null_is_key else ~any_null(keys), _bucket(keys)).alias("__skew_bucket"))
        for i, (df, keys) in enumerate(sides)
    ]
    counts = reduce(DataFrame.unionAll, digests).groupBy("side", "__skew_bucket").agg(F.count(F.lit(1)).alias("n"))
    # At most BUCKETS + 1 rows of a side.
    counts = stored(counts, "buckets")
    known = F.col("__skew_bucket").isNotNull()
    crowded = counts.where(known & (F.col("n") > hot_rows))
    nulls = F.coalesce(F.sum(F.when(~known, F.col("n"))), F.lit(0)).alias("nulls")
    totals = counts.groupBy("side").agg(F.count_if(known & (F.col("n") > hot_rows)).alias("buckets"), nulls, F.sum("n").alias("rows"))
    found = {row["side"]: row for row in totals.collect()}
    out = []
    for i in range(len(sides)):
        row = found.get(i)
        buckets = crowded.where(F.col("side") == i).select("__skew_bucket")
        out.append(Sketch(buckets if row and row["buckets"] else None, row["nulls"] if row else 0, row["rows"] if row else 0))
    return out


def hot_keys(df: DataFrame, keys, likely: DataFrame | None, hot_rows: int, null_is_key: bool = False) -> DataFrame:
    """Hot keys as ``__skew_k0, ...`` with their exact row counts ``__skew_n``; none is left out."""
    usable = df if null_is_key else df.where(~any_null(keys))
    keyed = usable.select(*[F.col(k).alias(f"__skew_k{i}") for i, k in enumerate(keys)], _bucket(keys).alias("__skew_bucket"))
    # At most BUCKETS rows of one number each.
    keyed = keyed.where("false") if likely is None else keyed.join(F.broadcast(likely), "__skew_bucket", "left_semi")
    counted = keyed.groupBy(*[f"__skew_k{i}" for i in range(len(keys))])
    return counted.agg(F.count(F.lit(1)).alias("__skew_n")).where(F.col("__skew_n") > hot_rows)


def few_rows(df: DataFrame, hot_rows: int) -> bool:
    """Can no key of the table be hot? Rows are counted where Catalyst's estimate says they may be few."""
    return one_task_reads(df) and df.count() <= hot_rows


def _cells(left_hot: DataFrame, right_hot: DataFrame, n_keys: int, hot_rows: int) -> DataFrame:
    """Hot keys of both sides with their numbers of cells, a cell for every ``hot_rows`` rows."""
    names = [f"__skew_k{i}" for i in range(n_keys)]

    def cut(n):
        return F.greatest(F.lit(1), F.ceil(F.sum(n) / hot_rows)).cast("int")

    none, rows = F.lit(0).cast("long"), F.col("__skew_n")
    both = left_hot.select(*names, rows.alias("l"), none.alias("r")).unionAll(
        right_hot.select(*names, none.alias("l"), rows.alias("r"))
    )
    cells = both.groupBy(*names).agg(cut("l").alias("__skew_ca"), cut("r").alias("__skew_cb"))
    # Written, so that both sides of the join see the same cells.
    return stored(cells, "cells")


def _in_cells(df, keys, cells, own, own_cells, other, other_cells, copied, spread_on, null_cells):
    """Give each row a cell of its own side and copy it to the other side's.

    ``copied`` is False if no key is hot on the other side. Rows of nothing but keys
    are equal in a hot key: they are numbered, and written so that the numbers stay.
    """
    columns = df.columns
    if spread_on is None and set(columns) <= set(keys):
        df = stored(df.withColumn("__skew_row", F.monotonically_increasing_id()), "numbered")
    names = [f"__skew_k{i}" for i in range(len(keys))]
    tagged = df.join(
        if_small(cells),
        all_of([F.col(k) == F.col(n) for k, n in zip(keys, names)]),
        "left",
    )
    everywhere = F.lit(max(shuffle_partitions(df.sparkSession), null_cells))
    spans = F.when(any_null(keys), everywhere).otherwise(F.coalesce(F.col(own_cells), F.lit(1)))
    cell = F.when(spans > 1, F.pmod(spread_hash(df, spread_on), spans)).otherwise(F.lit(0).cast("long"))
    copies = F.coalesce(F.col(other_cells), F.lit(1)) if copied else F.lit(1)
    each = F.explode(F.sequence(F.lit(0).cast("long"), (copies - 1).cast("long")))
    return (
        tagged.withColumns({own: cell, "__skew_copies": copies})
        .withColumn(other, each if copied else F.lit(0).cast("long"))
        .drop("__skew_ca", "__skew_cb", "__skew_row", *names)
    )


def _known_size(copied: DataFrame) -> bool:
    """Spark would broadcast this side by an estimate that ignores the copies:
    is it small with them too? A side that is planned to be shuffled needs no
    check, its size is known by then.
    """
    limit = broadcast_limit(copied.sparkSession)
    return estimated_bytes(copied) > limit or measured_bytes(copied) <= limit


def skew_join(
    l: DataFrame,
    r: DataFrame,
    on,
    how: str = "inner",
    *,
    hot_rows: int | None = None,
    hint: str | None = None,
    hint_left: bool = False,
    unique_right: bool = False,
    spread_on=None,
    parts: int | None = None,
    late: tuple[dict[str, Column], dict[str, Column]] = ({}, {}),
) -> DataFrame:
    """Equi join with hot keys cut into cells.

    ``how``: inner, left, right, full, left_semi or left_anti. ``spread_on``
    names left columns that differ between rows of one key (default: all). It
    is read only when there is a hot key. ``unique_right`` says that no key
    comes twice on the right, which saves looking for hot keys there. ``parts``
    shuffles both sides into that many parts, which are not merged if they are small. ``late``
    has columns of each side that are made of its others when its rows are in their part, and
    so are not shuffled with them.
    """
    pairs = key_pairs(on)
    lk, rk = [a for a, _ in pairs], [b for _, b in pairs]
    if how in ONE_SIDED:
        # One row per key is enough to know that a key exists.
        r, unique_right = r.select(*rk).where(~any_null(rk)).distinct(), True
    keeps_left = how in ("left", "full", "left_anti")
    keeps_right = how in ("right", "full")
    # No key is hot in a table of few rows, unless the caller says so.
    look = [hot_rows is not None or not few_rows(l, HOT_ROWS), False]
    look[1] = not unique_right and (hot_rows is not None or not few_rows(r, HOT_ROWS))
    hot_rows = hot_rows or HOT_ROWS
    found = iter(sketch_keys([side for side, yes in zip([(l, lk), (r, rk)], look) if yes], hot_rows))
    left, right = [next(found) if yes else Sketch(None, 0) for yes in look]

    def hinted(a, b, on):
        if parts:
            a, b = a.repartition(parts, *[x for x, _ in on]), b.repartition(parts, *[y for _, y in on])
        a, b = (df.withColumns(made) if made else df for df, made in zip((a, b), late))
        if not hint:
            return a, b
        return (a.hint(hint), b) if hint_left else (a, b.hint(hint))

    crowded_nulls = (keeps_left and left.nulls > hot_rows) or (keeps_right and right.nulls > hot_rows)
    if left.likely is None and right.likely is None and not crowded_nulls:
        a, b = hinted(l, r, pairs)
        return equi_join(a, b, pairs, how)

    cells = _cells(
        hot_keys(l, lk, left.likely, hot_rows), hot_keys(r, rk, right.likely, hot_rows), len(pairs), hot_rows
    )
    a = l if keeps_left else l.where(~any_null(lk))
    b = r if keeps_right else r.where(~any_null(rk))
    a = _in_cells(a, lk, cells, "__skew_a", "__skew_ca", "__skew_b", "__skew_cb", right.likely is not None, spread_on, -(-left.nulls // hot_rows))
    b = _in_cells(b, rk, cells, "__skew_b", "__skew_cb", "__skew_a", "__skew_ca", left.likely is not None, None, -(-right.nulls // hot_rows))
    in_cell = pairs + [("__skew_a", "__skew_a"), ("__skew_b", "__skew_b")]
    if not (hint or (_known_size(a) and _known_size(b))):
        hint = "merge"
    if how in ONE_SIDED:
        a, b = hinted(a, b, in_cell)
        return equi_join(a, b, in_cell, how).select(l.columns)
    a = a.withColumnRenamed("__skew_copies", "__skew_lcopies").withColumn("__skew_lhit", F.lit(1))
    b = b.withColumnRenamed("__skew_copies", "__skew_rcopies").withColumn("__skew_rhit", F.lit(1))
    a, b = hinted(a, b, in_cell)
    out = equi_join(a, b, in_cell, how)
    # A row copied for a key that is hot on the other side does have partners
    # there, so a copy that met none in its cell is not an unmatched row.
    if keeps_left:
        out = out.where(~(F.col("__skew_rhit").isNull() & (F.col("__skew_lcopies") > 1)))
    if keeps_right:
        out = out.where(~(F.col("__skew_lhit").isNull() & (F.col("__skew_rcopies") > 1)))
    same = [x for x, y in pairs if x == y]
    mine, yours = (df.columns + [c for c in made if c not in df.columns] for df, made in zip((l, r), late))
    return out.select(mine + [c for c in yours if c not in same])


def split_hot(df: DataFrame, by, hot: DataFrame):
    """Rows of cold groups and rows of hot groups; NULL is a group."""
    match = null_safe(by, [f"__skew_k{i}" for i in range(len(by))])
    hot = if_small(hot)
    return df.join(hot, match, "left_anti"), df.join(hot, match, "left_semi")
