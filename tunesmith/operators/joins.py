"""Joins by method, outer joins, scalar lookups, semi and anti joins."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from tunesmith.functions.exact import any_null, null_safe, spread_hash
from tunesmith.plans.sizing import fits_broadcast, shuffle_partitions
from tunesmith.plans.skew import ONE_SIDED, equi_join, key_pairs, skew_join
from tunesmith.sources.scratch import stored

COMPARE = {
    "=": lambda a, b: a == b,
    "<>": lambda a, b: a != b,
    "<": lambda a, b: a < b,
    "<=": lambda a, b: a <= b,
    ">": lambda a, b: a > b,
    ">=": lambda a, b: a >= b,
}


def theta_join(l: DataFrame, r: DataFrame, cond: Column, how: str = "inner", limit: int | None = None) -> DataFrame:
    """Join on any predicate over the (distinctly named) columns of both sides.

    A side whose bytes are under the broadcast limit is sent to every executor
    and looped over there. When both are larger, the pairs are laid out as a
    grid of cells that each get a slice of both sides. Any predicate means that
    every pair has to be looked at; use ``band_join``, ``asof_join`` or
    ``running_total`` where the predicate allows it.

    ``how``: inner, left, right, full, left_semi or left_anti.
    """
    clash = set(l.columns) & set(r.columns)
    if clash:
        raise ValueError(f"columns on both sides: {sorted(clash)}")
    if how == "right":
        return theta_join(r, l, cond, "left", limit).select(l.columns + r.columns)
    if fits_broadcast(r, limit) and how != "full":
        return l.join(F.broadcast(r), cond, how)
    if how == "inner" and fits_broadcast(l, limit):
        return F.broadcast(l).join(r, cond, how).select(l.columns + r.columns)
    if how == "inner":
        return _grid(l, r, cond)
    # The pairs are looked at once. Rows of equal values have the same partners,
    # so the matched rows can be told by value.
    pairs = _grid(l, r, cond)
    if how in ONE_SIDED:
        return _of_matched(l, pairs, how)
    pairs = stored(pairs, "pairs")
    out = pairs.unionByName(_of_matched(l, pairs, "left_anti"), allowMissingColumns=True)
    return out.unionByName(_of_matched(r, pairs, "left_anti"), allowMissingColumns=True) if how == "full" else out


def _of_matched(side: DataFrame, pairs: DataFrame, how: str) -> DataFrame:
    """The rows of a side that are, or are not, in any pair."""
    matched = pairs.select([F.col(c).alias(f"__m_{c}") for c in side.columns]).distinct()
    return side.join(matched, null_safe(side.columns, matched.columns), how)


def _grid(l: DataFrame, r: DataFrame, cond: Column) -> DataFrame:
    """Every pair meets in one cell (row slice, column slice); hash-balanced."""
    cells = shuffle_partitions(l.sparkSession)
    n_l, n_r = max(1, l.count()), max(1, r.count())
    across = max(1, min(cells, round((cells * n_l / n_r) ** 0.5)))
    down = max(1, cells // across)
    a = l.withColumn("__i", F.pmod(spread_hash(l), F.lit(across))).withColumn(
        "__j", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(down - 1).cast("long")))
    )
    b = r.withColumn("__rj", F.pmod(spread_hash(r), F.lit(down))).withColumn(
        "__ri", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(across - 1).cast("long")))
    )
    in_cell = (F.col("__i") == F.col("__ri")) & (F.col("__j") == F.col("__rj"))
    return a.join(b.hint("merge"), in_cell & cond).select(l.columns + r.columns)


def merge_join(l: DataFrame, r: DataFrame, on, how: str = "inner", **skew) -> DataFrame:
    """Equi join by sorting and merging both sides."""
    return skew_join(l, r, on, how, hint="merge", **skew)


def hash_join(l: DataFrame, r: DataFrame, on, how: str = "inner", build: str = "right", **skew) -> DataFrame:
    """Equi join that hashes the partitions of the ``build`` side.

    A hash table has to fit one task, so hot keys are cut up on both sides.
    Spark cannot build the side whose unmatched rows are wanted by a semi or
    anti join; those need ``build="right"``.
    """
    if build not in ("left", "right"):
        raise ValueError("build is 'left' or 'right'")
    if build == "left" and how in ONE_SIDED:
        raise ValueError(f"{how} can only build the right side")
    return skew_join(l, r, on, how, hint="shuffle_hash", hint_left=build == "left", **skew)


def broadcast_join(l: DataFrame, r: DataFrame, on, how: str = "inner", limit: int | None = None, **skew) -> DataFrame:
    """Equi join with the right side on every executor, if it is small.

    For a right join the left side is the one to send. Over the limit, and for
    a full join, the join is shuffled.
    """
    if how in ("inner", "left", *ONE_SIDED) and fits_broadcast(r, limit):
        return equi_join(l, F.broadcast(r), on, how)
    if how == "right" and fits_broadcast(l, limit):
        return equi_join(F.broadcast(l), r, on, how)
    return skew_join(l, r, on, how, **skew)


def outer_join(l: DataFrame, r: DataFrame, on, side: str = "left", **skew) -> DataFrame:
    """Left, right or full outer equi join. NULL keys match nothing."""
    if side not in ("left", "right", "full"):
        raise ValueError("side is 'left', 'right' or 'full'")
    return broadcast_join(l, r, on, side, **skew)


def _grouped(inner: DataFrame, keys, agg: Column, name: str) -> DataFrame:
    return inner.where(~any_null(keys)).groupBy(*keys).agg(agg.alias(name))


def scalar_lookup(df: DataFrame, inner: DataFrame, on, agg: Column, name: str, empty=None, **skew) -> DataFrame:
    """Add a correlated aggregate of ``inner`` as a column.

    ``inner`` is grouped once instead of being visited per row. Rows without
    partners get ``empty``: NULL, or 0 for a count.
    """
    keys = [b for _, b in key_pairs(on)]
    out = skew_join(df, _grouped(inner, keys, agg, name), on, "left", unique_right=True, **skew)
    if empty is not None:
        out = out.withColumn(name, F.coalesce(F.col(name), F.lit(empty)))
    return out.select(*df.columns, name)


def scalar_filter(
    df: DataFrame, inner: DataFrame, on, agg: Column, cmp: str, value: Column, empty=None, **skew
) -> DataFrame:
    """Rows for which ``value cmp (correlated aggregate)`` is true.

    ``value`` is an expression over ``df``. With ``empty`` set (0 for a count)
    rows without partners are compared with it, else they are dropped.
    """
    if empty is None:
        keys = [b for _, b in key_pairs(on)]
        joined = skew_join(df, _grouped(inner, keys, agg, "__agg"), on, "inner", unique_right=True, **skew)
    else:
        joined = scalar_lookup(df, inner, on, agg, "__agg", empty, **skew)
    return joined.where(COMPARE[cmp](value, F.col("__agg"))).select(df.columns)


def top1_lookup(df: DataFrame, inner: DataFrame, on, order, cols, **skew) -> DataFrame:
    """Add ``cols`` of the first matching row of ``inner`` in ``order``.

    The rank filter is applied before the shuffle too, so a hot key sends one
    row per map task.
    """
    pairs = key_pairs(on)
    keys = [b for _, b in pairs]
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    first = inner.where(~any_null(keys)).withColumn("__rn", rank).where(F.col("__rn") == 1)
    found = skew_join(df, first.select(*keys, *cols), pairs, "left", unique_right=True, **skew)
    return found.select(*df.columns, *cols)


def semi_join(l: DataFrame, r: DataFrame, on, **skew) -> DataFrame:
    """Rows of ``l`` with a partner (EXISTS, IN)."""
    return broadcast_join(l, r.select([b for _, b in key_pairs(on)]), on, "left_semi", **skew)


def anti_join(l: DataFrame, r: DataFrame, on, **skew) -> DataFrame:
    """Rows of ``l`` without a partner (NOT EXISTS); NULL keys are kept."""
    return broadcast_join(l, r.select([b for _, b in key_pairs(on)]), on, "left_anti", **skew)


def not_in(l: DataFrame, r: DataFrame, on, **skew) -> DataFrame:
    """SQL ``NOT IN`` on one column.

    Nothing is returned if the list holds a NULL, everything if it is empty,
    and rows with a NULL are not returned otherwise. Spark's own plan for
    ``NOT IN`` broadcasts the list whatever its size; here what kind of list it
    is comes from a scalar subquery and the rest is an ordinary anti join.
    """
    pairs = key_pairs(on)
    if len(pairs) != 1:
        raise ValueError("one column only")
    ((lk, rk),) = pairs
    unknown = F.coalesce(F.bool_or(F.col(rk).isNull()), F.lit(False))
    kind = F.when(unknown, "null").when(F.count(F.lit(1)) > 0, "values").otherwise("empty")
    listed = r.select(kind).scalar()
    rest = anti_join(l, r.select(rk).where(F.col(rk).isNotNull()), pairs, **skew)
    return rest.where((listed == "empty") | ((listed == "values") & F.col(lk).isNotNull()))
