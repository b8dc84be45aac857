"""Ordered scans (running totals, ranks, lag, last value) without a hot task.

A window over a group puts the whole group in one task. Here that is done only
in tables whose groups are all known to be small. Tables with a hot group, and scans
with no group at all, are range-partitioned on (group, order), stored with their
partition number, and scanned part by part. Only the first and the last group of a part
can go on in another one; those are given what the parts before left over, one summary
row per part and group. So the input is looked at for hot groups, sampled for the parts'
bounds and stored, whatever the number of hot groups.
"""

from __future__ import annotations

import math
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, Window, WindowSpec, functions as F

from tunesmith.functions.exact import null_safe
from tunesmith.plans.skew import HOT_ROWS, few_rows, sketch_keys
from tunesmith.plans.sizing import if_small, shuffle_partitions
from tunesmith.sources.scratch import stored

MAX_PARTS = 100_000


def parts_for(spark: SparkSession, rows: int, hot_rows: int) -> int:
    """Parts of ``hot_rows`` rows; small ones no more than a few per task slot."""
    small = min(math.ceil(rows / hot_rows), 4 * shuffle_partitions(spark))
    return max(1, min(MAX_PARTS, max(small, math.ceil(rows / HOT_ROWS))))


def has_hot_group(df: DataFrame, by, hot_rows: int | None = None) -> bool:
    """May a group of ``by`` have over ``hot_rows`` rows? NULL is a group."""
    if hot_rows is None and few_rows(df, HOT_ROWS):
        return False
    (seen,) = sketch_keys([(df, by)], hot_rows or HOT_ROWS, null_is_key=True)
    return seen.likely is not None


def ordered_scan(
    df: DataFrame,
    by,
    order,
    name: str,
    local: Callable[[WindowSpec], Column],
    summary: Column,
    carry: Callable[[Column, WindowSpec], Column],
    merge: Callable[[Column, Column], Column],
    hot_rows: int | None = None,
    whole: tuple[str, Column, Column] | None = None,
    counted_in: DataFrame | None = None,
) -> DataFrame:
    """Add column ``name``, a scan over each group in ``order``.

    ``local(w)``    the scan within one window
    ``summary``     aggregate that tells later parts what this part did
    ``carry(s, w)`` the summaries of all earlier parts in one value
    ``merge(x, c)`` the scan's value, given the local value and the carry
    ``whole``       (name, aggregate, aggregate of summaries): a second column
                    with a value of the whole group
    ``counted_in``  a table with at least the rows of each group that is
                    cheaper to look for hot groups in
    """
    source = df if counted_in is None else counted_in
    look = hot_rows is not None or not few_rows(source, HOT_ROWS)
    hot_rows = hot_rows or HOT_ROWS
    by, order = list(by), list(order)

    def in_one_task(rows):
        group = Window.partitionBy(*(by or [F.lit(0)]))
        out = rows.withColumn(name, local(group.orderBy(*order)))
        return out.withColumn(whole[0], whole[1].over(group)) if whole else out

    def in_parts(rows, n):
        parts = max(2, parts_for(df.sparkSession, n, hot_rows))
        return _by_parts(rows, by, order, name, local, summary, carry, merge, whole, parts)

    if not by:
        rows = df.count()
        return in_one_task(df) if rows <= hot_rows else in_parts(df, rows)
    (seen,) = sketch_keys([(source, by)], hot_rows, null_is_key=True) if look else (None,)
    return in_one_task(df) if seen is None or seen.likely is None else in_parts(df, seen.rows)


def _by_parts(df, by, order, name, local, summary, carry, merge, whole, parts):
    ranged = df.repartitionByRange(parts, *by, *order)
    ranged = stored(ranged.withColumn("__scan_part", F.spark_partition_id()), "parts")
    keys, group = ["__scan_part", *by], by or [F.lit(0)]
    open_ = _open_groups(ranged, by) if by else ranged
    left_over = open_.groupBy(*keys).agg(summary.alias("__scan_sum"))
    before = Window.partitionBy(*group).orderBy("__scan_part").rowsBetween(Window.unboundedPreceding, -1)
    left_over = left_over.withColumn("__scan_carry", carry(F.col("__scan_sum"), before)).withColumn("__scan_open", F.lit(True))
    extra = []
    if whole:
        left_over = left_over.withColumn("__scan_whole", whole[2].over(Window.partitionBy(*group)))
        extra = ["__scan_whole"]
    left_over = left_over.select(*[F.col(k).alias(f"__scan_{k}") for k in keys], "__scan_carry", "__scan_open", *extra)
    # At most two rows per part.
    left_over = stored(left_over, "carry")
    within = Window.partitionBy("__scan_part", *by)
    out = ranged.withColumn("__scan_value", local(within.orderBy(*order)))
    if whole:
        out = out.withColumn("__scan_own", whole[1].over(within))
    out = out.join(if_small(left_over), null_safe(keys, [f"__scan_{k}" for k in keys]), "left")
    out = out.withColumn(name, merge(F.col("__scan_value"), F.col("__scan_carry")))
    if whole:
        out = out.withColumn(whole[0], F.when(F.col("__scan_open"), F.col("__scan_whole")).otherwise(F.col("__scan_own")))
    # A carried sum may have a wider type than the scan has in one task.
    made = {name: local(Window.partitionBy(*group).orderBy(*order))} | ({whole[0]: whole[1].over(Window.partitionBy(*group))} if whole else {})
    kinds = df.select(*[c.alias(n) for n, c in made.items()]).schema
    wider = [n for n in made if kinds[n].dataType.simpleString() != out.schema[n].dataType.simpleString()]
    out = out.withColumns({n: F.col(n).cast(kinds[n].dataType) for n in wider}) if wider else out
    return out.select(*df.columns, name, *([whole[0]] if whole else []))


def _open_groups(ranged: DataFrame, by) -> DataFrame:
    """The rows of groups that are the first or the last of a part: all others lie in one part."""
    key = F.struct(*by)
    ends = ranged.groupBy("__scan_part").agg(F.array(F.min(key), F.max(key)).alias("__ends"))
    ends = ends.select(F.explode("__ends").alias("__end")).distinct()
    ends = ends.select(*[F.col("__end").getField(k).alias(f"__scan_{k}") for k in by])
    return ranged.join(if_small(stored(ends, "ends")), null_safe(by, [f"__scan_{k}" for k in by]), "left_semi")


def running_sum(df, by, order, value, name, hot_rows=None, total=None, counted_in=None):
    """Sum of ``value`` from the first row of the group to this one.

    ``total`` names a second column with the sum of the whole group.
    """
    return ordered_scan(
        df,
        by,
        order,
        name,
        local=lambda w: F.sum(value).over(w.rowsBetween(Window.unboundedPreceding, 0)),
        summary=F.sum(value),
        carry=lambda s, w: F.sum(s).over(w),
        merge=lambda x, c: F.when(x.isNull(), c).otherwise(x + F.coalesce(c, F.lit(0))),
        hot_rows=hot_rows,
        whole=(total, F.sum(value), F.sum("__scan_sum")) if total else None,
        counted_in=counted_in,
    )


def running_sums(df, by, order, values, name, hot_rows=None):
    """Struct of the running sums of several columns, NULL counting as 0."""

    def each(make):
        return F.struct(*[make(v).alias(v) for v in values])

    return ordered_scan(
        df,
        by,
        order,
        name,
        local=lambda w: each(lambda v: F.sum(F.coalesce(v, F.lit(0))).over(w.rowsBetween(Window.unboundedPreceding, 0))),
        summary=each(lambda v: F.sum(F.coalesce(v, F.lit(0)))),
        carry=lambda s, w: each(lambda v: F.sum(s[v]).over(w)),
        merge=lambda x, c: each(lambda v: x[v] + F.coalesce(c[v], F.lit(0))),
        hot_rows=hot_rows,
    )


def row_numbers(df, by, order, name, hot_rows=None):
    """1, 2, 3, ... in each group."""
    return ordered_scan(
        df,
        by,
        order,
        name,
        local=lambda w: F.row_number().over(w).cast("long"),
        summary=F.count(F.lit(1)),
        carry=lambda s, w: F.sum(s).over(w),
        merge=lambda x, c: x + F.coalesce(c, F.lit(0)),
        hot_rows=hot_rows,
    )


def previous_value(df, by, order, value, name, hot_rows=None):
    """``value`` of the row before; ascending ``order`` and no NULL ``value``."""
    return ordered_scan(
        df,
        by,
        order,
        name,
        local=lambda w: F.lag(value).over(w),
        summary=F.max_by(value, F.struct(*order)),
        carry=lambda s, w: F.last(s).over(w),
        merge=lambda x, c: F.coalesce(x, c),
        hot_rows=hot_rows,
    )


def last_value(df, by, order, value, name, hot_rows=None):
    """Latest ``value`` that is not NULL, up to this row; ascending ``order``."""
    return ordered_scan(
        df,
        by,
        order,
        name,
        local=lambda w: F.last(value, ignorenulls=True).over(w.rowsBetween(Window.unboundedPreceding, 0)),
        summary=F.max_by(value, F.when(F.col(value).isNotNull(), F.struct(*order))),
        carry=lambda s, w: F.last(s, ignorenulls=True).over(w),
        merge=lambda x, c: F.coalesce(x, c),
        hot_rows=hot_rows,
    )
