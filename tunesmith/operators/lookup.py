"""Answering from less data: summaries, late fetch, lists, top-n and pages."""

from __future__ import annotations

import math
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F, types as T

from tunesmith.functions.exact import all_of, any_of, at_least, at_most, day_column, day_of, typed
from tunesmith.operators.joins import broadcast_join
from tunesmith.plans.ordered import row_numbers
from tunesmith.plans.sizing import scan_tasks
from tunesmith.sources.scratch import stored
from tunesmith.sources.tables import table_files

# Bytes of rows that one task merges.
ONE_TASK_BYTES = 1 << 30
# Folders of a summary that is kept up to date: its rows, and the files that are in it.
ROWS, FILES = "rows", "files"
# Keys that are put into a scan's filter as literals.
LITERAL_KEYS = 10_000
LITERAL_LIST = 1_000


def write_summary(df: DataFrame, keys, measures, path: str) -> None:
    """Keep rows, sum, count, min and max of each measure per key combination."""
    _summary(df, keys, measures).write.parquet(path)


def _summary(df: DataFrame, keys, measures) -> DataFrame:
    aggs = [F.count(F.lit(1)).alias("rows")]
    for m in measures:
        aggs += [
            F.sum(m).alias(f"{m}__sum"),
            F.count(m).alias(f"{m}__count"),
            F.min(m).alias(f"{m}__min"),
            F.max(m).alias(f"{m}__max"),
        ]
    return df.groupBy(*keys).agg(*aggs)


def from_summary(spark: SparkSession, path: str, by, aggs: dict[str, tuple[str, str | None]]) -> DataFrame:
    """Roll a written summary up to fewer keys.

    ``aggs`` maps a name to ("rows", None) or (sum|count|avg|min|max, measure).
    An average comes from the kept sum and count, never from averages.
    """

    def roll(fn, m) -> Column:
        if fn == "rows":
            return F.sum("rows")
        if fn == "avg":
            # No rows with a value: NULL.
            n = F.sum(f"{m}__count")
            return F.sum(f"{m}__sum").cast("double") / F.when(n > 0, n)
        merge = {"sum": F.sum, "count": F.sum, "min": F.min, "max": F.max}[fn]
        return merge(f"{m}__{fn}")

    columns = [roll(fn, m).alias(name) for name, (fn, m) in aggs.items()]
    return spark.read.parquet(path).groupBy(*by).agg(*columns)


def refresh_summary(spark: SparkSession, source: str, keys, measures, path: str, derive=None) -> int:
    """Bring the summary at ``path`` up to date with the Parquet table ``source``; returns the files it read.

    ``path`` holds the summary and a list of the files in it. Files that have come since are
    summarized alone and added; readers roll the parts up anyway. A summary cannot take rows
    back, so a source with changed or missing files is refused: write a new summary for it.
    ``derive`` makes the keys and measures from the source's rows where they are no columns.
    """
    there = table_files(spark, source)
    try:
        known = spark.read.parquet(f"{path}/{FILES}")
    except AnalysisException as missing:
        if missing.getCondition() != "PATH_NOT_FOUND":
            raise
        known = there.limit(0)
    lost = known.join(there, known.columns, "left_anti")
    if not lost.isEmpty():
        raise ValueError(f"{lost.count()} files of the summary are changed or gone")
    new = stored(there.join(known, there.columns, "left_anti"), "new-files")
    total = new.count()
    slices = -(-total // LITERAL_KEYS)
    for k in range(slices):
        some = new.where(F.pmod(F.xxhash64("file_path"), F.lit(slices)) == k)
        names = [r["file_path"] for r in some.collect()]
        if not names:
            continue
        rows = spark.read.parquet(source).where(F.col("_metadata.file_path").isin(names))
        _summary(derive(rows) if derive else rows, keys, measures).write.mode("append").parquet(f"{path}/{ROWS}")
        some.write.mode("append").parquet(f"{path}/{FILES}")
    return total


def from_smallest(spark: SparkSession, paths, by, aggs: dict[str, tuple[str, str | None]]) -> DataFrame:
    """Answer from the summary of fewest rows that has the keys and the measures asked for."""
    needed = set(by) | {f"{m}__{fn}" for fn, m in aggs.values() if m and fn != "avg"}
    needed |= {f"{m}__{part}" for fn, m in aggs.values() if fn == "avg" for part in ("sum", "count")}
    fit = [p for p in paths if needed <= set(spark.read.parquet(p).columns)]
    if not fit:
        raise ValueError(f"no summary has {sorted(needed)}")
    # The rows are in the files' ends, so no data is read.
    return from_summary(spark, min(fit, key=lambda p: spark.read.parquet(p).count()), by, aggs)


def top_n(df: DataFrame, order, n: int, hot_rows: int | None = None) -> DataFrame:
    """First ``n`` rows of a total order, in that order.

    Each task keeps ``n`` rows and one task merges them. When that would be too many
    bytes, teams of tasks are merged first, and for a large ``n`` the rows are ranked in place
    and sorted in parts.
    """
    if _fits_one_task(df, n):
        return df.orderBy(*order).limit(n)
    if n <= _cut_before_shuffle(df):
        return _best_of_teams(df, [], order, n).orderBy(*order).limit(n)
    ranked = row_numbers(df, [], order, "__rn", hot_rows)
    return ranked.where(F.col("__rn") <= n).orderBy("__rn").drop("__rn")


def _fits_one_task(df: DataFrame, n: int) -> bool:
    """Can one task merge the best ``n`` rows of all scan tasks?"""
    width = df._jdf.schema().defaultSize() + 16
    return n * scan_tasks(df) * width <= ONE_TASK_BYTES


def top_n_per_group(df: DataFrame, by, order, n: int, hot_rows: int | None = None) -> DataFrame:
    """First ``n`` rows of each group.

    For a small ``n`` Spark cuts each group to ``n`` rows before and after the
    shuffle; if a hot group would still get too many rows from all tasks, teams
    of tasks are merged first. For a large ``n`` hot groups are ranked in parts.
    """
    if n <= _cut_before_shuffle(df):
        if not _fits_one_task(df, n):
            df = _best_of_teams(df, by, order, n)
        ranked = df.withColumn("__rn", F.row_number().over(Window.partitionBy(*by).orderBy(*order)))
    else:
        ranked = row_numbers(df, by, order, "__rn", hot_rows)
    return ranked.where(F.col("__rn") <= n).drop("__rn")


def _cut_before_shuffle(df: DataFrame) -> int:
    """Largest n for which Spark cuts groups on the map side."""
    return int(df.sparkSession.conf.get("spark.sql.optimizer.windowGroupLimitThreshold", "1000"))


def _best_of_teams(df, by, order, n):
    teams = F.lit(math.ceil(scan_tasks(df) ** 0.5))
    teamed = df.withColumn("__team", F.pmod(F.spark_partition_id(), teams))
    rank = F.row_number().over(Window.partitionBy("__team", *by).orderBy(*order))
    return teamed.withColumn("__rn", rank).where(F.col("__rn") <= n).drop("__team", "__rn")


def late_fetch(df: DataFrame, key: str, order, n: int, wide_cols) -> DataFrame:
    """Top ``n`` rows with wide columns that are read for few rows.

    The rows are chosen on key and order columns alone. Their keys then go into
    the second scan's filter as literals, so files, row groups and pages
    without them are skipped when the table is clustered on the key.
    ``order`` is a list of (column, "asc" | "desc") and must be total.
    """
    sort = _sort(order)
    narrow = list(dict.fromkeys([key, *[c for c, _ in order]]))
    chosen = top_n(df.select(*narrow), sort, n)
    fetched = df.select(*dict.fromkeys([*narrow, *wide_cols]))
    if n <= LITERAL_KEYS and _as_literal(df.schema[key].dataType):
        keys = [r[0] for r in chosen.select(key).collect()]
        rows = fetched.where(_any_key(fetched, key, keys))
    else:
        rows = broadcast_join(fetched, chosen.select(key), key, "left_semi")
    # Other rows with the key of a chosen row are cut off here.
    return top_n(rows, sort, n)


def _as_literal(kind: T.DataType) -> bool:
    """Do values of this type come back unchanged from the driver, in an order that Python shares?

    Text compared by another rule than its bytes does not.
    """
    plain = isinstance(kind, (T.IntegralType, T.DateType, T.DecimalType, T.TimestampNTZType))
    return plain or kind.simpleString() == "string"


def _any_key(df: DataFrame, col: str, keys) -> Column:
    given, kind = [k for k in keys if k is not None], df.schema[col].dataType
    found = F.col(col).isin([typed(k, kind) for k in given]) if given else F.lit(False)
    if len(given) > 1:
        # A long list reaches the scan as its range only; say it plainly.
        found = found & at_least(df, col, typed(min(given), kind)) & at_most(df, col, typed(max(given), kind))
        if day := day_column(df, col):
            found = found & F.col(day).isin([day_of(typed(k, kind), kind) for k in given])
    return found | F.col(col).isNull() if len(given) < len(keys) else found


def in_list(df: DataFrame, col: str, values: DataFrame, ranges=(), limit: int | None = None, **skew) -> DataFrame:
    """Rows whose ``col`` is in the first column of ``values`` or in a range.

    ``ranges`` holds (lo, hi) pairs, both ends included. Each row comes once.
    A short list of the column's own type goes into the scan's filter; a longer
    one, of any size, or one of another type is a semi join that broadcasts the
    list only if it is small. Both compare in the type that holds list and column.
    """
    listed, kind = values.select(F.col(values.columns[0]).alias("__v")).where(F.col("__v").isNotNull()), df.schema[col].dataType
    if isinstance(kind, T.StringType) and isinstance(listed.schema["__v"].dataType, T.StringType):
        # Text is compared by the column's rule.
        listed = listed.select(F.col("__v").cast(kind).alias("__v"))
    listed = listed.distinct()
    in_range = any_of([at_least(df, col, typed(lo, kind)) & at_most(df, col, typed(hi, kind)) for lo, hi in ranges])
    if listed.schema["__v"].dataType == kind and _as_literal(kind):
        few = [row[0] for row in listed.limit(LITERAL_LIST + 1).collect()]
        if len(few) <= LITERAL_LIST:
            # One scan, whose filter can skip row groups.
            return df.where(in_range | _any_key(df, col, sorted(few)) if few else in_range)
    if not ranges:
        return broadcast_join(df, listed, [(col, "__v")], "left_semi", limit, **skew)
    outside = df.where(~F.coalesce(in_range, F.lit(False)))
    return df.where(in_range).unionByName(
        broadcast_join(outside, listed, [(col, "__v")], "left_semi", limit, **skew)
    )


def _sort(order) -> list[Column]:
    return [F.col(c).desc_nulls_last() if way == "desc" else F.col(c).asc_nulls_last() for c, way in order]


def keyset_page(df: DataFrame, order, after, n: int) -> DataFrame:
    """The ``n`` rows that follow the row with order values ``after``.

    ``order`` is a list of (column, "asc" | "desc"), total together; NULLs come
    last. ``after`` is None for the first page. Nothing before the page is
    sorted or counted.
    """
    if after is not None:
        after = [None if v is None else typed(v, df.schema[c].dataType) for (c, _), v in zip(order, after)]

        def beyond(c, way, v):
            if v is None:
                return F.lit(False)
            step = F.col(c) < v if way == "desc" else F.col(c) > v
            return step | F.col(c).isNull()

        tails = []
        for i, (c, way) in enumerate(order):
            same = [F.col(p).isNull() if v is None else F.col(p) == v for (p, _), v in zip(order[:i], after)]
            tails.append(all_of([*same, beyond(c, way, after[i])]))
        page = reduce(lambda a, b: a | b, tails)
        (first, way), v = order[0], after[0]
        if v is not None:
            # Implied by the rest, but in a form that a scan can use.
            day = day_column(df, first)
            seen = [(first, v)] + ([(day, day_of(v, df.schema[first].dataType))] if day else [])
            for c, bound in seen:
                start = F.col(c) <= bound if way == "desc" else F.col(c) >= bound
                page = (start | F.col(c).isNull()) & page
        df = df.where(page)
    return top_n(df, _sort(order), n)


def write_pages(df: DataFrame, order, n: int, path: str, hot_rows: int | None = None) -> None:
    """Store a directory of the pages of ``n`` rows: each page's number and last row's order values.

    ``order`` is as in ``keyset_page``. Rows are numbered in parts, so no task sees them all; the
    directory has a row per page.
    """
    names = [c for c, _ in order]
    numbered = row_numbers(df.select(*names), [], _sort(order), "__rn", hot_rows)
    last = numbered.where(F.col("__rn") % n == 0).select((F.col("__rn") / n).cast("long").alias("page"), *names)
    last.write.parquet(path)


def open_page(df: DataFrame, order, n: int, path: str, page: int) -> DataFrame:
    """Page ``page`` (from 1) of the table that the directory at ``path`` was written for.

    Two lines of the directory bound the page on both sides, so a scan of a table clustered on
    the first order column opens what holds the page and no page before or after it.
    """
    if page < 1:
        raise ValueError("pages are numbered from 1")
    known = df.sparkSession.read.parquet(path).where(F.col("page").isin(page - 1, page)).collect()
    ends = {row["page"]: [row[c] for c, _ in order] for row in known}
    if page > 1 and page - 1 not in ends:
        return df.limit(0)
    (first, way), end = order[0], ends.get(page)
    if end is not None and end[0] is not None:
        bound = typed(end[0], df.schema[first].dataType)
        # NULLs come last, so none is on a page that ends before them.
        df = df.where(at_least(df, first, bound) if way == "desc" else at_most(df, first, bound))
    return keyset_page(df, order, ends.get(page - 1), n)
