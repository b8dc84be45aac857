"""Column statistics, equi-height histograms, most common values."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tunesmith.operators.design import _union
from tunesmith.plans.ordered import running_sum
from tunesmith.sources.scratch import stored


def column_stats(df: DataFrame, cols=None, exact: bool = True) -> DataFrame:
    """One row per column: rows, NULLs, distinct values, least and greatest.

    Exact distinct counts take one grouping per column, which reads that column
    only. Otherwise all columns are done in one pass with sketches. Least and
    greatest are given as text.
    """
    cols = list(cols or df.columns)
    if exact:
        return _union([_stats_of(df, c) for c in cols])
    aggs = [F.count(F.lit(1)).alias("rows")]
    for i, c in enumerate(cols):
        aggs += [
            F.count(c).alias(f"n{i}"),
            F.approx_count_distinct(c).alias(f"d{i}"),
            F.min(c).cast("string").alias(f"lo{i}"),
            F.max(c).cast("string").alias(f"hi{i}"),
        ]
    lines = [
        F.struct(
            F.lit(c).alias("column_name"),
            F.col("rows"),
            (F.col("rows") - F.col(f"n{i}")).alias("null_rows"),
            F.col(f"d{i}").alias("distinct_values"),
            F.col(f"lo{i}").alias("min_value"),
            F.col(f"hi{i}").alias("max_value"),
        )
        for i, c in enumerate(cols)
    ]
    return df.agg(*aggs).select(F.inline(F.array(*lines)))


def _stats_of(df, c):
    values = df.groupBy(F.col(c).alias("v")).agg(F.count(F.lit(1)).alias("n"))
    return values.agg(
        F.lit(c).alias("column_name"),
        F.coalesce(F.sum("n"), F.lit(0)).alias("rows"),
        F.coalesce(F.sum(F.when(F.col("v").isNull(), F.col("n"))), F.lit(0)).alias("null_rows"),
        F.count("v").alias("distinct_values"),
        F.min("v").cast("string").alias("min_value"),
        F.max("v").cast("string").alias("max_value"),
    )


def equi_height(df: DataFrame, col: str, buckets: int, hot_rows: int | None = None) -> DataFrame:
    """Histogram whose buckets have the same number of rows, give or take one.

    The same buckets as ``ntile(buckets)`` over the whole table gives, but the
    rows are not put in one task: values are counted, put in order in parts,
    and a value's running count tells which buckets it reaches into. NULLs are
    left out. A value that fills several buckets is counted in each.
    """
    values = stored(
        df.where(F.col(col).isNotNull()).groupBy(F.col(col).alias("v")).agg(F.count(F.lit(1)).alias("n")), "values"
    )
    total = values.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    size, larger = divmod(total, buckets)
    # The first ``larger`` buckets have one row more.
    edge = larger * (size + 1)

    def bucket_of(rank):
        late = F.lit(larger) + F.floor((rank - edge) / max(size, 1))
        return F.when(rank < edge, F.floor(rank / (size + 1))).otherwise(late).cast("long")

    def start_of(bucket):
        return bucket * size + F.least(bucket, F.lit(larger))

    ranked = running_sum(values, [], ["v"], "n", "upto", hot_rows).withColumn("from", F.col("upto") - F.col("n"))
    spans = ranked.withColumn("b", F.explode(F.sequence(bucket_of(F.col("from")), bucket_of(F.col("upto") - 1))))
    inside = F.least("upto", start_of(F.col("b") + 1)) - F.greatest("from", start_of(F.col("b")))
    return spans.groupBy((F.col("b") + 1).alias("bucket")).agg(
        F.sum(inside).alias("rows"),
        F.min("v").alias("low"),
        F.max("v").alias("high"),
        F.count(F.lit(1)).alias("distinct_values"),
    )


def common_values(df: DataFrame, col: str, k: int) -> DataFrame:
    """The ``k`` most common values that are not NULL; ties by value."""
    counted = df.where(F.col(col).isNotNull()).groupBy(col).agg(F.count(F.lit(1)).alias("rows"))
    return counted.orderBy(F.col("rows").desc(), F.col(col)).limit(k)
