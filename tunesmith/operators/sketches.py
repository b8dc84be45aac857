"""Statistics that are kept as mergeable sketches, so that new data needs no rescan.

A stored line holds, for one part of a table and one column, counts and bounds, a sketch of
the distinct values (HLL) and, for numbers, one of the values' order (KLL). The
parts' lines together give statistics of the whole table; a part that arrives adds its lines.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

# Bits of the HLL sketch (relative error about 0.8 / 2 ** (bits / 2)) and size of the KLL sketch (rank error under 1 % for 200).
HLL_BITS, KLL_SIZE = 12, 400


def _hashable(col: str, kind: T.DataType) -> Column:
    """The distinct sketch takes whole numbers, text and bytes; other values go by their hash."""
    plain = isinstance(kind, (T.IntegerType, T.LongType, T.BinaryType)) or kind.simpleString() == "string"
    return F.col(col) if plain else F.when(F.col(col).isNotNull(), F.xxhash64(col))


def sketch_lines(df: DataFrame, part: Column, cols=None) -> DataFrame:
    """A line per part and column: part, column_name, rows, null_rows, least, greatest, distinct, order.

    One pass over ``df``, whatever the number of columns; every sketch has a bounded size.
    ``least`` and ``greatest`` are doubles and, like ``order``, NULL for columns that are no numbers.
    """
    cols = list(cols or df.columns)
    aggs = [F.count(F.lit(1)).alias("rows")]
    for i, c in enumerate(cols):
        kind = df.schema[c].dataType
        aggs += [F.count(c).alias(f"n{i}"), F.hll_sketch_agg(_hashable(c, kind), HLL_BITS).alias(f"d{i}")]
        if isinstance(kind, T.NumericType):
            x = F.col(c).cast("double")
            aggs += [F.min(x).alias(f"lo{i}"), F.max(x).alias(f"hi{i}"), F.kll_sketch_agg_double(x, F.lit(KLL_SIZE)).alias(f"k{i}")]
    wide = df.withColumn("__part", part.cast("string")).groupBy(F.col("__part").alias("part")).agg(*aggs)
    lines = []
    for i, c in enumerate(cols):
        ordered = isinstance(df.schema[c].dataType, T.NumericType)
        lines.append(
            F.struct(
                F.lit(c).alias("column_name"),
                F.col("rows"),
                (F.col("rows") - F.col(f"n{i}")).alias("null_rows"),
                (F.col(f"lo{i}") if ordered else F.lit(None).cast("double")).alias("least"),
                (F.col(f"hi{i}") if ordered else F.lit(None).cast("double")).alias("greatest"),
                F.col(f"d{i}").alias("distinct"),
                (F.col(f"k{i}") if ordered else F.lit(None).cast("binary")).alias("order"),
            )
        )
    return wide.select("part", F.inline(F.array(*lines)))


def write_sketches(df: DataFrame, part: Column, path: str, cols=None) -> None:
    """Store the sketch lines of a table, or add those of parts that have arrived.

    A part that comes again takes the place of its earlier lines when they are read.
    """
    lines = sketch_lines(df, part, cols).withColumn("written", F.current_timestamp())
    lines.write.mode("append").parquet(path)


def _latest(spark: SparkSession, path: str) -> DataFrame:
    lines = spark.read.parquet(path)
    newest = lines.groupBy(F.col("part").alias("__part"), F.col("column_name").alias("__c")).agg(F.max("written").alias("__w"))
    same = F.col("part").eqNullSafe(F.col("__part")) & (F.col("column_name") == F.col("__c")) & (F.col("written") == F.col("__w"))
    return lines.join(newest, same, "left_semi")


def sketched_stats(spark: SparkSession, path: str, parts: Column | None = None, ps=(0.25, 0.5, 0.75)) -> DataFrame:
    """Statistics of the whole table, or of the parts that a condition on ``part`` picks, from its lines.

    column_name, rows, null_rows, least, greatest, distinct_values (estimated), and ``quantiles``,
    the values at the ranks ``ps``. The table itself is not read.
    """
    lines = _latest(spark, path)
    lines = lines.where(parts) if parts is not None else lines
    merged = lines.groupBy("column_name").agg(
        F.sum("rows").alias("rows"),
        F.sum("null_rows").alias("null_rows"),
        F.min("least").alias("least"),
        F.max("greatest").alias("greatest"),
        F.hll_sketch_estimate(F.hll_union_agg("distinct")).alias("distinct_values"),
        F.kll_merge_agg_double("order").alias("__order"),
    )
    marks = F.array(*[F.when(F.col("greatest").isNotNull(), F.kll_sketch_get_quantile_double("__order", F.lit(float(p)))) for p in ps])
    return merged.withColumn("quantiles", F.when(F.col("greatest").isNotNull(), marks)).drop("__order")


def sketched_profile(spark: SparkSession, path: str) -> DataFrame:
    """The columns of ``design.column_selectivity`` from stored lines; the commonest value's rows are not known."""
    found = sketched_stats(spark, path, ps=(0.5,))
    share = F.col("distinct_values").cast("double") / F.when(F.col("rows") > 0, F.col("rows"))
    return found.select("column_name", "rows", "null_rows", "distinct_values", F.lit(None).cast("long").alias("max_rows"), share.alias("selectivity"))
