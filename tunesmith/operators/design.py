"""Choosing keys: selectivity of columns and prefixes, order against storage."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F

from tunesmith.plans.ordered import previous_value
from tunesmith.sources.scratch import stored


def _union(frames) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)


def column_selectivity(df: DataFrame, cols, exact: bool = True) -> DataFrame:
    """Rows, NULLs, distinct values and their share of rows, per column.

    Exact: one grouping per column, each of which reads that column alone and
    shuffles distinct values only; ``max_rows`` is the largest value's row
    count. Not exact: one pass with sketches, for tables where even the
    distinct values are too many.
    """
    if exact:
        return _union([_value_profile(df, c) for c in cols])
    aggs = [F.count(F.lit(1)).alias("rows")]
    for i, c in enumerate(cols):
        aggs += [F.approx_count_distinct(c).alias(f"d{i}"), F.count(c).alias(f"n{i}")]
    lines = F.array(
        *[
            F.struct(
                F.lit(c).alias("column_name"),
                F.col("rows"),
                (F.col("rows") - F.col(f"n{i}")).alias("null_rows"),
                F.col(f"d{i}").alias("distinct_values"),
            )
            for i, c in enumerate(cols)
        ]
    )
    out = df.agg(*aggs).select(F.inline(lines))
    return out.withColumn("selectivity", _share(F.col("distinct_values"), F.col("rows")))


def _share(part: Column, whole: Column) -> Column:
    return part.cast("double") / F.when(whole > 0, whole)


def _value_profile(df: DataFrame, c: str) -> DataFrame:
    values = df.groupBy(F.col(c).alias("v")).agg(F.count(F.lit(1)).alias("n"))
    known = F.col("v").isNotNull()
    return values.agg(
        F.lit(c).alias("column_name"),
        F.coalesce(F.sum("n"), F.lit(0)).alias("rows"),
        F.coalesce(F.sum(F.when(~known, F.col("n"))), F.lit(0)).alias("null_rows"),
        F.count("v").alias("distinct_values"),
        F.max(F.when(known, F.col("n"))).alias("max_rows"),
    ).withColumn("selectivity", _share(F.col("distinct_values"), F.col("rows")))


def prefix_selectivity(df: DataFrame, key_cols) -> DataFrame:
    """Distinct combinations and rows per combination of each key prefix.

    The table is grouped on the whole key once; shorter prefixes are rolled up
    from its distinct combinations. NULL counts as a value.
    """
    keys = list(key_cols)
    full = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
    level = F.lit(len(keys)) - F.bit_count(F.grouping_id().cast("long"))
    groups = full.rollup(*keys).agg(F.sum("n").alias("n"), level.alias("prefix_length")).where("prefix_length > 0")
    named = F.element_at(F.array(*[F.lit(", ".join(keys[: i + 1])) for i in range(len(keys))]), F.col("prefix_length"))
    return groups.groupBy("prefix_length").agg(
        F.count(F.lit(1)).alias("distinct_keys"),
        F.max("n").alias("max_rows"),
        (F.sum("n").cast("double") / F.count(F.lit(1))).alias("avg_rows"),
    ).withColumn("prefix", named)


def order_switches(df: DataFrame, key, block: str, hot_rows: int | None = None) -> DataFrame:
    """Walk the rows in key order and count changes of ``block``.

    Rows of one key are taken block by block. The table is first grouped on
    (key, block); then one row per key is left with its first and last block,
    and only those rows are put in order, in parts that are stitched together.
    """
    keys = [key] if isinstance(key, str) else list(key)
    known = df.where(~reduce(lambda a, b: a | b, [F.col(k).isNull() for k in keys]))
    # One scan for both uses.
    pairs = stored(known.groupBy(*keys, F.col(block).alias("__b")).agg(F.count(F.lit(1)).alias("__n")), "pairs")
    per_key = pairs.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("__blocks"),
        F.min("__b").alias("__first"),
        F.max("__b").alias("__last"),
        F.sum("__n").alias("__n"),
    )
    walk = previous_value(stored(per_key, "keys"), [], keys, "__last", "__before", hot_rows)
    moved = F.when(F.col("__before") != F.col("__first"), 1).otherwise(0)
    total = walk.agg(
        F.coalesce(F.sum("__n"), F.lit(0)).alias("rows"),
        F.count(F.lit(1)).alias("distinct_keys"),
        F.coalesce(F.sum(F.col("__blocks") - 1 + moved), F.lit(0)).alias("switches"),
    )
    blocks = pairs.select(F.count_distinct("__b")).scalar()
    return total.withColumn("blocks", blocks)


def layout_candidates(
    df: DataFrame,
    predicates: DataFrame,
    max_partitions: int = 10_000,
    min_rows_per_partition: int = 1,
    max_key_share: float = 0.05,
    profile: DataFrame | None = None,
) -> DataFrame:
    """Rank columns as partition, sort or bucket key.

    ``predicates`` (column_name, kind, uses) says how often a column is used
    with kind ``eq``, ``range`` or ``join``. The rule:

    partition  few enough values, each with enough rows; eq + range uses
    sort       as many uses as eq + range, weighted by how many values there
               are to tell apart (1 - 1/values)
    bucket     join uses, and no value has more than ``max_key_share`` of rows

    Columns without a score in a role are left out; ``rank`` is within the role.
    ``profile`` has the columns of ``column_selectivity``; left out, it is counted exactly.
    Of a stored profile without ``max_rows``, the mean rows of a value stand in for them.
    """
    # Names that are no column of the table stay where they are.
    own = df.sparkSession.createDataFrame([(c,) for c in df.columns], "column_name string")
    used = {r[0] for r in own.join(predicates.select("column_name"), "column_name", "left_semi").collect()}
    named = [c for c in df.columns if c in used]
    if profile is None:
        profile = column_selectivity(df, named or df.columns[:1])
    else:
        profile = profile.where(F.col("column_name").isin(df.columns))
    uses = (
        predicates.groupBy("column_name")
        .agg(
            *[
                F.coalesce(F.sum(F.when(F.col("kind") == k, F.col("uses"))), F.lit(0)).alias(f"{k}_uses")
                for k in ("eq", "range", "join")
            ]
        )
        .withColumnRenamed("column_name", "__c")
    )
    # One row per column of the table on both sides.
    seen = profile.join(uses, F.col("column_name") == F.col("__c")).drop("__c")
    filters = F.col("eq_uses") + F.col("range_uses")
    values = F.col("distinct_values")
    known = F.col("rows") - F.col("null_rows")
    partition = (
        F.when(values > max_partitions, 0.0)
        .when(known < values * min_rows_per_partition, 0.0)
        .otherwise(filters.cast("double"))
    )
    tell_apart = F.when(values > 0, 1.0 - 1.0 / F.greatest(values, F.lit(1)).cast("double")).otherwise(0.0)
    heaviest = F.coalesce(F.col("max_rows"), F.ceil(known / F.when(values > 0, values)))
    bucket = F.when(heaviest > F.col("rows") * F.lit(max_key_share), 0.0).otherwise(
        F.col("join_uses").cast("double")
    )
    scored = F.array(
        F.struct(F.lit("partition").alias("role"), partition.alias("score")),
        F.struct(F.lit("sort").alias("role"), (filters * tell_apart).alias("score")),
        F.struct(F.lit("bucket").alias("role"), F.coalesce(bucket, F.lit(0.0)).alias("score")),
    )
    found = seen.select("column_name", "rows", "distinct_values", "max_rows", F.inline(scored)).where("score > 0")
    # At most one row per column and role.
    best = Window.partitionBy("role").orderBy(F.col("score").desc(), "column_name")
    return found.withColumn("rank", F.row_number().over(best))
