"""A layout on several keys at once.

A table sorted on (a, b) skips nothing for a range of b alone. Here each key is turned into a
rank by boundaries that cut its rows into equal parts, and the ranks' bits are interleaved
(the Z-order of Morton 1966). Files and row groups in the order of that number hold a narrow
range of every key, so a range on any of them, or on several, skips most of the table.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F, types as T

from tunesmith.functions.exact import DAY, DAY_OF, all_of, at_least, at_most, day_of, spread_hash, typed
from tunesmith.operators.statistics import equi_height
from tunesmith.sources.layout import files_for, written
from tunesmith.sources.scratch import stored

# Bits of a rank, and the accuracy of the boundaries (a rank is off by 1 / ACCURACY of the rows at most).
BITS, ACCURACY = 8, 10_000
# Cells of the curve per file at least, and in all at most (16 bytes each).
CELLS, MOST_CELLS = 1, 1 << 16


def boundaries(df: DataFrame, key: str, bits: int = BITS) -> list:
    """Values that cut the rows with a value into ``2 ** bits`` parts of about one size, ascending and distinct.

    Numbers and times by a mergeable sketch in one pass; other types by an exact histogram.
    There are at most ``2 ** bits - 1`` of them, whatever the table's size.
    """
    parts, kind = 1 << bits, df.schema[key].dataType
    if isinstance(kind, (T.NumericType, T.DateType, T.TimestampType)):
        marks = F.array(*[F.lit(i / parts) for i in range(1, parts)])
        found = df.select(F.percentile_approx(key, marks, ACCURACY).alias("m")).select(F.explode("m").alias("v"))
    else:
        found = equi_height(df, key, parts).select(F.col("low").alias("v"))
    found = found.distinct().orderBy("v")
    return [r[0] for r in found.select(F.col("v").cast("string") if isinstance(kind, T.TimestampNTZType) else "v").collect()]


def rank_of(df: DataFrame, key: str, cuts: list, name: str, bits: int = BITS) -> DataFrame:
    """``df`` with ``name``: how many of the ascending ``cuts`` are at or below the key; 0 for NULL.

    A binary search: a column per bit, from the highest, so each row is compared ``bits`` times.
    """
    kind = df.schema[key].dataType
    steps = F.array(*[typed(c, kind).cast(kind) for c in cuts]).cast(T.ArrayType(kind))
    df = df.withColumn(name, F.lit(0))
    for b in reversed(range(bits)):
        above = F.get(steps, F.col(name) + F.lit((1 << b) - 1))
        df = df.withColumn(name, F.col(name) + F.when(above <= F.col(key), F.lit(1 << b)).otherwise(F.lit(0)))
    return df


def interleaved(ranks: list[str], bits: int = BITS) -> Column:
    """The ranks' bits in turn, the highest of each first."""
    z = F.lit(0).cast("long")
    for b in range(bits):
        for k, name in enumerate(reversed(ranks)):
            bit = F.shiftright(F.col(name), b).bitwiseAND(F.lit(1)).cast("long")
            z = z.bitwiseOR(F.shiftleft(bit, b * len(ranks) + k))
    return z


def write_zordered(df: DataFrame, path: str, keys, files: int | None = None, bits: int = BITS) -> None:
    """Write Parquet files in the Z-order of two or more keys.

    Timestamps get a column ``<key>__day`` that scans can skip by, as in ``write_clustered``. A
    value that many rows have shares a rank; its rows are spread by the other keys, and rows
    of one cell that fill several files by a hash.
    """
    keys = list(keys)
    if len(keys) * bits > 63:
        raise ValueError(f"{len(keys)} keys of {bits} bits do not fit 63 bits")
    files = files or files_for(df)
    stamps = [k for k in keys if isinstance(df.schema[k].dataType, (T.TimestampType, T.TimestampNTZType))]
    added = [k + DAY for k in stamps]
    if clash := [c for c in added if c.lower() in {x.lower() for x in df.columns}]:
        raise ValueError(f"columns that the layout adds are taken: {clash}")
    out = df.select("*", *[day_of(F.col(k), df.schema[k].dataType).alias(k + DAY, metadata={DAY_OF: k}) for k in stamps])
    ranks = [f"__rank{i}" for i in range(len(keys))]
    for key, name in zip(keys, ranks):
        out = rank_of(out, key, boundaries(df, key, bits), name, bits)
    out = out.withColumn("__z", interleaved(ranks, bits)).withColumn("__h", spread_hash(df)).drop(*ranks)
    out = _with_files(out, files, len(keys) * bits).repartitionById(files, "__file").sortWithinPartitions("__z", *keys)
    out.drop("__z", "__h", "__file", "__cell").write.parquet(path)


def _with_files(df: DataFrame, files: int, width: int) -> DataFrame:
    """``df`` with ``__file``: files of about one size that begin and end with a cell.

    A cell is a box of the curve, ``CELLS`` or more per file and ``MOST_CELLS`` in all at most. Files that
    end in the middle of one would hold rows of two far-apart boxes, which a sampled range
    partitioning does not avoid. A cell of more rows than a file is spread over several.
    """
    kept = min(width, MOST_CELLS.bit_length() - 1, (CELLS * files - 1).bit_length())
    df = df.withColumn("__cell", F.shiftright("__z", width - kept))
    counts = stored(df.groupBy("__cell").agg(F.count(F.lit(1)).alias("__n")), "cells")
    total = counts.agg(F.coalesce(F.sum("__n"), F.lit(1))).first()[0]
    # One row per cell, so few whatever the table's size.
    before = F.sum("__n").over(Window.orderBy("__cell").rowsBetween(Window.unboundedPreceding, -1))
    counts = counts.withColumn("__from", F.coalesce(before, F.lit(0)))
    share = F.lit(files / total)
    several = F.col("__n") * share > 1
    first = F.when(several, F.round(F.col("__from") * share)).otherwise(F.floor((F.col("__from") + F.col("__n") / 2) * share))
    counts = counts.select(F.col("__cell").alias("__c"), first.cast("long").alias("__first"), F.when(several, F.round(F.col("__n") * share)).otherwise(1).cast("long").alias("__span"))
    placed = df.join(F.broadcast(counts), F.col("__cell") == F.col("__c"))
    file = F.col("__first") + F.pmod(F.col("__h"), F.greatest(F.col("__span"), F.lit(1)))
    return placed.withColumn("__file", F.least(file, F.lit(files - 1)).cast("int")).drop("__c", "__first", "__span")


def key_box(spark: SparkSession, path: str, box: dict, cols=None) -> DataFrame:
    """Rows with ``lo <= key <= hi`` for every key of ``box`` ({key: (lo, hi)}, either end may be None)."""
    df, conds = written(spark, path), []
    for key, (lo, hi) in box.items():
        kind = df.schema[key].dataType
        conds += [at_least(df, key, typed(lo, kind))] if lo is not None else []
        conds += [at_most(df, key, typed(hi, kind))] if hi is not None else []
        conds += [F.col(key).isNotNull()] if lo is None and hi is None else []
    cols = cols or [f.name for f in df.schema.fields if DAY_OF not in (f.metadata or {})]
    return df.where(all_of(conds)).select(*cols)
