"""Layouts that let a scan skip data, and measures of what a scan touches.

Parquet has no index. Sorted files give each row group a narrow key range, and
partition folders are skipped by name; those two take the index's place.
"""

from __future__ import annotations

import json
import math

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from tunesmith.functions.exact import DAY, DAY_OF, all_of, at_least, at_most, day_of, spread_hash, typed
from tunesmith.operators.design import order_switches
from tunesmith.plans.sizing import estimated_bytes

FILE_BYTES = 512 << 20
# Subfolder that holds a partitioned table's schema.
SCHEMA = "_schema"


def _as_list(cols) -> list[str]:
    return [cols] if isinstance(cols, str) else list(cols)


def files_for(df: DataFrame, least: int = 1) -> int:
    """Files of about ``FILE_BYTES`` each, by Catalyst's size estimate."""
    return max(least, math.ceil(estimated_bytes(df) / FILE_BYTES))


def write_clustered(df: DataFrame, path: str, keys, files: int | None = None) -> None:
    """Write Parquet files that follow each other in key order.

    Rows of one hot key value are spread over as many files as they fill. A
    timestamp key gets a column ``<key>__day`` that scans can skip by; a table
    that has a column of that name already is refused.
    """
    files = files or files_for(df)
    keys = _as_list(keys)
    stamps = [k for k in keys if isinstance(df.schema[k].dataType, (T.TimestampType, T.TimestampNTZType))]
    clash = [k + DAY for k in stamps if (k + DAY).lower() in (c.lower() for c in df.columns)]
    if clash:
        raise ValueError(f"columns that the layout adds are taken: {clash}")
    out = df.select("*", *[day_of(F.col(k), df.schema[k].dataType).alias(k + DAY, metadata={DAY_OF: k}) for k in stamps])
    out = out.withColumn("__h", spread_hash(df))
    out = out.repartitionByRange(files, *keys, "__h").sortWithinPartitions(*keys)
    out.drop("__h").write.parquet(path)


def key_range(spark: SparkSession, path: str, key: str, lo=None, hi=None, cols=None) -> DataFrame:
    """Rows with ``lo <= key <= hi`` (either may be None) of a clustered table."""
    df = spark.read.parquet(path)
    kind, conds = df.schema[key].dataType, []
    if lo is not None:
        conds.append(at_least(df, key, typed(lo, kind)))
    if hi is not None:
        conds.append(at_most(df, key, typed(hi, kind)))
    cols = cols or [f.name for f in df.schema.fields if DAY_OF not in (f.metadata or {})]
    return df.where(all_of(conds)).select(*cols)


def write_partitioned(df: DataFrame, path: str, cols) -> None:
    """Write one folder per value of ``cols``.

    The rebalance hint sends a value's rows to few tasks, so there are few
    files, and lets adaptive execution split a value that is too large. The
    table's schema is kept in a subfolder that readers skip, as folder names
    alone do not say that '007' is text. Spark reads an empty text as NULL.
    """
    cols = _as_list(cols)
    df.hint("rebalance", *[F.col(c) for c in cols]).write.partitionBy(*cols).parquet(path)
    kept = df.sparkSession.createDataFrame([(df.schema.json(),)], "value string")
    kept.coalesce(1).write.text(f"{path}/{SCHEMA}")


def written(spark: SparkSession, path: str) -> DataFrame:
    """A table of ``write_partitioned`` with its own types, or any other Parquet table."""
    try:
        kept = spark.read.text(f"{path}/{SCHEMA}", wholetext=True).first()
    except AnalysisException as missing:
        if missing.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.read.parquet(path)
    return spark.read.schema(T.StructType.fromJson(json.loads(kept[0]))).parquet(path)


def read_partitioned(spark: SparkSession, path: str, cond: Column, cols=None) -> DataFrame:
    """Read with a condition on partition columns; other folders are not opened."""
    df = written(spark, path).where(cond)
    return df.select(*cols) if cols else df


def scan_footprint(spark: SparkSession, path: str, cond: Column) -> DataFrame:
    """Folders, files, blocks, bytes and rows in total and with matches of ``cond``.

    A block is a piece of a file that one task reads. Counts where matches lie,
    not what Spark opens; the two agree when skipping works.
    """
    meta = F.col("_metadata")
    blocks = (
        written(spark, path)
        .select(
            meta["file_path"].alias("file"),
            meta["file_size"].alias("bytes"),
            meta["file_block_start"].alias("block"),
            F.coalesce(cond, F.lit(False)).alias("hit"),
        )
        .groupBy("file", "bytes", "block")
        .agg(F.count(F.lit(1)).alias("n"), F.count_if("hit").alias("hits"))
    )
    files = blocks.groupBy("file", "bytes").agg(
        F.count(F.lit(1)).alias("blocks"),
        F.count_if(F.col("hits") > 0).alias("blocks_hit"),
        F.sum("n").alias("n"),
        F.sum("hits").alias("hits"),
    )
    folders = files.groupBy(F.regexp_extract("file", r"^(.*)/[^/]*$", 1).alias("folder")).agg(
        F.count(F.lit(1)).alias("files"),
        F.count_if(F.col("hits") > 0).alias("files_hit"),
        F.sum("blocks").alias("blocks"),
        F.sum("blocks_hit").alias("blocks_hit"),
        F.sum("bytes").alias("bytes"),
        F.sum(F.when(F.col("hits") > 0, F.col("bytes")).otherwise(0)).alias("bytes_hit"),
        F.sum("n").alias("n"),
        F.sum("hits").alias("hits"),
    )
    return folders.agg(
        F.count(F.lit(1)).alias("folders_total"),
        F.count_if(F.col("hits") > 0).alias("folders_hit"),
        F.sum("files").alias("files_total"),
        F.sum("files_hit").alias("files_hit"),
        F.sum("blocks").alias("blocks_total"),
        F.sum("blocks_hit").alias("blocks_hit"),
        F.sum("bytes").alias("bytes_total"),
        F.sum("bytes_hit").alias("bytes_hit"),
        F.sum("n").alias("rows_total"),
        F.sum("hits").alias("rows_hit"),
    )


def clustering_factor(spark: SparkSession, path: str, key, hot_rows: int | None = None) -> DataFrame:
    """How often a walk in key order changes the file it reads from."""
    keys = _as_list(key)
    rows = spark.read.parquet(path).select(*keys, F.col("_metadata.file_path").alias("__file"))
    return order_switches(rows, keys, "__file", hot_rows)
