"""The given Parquet tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


# What tells one state of a file from another.
FILE = ("file_path", "file_size", "file_modification_time")


def table_files(spark: SparkSession, path: str) -> DataFrame:
    """The Parquet files of a table, by ``FILE``; their contents are not read."""
    there = spark.read.format("binaryFile").option("pathGlobFilter", "*.parquet").option("recursiveFileLookup", "true").load(path)
    return there.select(*[F.col(f"_metadata.{c}").alias(c) for c in FILE])
