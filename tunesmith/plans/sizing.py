"""Is a table small enough to be sent to every executor?

The limit is the session's ``spark.sql.autoBroadcastJoinThreshold``. Catalyst's
estimate alone proves nothing (it ignores, for one, rows added by ``explode``),
so a table is broadcast only after its bytes have been added up. The estimate
serves to skip that count for tables that are far too large.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

# A table estimated above this many times the limit is not counted at all.
WORTH_COUNTING = 64

OWN_LIMIT = 10 << 20

_UNIT = {"": 1, "k": 1 << 10, "m": 1 << 20, "g": 1 << 30, "t": 1 << 40}


def _bytes_of(text: str) -> int:
    number, unit = re.fullmatch(r"(-?\d+)\s*([kmgt]?)i?b?", text.strip().lower()).groups()
    return int(number) * _UNIT[unit]


def broadcast_limit(spark: SparkSession) -> int:
    """Bytes a broadcast table may have; negative when broadcasts are off."""
    return _bytes_of(spark.conf.get("spark.sql.autoBroadcastJoinThreshold", "10485760b"))


def scan_tasks(df: DataFrame) -> int:
    """About how many tasks a scan of this size has."""
    split = _bytes_of(df.sparkSession.conf.get("spark.sql.files.maxPartitionBytes", "134217728b"))
    return max(1, -(-estimated_bytes(df) // split))


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions", "200"))


def estimated_bytes(df: DataFrame) -> int:
    """Catalyst's size estimate; no job is run."""
    return int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))


def one_task_reads(df: DataFrame) -> bool:
    """Is the whole table, by Catalyst's estimate, what one scan task reads?"""
    return scan_tasks(df) == 1


def _value_bytes(field: T.StructField) -> Column | None:
    """Bytes of a column's values; None if all take the same."""
    kind, col = field.dataType, F.col(f"`{field.name}`")
    if isinstance(kind, (T.StringType, T.BinaryType)):
        return F.coalesce(F.octet_length(col), F.lit(0))
    if isinstance(kind, (T.ArrayType, T.MapType, T.StructType)):
        return F.coalesce(F.octet_length(F.to_json(F.struct(col))), F.lit(0))
    return None


def _width(field: T.StructField) -> Column:
    size = _value_bytes(field)
    return F.lit(16) if size is None else size + F.lit(16)


def measured_bytes(df: DataFrame) -> int:
    """Bytes of all rows, counted in one job."""
    width = sum((_width(f) for f in df.schema.fields), F.lit(16))
    return int(df.agg(F.coalesce(F.sum(width.cast("long")), F.lit(0))).first()[0])


def rows_and_bytes(df: DataFrame) -> tuple[int, int]:
    """Rows, and bytes of their values as a row in memory has them, counted in one job.

    Only columns whose values differ in width are read; others take 8 bytes.
    """
    sizes = [_value_bytes(f) for f in df.schema.fields]
    width = sum((F.lit(8) if x is None else x + F.lit(8) for x in sizes), F.lit(0))
    rows, size = df.agg(F.count(F.lit(1)), F.coalesce(F.sum(width.cast("long")), F.lit(0))).first()
    return rows, int(size)


def fits_broadcast(df: DataFrame, limit: int | None = None) -> bool:
    limit = broadcast_limit(df.sparkSession) if limit is None else limit
    if limit < 0 or estimated_bytes(df) > WORTH_COUNTING * limit:
        return False
    return measured_bytes(df) <= limit


def if_small(df: DataFrame) -> DataFrame:
    """Hint that a table of few rows be broadcast if its bytes are few too.

    For tables that an operator makes for itself; they go by ``OWN_LIMIT`` where
    the session's limit is lower.
    """
    limit = max(OWN_LIMIT, broadcast_limit(df.sparkSession))
    return F.broadcast(df) if fits_broadcast(df, limit) else df
