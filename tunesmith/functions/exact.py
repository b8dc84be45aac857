"""Column expressions whose result does not depend on row order."""

from __future__ import annotations

import datetime as dt
import decimal
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F, types as T


# Row groups are skipped on a date, but not on a timestamp without a zone or on
# one in the older 96-bit form. A clustered table has a date next to such a key,
# named so; which key it belongs to is in the column's metadata, not in its name.
DAY = "__day"
DAY_OF = "tunesmith.day_of"


def day_of(value: Column, kind: T.DataType) -> Column:
    """The date of a stamp; of one with a zone the UTC date, whatever the session's zone."""
    if isinstance(kind, T.TimestampType):
        return F.date_from_unix_date(F.floor(F.unix_micros(value.cast(kind)) / F.lit(86_400_000_000)).cast("int"))
    return value.cast("date")


def day_column(df: DataFrame, col: str) -> str | None:
    """The date copy of a key of a clustered table."""
    return next((f.name for f in df.schema.fields if (f.metadata or {}).get(DAY_OF) == col), None)


def _bound(df: DataFrame, col: str, value: Column, compare) -> Column:
    cond, day = compare(F.col(col), value), day_column(df, col)
    return cond & compare(F.col(day), day_of(value, df.schema[col].dataType)) if day else cond


def at_least(df: DataFrame, col: str, value: Column) -> Column:
    """``col >= value``, said of the date next to it too if there is one."""
    return _bound(df, col, value, lambda c, v: c >= v)


def at_most(df: DataFrame, col: str, value: Column) -> Column:
    return _bound(df, col, value, lambda c, v: c <= v)


_RANGE = {"tinyint": 8, "smallint": 16, "int": 32, "bigint": 64}


def unchanged(value, kind: T.DataType) -> bool:
    """Is the value one of the column's type, so that a cast of it loses nothing?"""
    if isinstance(kind, T.IntegralType):
        half = 1 << _RANGE[kind.simpleString()] - 1
        return isinstance(value, int) and not isinstance(value, bool) and -half <= value < half
    if isinstance(kind, T.DecimalType) and isinstance(value, (int, decimal.Decimal)) and not isinstance(value, bool):
        exact = decimal.Decimal(value)
        return exact.is_finite() and abs(exact) < 10 ** (kind.precision - kind.scale) and exact == round(exact, kind.scale)
    if isinstance(kind, T.DateType):
        return isinstance(value, dt.date) and not isinstance(value, dt.datetime)
    if isinstance(kind, (T.TimestampType, T.TimestampNTZType)):
        return isinstance(value, dt.datetime)
    return isinstance(kind, T.DoubleType) and isinstance(value, float)


def typed(value, kind: T.DataType) -> Column:
    """A literal of a column's own type, which a scan can use in its filter.

    A value of another type, or one that the column's type cannot hold, keeps its
    own; the comparison is then made in the type that holds both. A stamp without a
    zone goes in as text: as a Python value it would be read in one zone and turned
    back in another.
    """
    if isinstance(kind, T.TimestampNTZType) and isinstance(value, dt.datetime):
        return F.lit(value.isoformat(sep=" ")).cast(kind)
    if isinstance(value, int) and not -(1 << 63) <= value < 1 << 63:
        value = decimal.Decimal(value)
    return F.lit(value).cast(kind) if unchanged(value, kind) else F.lit(value)


def money(col) -> Column:
    """Two-decimal exact number, so that a sum is the same in any order."""
    return (F.col(col) if isinstance(col, str) else col).cast("decimal(18,2)")


def all_of(conds) -> Column:
    return reduce(lambda a, b: a & b, conds, F.lit(True))


def any_of(conds) -> Column:
    return reduce(lambda a, b: a | b, conds, F.lit(False))


def any_null(cols) -> Column:
    return any_of([F.col(c).isNull() for c in cols])


def null_safe(left_cols, right_cols) -> Column:
    return all_of([F.col(a).eqNullSafe(F.col(b)) for a, b in zip(left_cols, right_cols)])


def spread_hash(df: DataFrame, cols=None) -> Column:
    """A number that spreads the rows of ``df`` and survives a lost executor.

    It depends on values and on the number of the input partition only. A task
    that is run again gets the same rows in the same partition, perhaps in
    another order, and so gives every row the same number again; ``rand`` or a
    running row number would not. Copies of one row in different input
    partitions still get different numbers.
    """
    if cols is None:
        cols = [
            f.name for f in df.schema.fields if not isinstance(f.dataType, (T.MapType, T.VariantType))
        ]
    return F.xxhash64(F.spark_partition_id(), *[F.col(c) for c in cols])


def seconds_between(start: Column, end: Column) -> Column:
    """Elapsed seconds with microseconds, exact, whatever the session's zone."""
    return (end - start).cast("interval second").cast("decimal(20,6)")


def exact_place(value: Column, kind: T.DataType) -> Column:
    """A value's exact place on a line of numbers with room at both ends, whatever the session's zone.

    Whole numbers and stamps (microseconds) become ``decimal(20,0)``, dates their day's number;
    doubles and decimals stay as they are.
    """
    if isinstance(kind, T.IntegralType):
        return value.cast("decimal(20,0)")
    if isinstance(kind, T.DateType):
        return F.unix_date(value).cast("decimal(20,0)")
    if isinstance(kind, T.TimestampType):
        return F.unix_micros(value).cast("decimal(20,0)")
    if isinstance(kind, T.TimestampNTZType):
        return (seconds_between(F.lit("1970-01-01").cast(kind), value) * 1_000_000).cast("decimal(20,0)")
    if isinstance(kind, T.NumericType):
        return value
    raise TypeError(f"no place on a line for {kind.simpleString()}")


def line_of(kind: T.DataType) -> str:
    """Values of kinds with one line can be compared by their places."""
    return "number" if isinstance(kind, T.NumericType) else kind.simpleString()
