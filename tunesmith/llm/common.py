"""Helpers that several operators of this folder share."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

# A key with this share of the rows or more is hot, so there are at most as many hot keys.
HOT_SHARE = 1_000

# What Python's bytes.split() cuts at, and the contracts' word pattern leaves out.
BLANKS = "\x20\x09\x0a\x0b\x0c\x0d"


def own_name(df: DataFrame, wish: str) -> str:
    """A column name that ``df`` does not have in any letter case."""
    taken = {c.lower() for c in df.columns}
    while wish.lower() in taken:
        wish += "_"
    return wish


def quoted(name: str) -> Column:
    return F.col("`" + name.replace("`", "``") + "`")


def lookup_join(left: DataFrame, right: DataFrame, key: str, size: str, how: str = "left") -> DataFrame:
    """Left or inner join with a table that has one row per key and, in ``size``, the key's rows in ``left``.

    A key may hold any part of ``left``. Keys with a thousandth of all rows or more
    number 1,000 at most, whatever the data, and are broadcast; the rows of all other
    keys are shuffled, in which no key has over a thousandth of them. Rows of hot or
    NULL keys are dealt out by a hash of the whole row instead of by their key.
    Columns of both sides must differ but for ``key``. ``size`` is left out.
    """
    total = right.agg(F.coalesce(F.sum(size), F.lit(0))).first()[0]
    limit = max(total // HOT_SHARE, 1)
    values = [c for c in right.columns if c not in (key, size)]
    hot = right.where((F.col(size) > limit) & F.col(key).isNotNull()).select(F.col(key).alias("__hot"), F.struct(*values).alias("__known"))
    cold = right.where((F.col(size) <= limit) & F.col(key).isNotNull()).select(F.col(key).alias("__cold"), F.struct(*values).alias("__found"), F.lit(0).alias("__spread"))
    marked = left.join(F.broadcast(hot), left[key] == hot["__hot"], "left")
    narrow = [F.col(c) for c in left.columns]
    # A row that needs no partner gets a second key part that no partner has.
    marked = marked.select(*narrow, "__known", "__hot", F.when(F.col("__hot").isNull() & F.col(key).isNotNull(), F.lit(0)).otherwise(F.xxhash64(*narrow) % 1_000_003 + 1_000_004).cast("int").alias("__deal"))
    if how == "inner":
        marked = marked.where(F.col(key).isNotNull())
    joined = marked.join(cold, (marked[key].eqNullSafe(cold["__cold"])) & (marked["__deal"] == cold["__spread"]), "left")
    if how == "inner":
        joined = joined.where(F.col("__hot").isNotNull() | F.col("__cold").isNotNull())
    return joined.select(*narrow, *[F.coalesce(F.col("__known")[c], F.col("__found")[c]).alias(c) for c in values])
