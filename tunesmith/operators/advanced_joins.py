"""Band, as-of, salted and star joins, and the running total."""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass

from pyspark.sql import DataFrame, functions as F, types as T

from tunesmith.functions.exact import any_null, exact_place, line_of, spread_hash
from tunesmith.operators.joins import broadcast_join
from tunesmith.plans.ordered import last_value, running_sum
from tunesmith.plans.sizing import broadcast_limit, estimated_bytes, fits_broadcast, measured_bytes
from tunesmith.plans.skew import ONE_SIDED, equi_join, key_pairs, skew_join
from tunesmith.sources.scratch import stored


def band_join(l: DataFrame, r: DataFrame, lcol: str, rcol: str, width, keys=(), **skew) -> DataFrame:
    """Pairs with ``lcol BETWEEN rcol - width AND rcol + width`` and equal ``keys``.

    Both columns are numbers, or both dates or stamps, of which ``width`` is a ``timedelta``.
    They are compared on a line with room at both ends, so no value of their type overflows.
    The line is cut into bins of ``width``. A right row goes to the (at most four) bins its
    band touches, so partners share a bin and the join is an equi join. Rows of one bin lie
    within ``width`` of each other: the pairs looked at are within a small factor of the
    pairs returned. Hot bins are cut up like any hot key.
    """
    kinds = l.schema[lcol].dataType, r.schema[rcol].dataType
    if line_of(kinds[0]) != line_of(kinds[1]):
        raise TypeError(f"a band over {kinds[0].simpleString()} and {kinds[1].simpleString()}")
    if isinstance(width, dt.timedelta):
        days, rest = divmod(width, dt.timedelta(days=1))
        if isinstance(kinds[0], T.DateType) and rest:
            raise ValueError("a band of dates is of whole days")
        width = days if isinstance(kinds[0], T.DateType) else width // dt.timedelta(microseconds=1)
    elif not isinstance(kinds[0], T.NumericType):
        raise TypeError("the width of a band of dates or stamps is a timedelta")
    if width <= 0:
        raise ValueError("width must be positive")
    pairs = key_pairs(keys)
    # Dividing and rounding down keep order, also in floating point, so no
    # partner falls outside the bins.
    w = F.lit(float(width))

    def bin_of(x):
        return F.floor(x.cast("double") / w)

    at = exact_place(F.col(rcol), kinds[1])
    left = l.where(F.col(lcol).isNotNull()).withColumn("__place", exact_place(F.col(lcol), kinds[0]))
    left = left.withColumn("__bin", bin_of(F.col("__place")))
    right = r.where(F.col(rcol).isNotNull()).withColumn("__low", at - F.lit(width)).withColumn("__high", at + F.lit(width))
    right = right.withColumn("__bin", F.explode(F.sequence(bin_of(F.col("__low")), bin_of(F.col("__high")))))
    joined = skew_join(left, right, pairs + [("__bin", "__bin")], "inner", **skew)
    hit = joined.where(F.col("__place").between(F.col("__low"), F.col("__high")))
    same = [a for a, b in pairs if a == b]
    return hit.select(l.columns + [c for c in r.columns if c not in same])


def asof_join(l: DataFrame, r: DataFrame, by, on, tie: str | None = None, hot_rows: int | None = None) -> DataFrame:
    """Every left row with the latest right row at or before it.

    ``by`` is a list of keys, ``on`` the time, each one name or a (left, right)
    pair. Of right rows at one time the one with the highest ``tie`` wins, and of
    those, or without a tie, the one with the highest hash of its values, so that
    the result never depends on the rows' order. Left rows without an earlier
    right row get NULLs.

    Both sides are put in one ordered stream and the last right row is carried
    forward, so the work does not depend on how many right rows precede a left
    row. A hot key is cut along time.
    """
    by = key_pairs(by)
    ((lt, rt),) = key_pairs([on])
    lk, rk = [a for a, _ in by], [b for _, b in by]
    values = [c for c in r.columns if not any(c == b and a == b for a, b in by) and not (c == rt and lt == rt)]
    clash = set(values) & set(l.columns)
    if clash:
        raise ValueError(f"columns on both sides that are not keys: {sorted(clash)}")
    left_row = T.StructType(l.schema.fields)
    right_row = F.struct(*[F.col(c) for c in values]) if values else F.struct(F.lit(1).alias("__one"))
    tie_type = r.schema[tie].dataType if tie else T.LongType()

    def names(cols):
        return [F.col(c).alias(f"__k{i}") for i, c in enumerate(cols)]

    from_left = l.select(
        *names(lk),
        F.col(lt).alias("__t"),
        F.lit(1).alias("__side"),
        F.lit(None).cast(tie_type).alias("__tie"),
        F.lit(None).cast("long").alias("__v"),
        spread_hash(l).alias("__h"),
        F.struct(*l.columns).cast(left_row).alias("__l"),
        F.lit(None).cast(r.select(right_row.alias("x")).schema["x"].dataType).alias("__r"),
    )
    from_right = r.where(~any_null([*rk, rt])).select(
        *names(rk),
        F.col(rt).alias("__t"),
        F.lit(0).alias("__side"),
        (F.col(tie) if tie else F.lit(None).cast(tie_type)).alias("__tie"),
        F.xxhash64(*values).alias("__v") if values else F.lit(0).cast("long").alias("__v"),
        spread_hash(r).alias("__h"),
        F.lit(None).cast(left_row).alias("__l"),
        right_row.alias("__r"),
    )
    keys = [f"__k{i}" for i in range(len(by))]
    # Right rows come before left rows of the same time.
    stream = last_value(
        from_left.unionByName(from_right), keys, ["__t", "__side", "__tie", "__v", "__h"], "__r", "__last", hot_rows
    )
    out = stream.where(F.col("__side") == 1)
    return out.select(
        *[F.col(f"__l.{c}").alias(c) for c in l.columns], *[F.col(f"__last.{c}").alias(c) for c in values]
    )


def salted_join(l: DataFrame, r: DataFrame, on, how: str = "inner", hot_rows: int | None = None, spread_on=None, limit: int | None = None):
    """Equi join in which every key with more than ``hot_rows`` rows is salted.

    A side under the broadcast limit (``limit`` bytes, if given) is broadcast, which
    no hot key can hurt. Else hot keys are copied, each as often as its row count
    asks for. All join types, including full.
    """
    return broadcast_join(l, r, on, how, limit, hot_rows=hot_rows, spread_on=spread_on)


def star_join(fact: DataFrame, dims, limit: int | None = None, **skew) -> DataFrame:
    """Join a fact table with several (dimension, keys) pairs.

    A dimension reached through another one is folded into that one first, so
    its filter thins the dimension and not the fact. Small dimensions are
    broadcast: the fact table is read once and not moved, and a partition
    column among the keys is pruned at run time. A dimension over the limit is
    joined by shuffle, after the small ones have thinned the fact.
    """
    limit = broadcast_limit(fact.sparkSession) if limit is None else limit

    def joined(df, dim):
        if dim.small:
            return equi_join(df, F.broadcast(dim.rows), dim.on)
        return skew_join(df, dim.rows, dim.on, "inner", **skew)

    near, far = [], []
    for rows, on in dims:
        dim = _Dimension(rows, key_pairs(on), fits_broadcast(rows, limit))
        (near if all(k in fact.columns for k, _ in dim.on) else far).append(dim)
    # From the outside in: a dimension is folded when none hangs on it any more.
    while far:
        leaf = next((d for d in far if not any(e is not d and e.hangs_on(d) for e in far)), None)
        home = leaf and next((d for d in near + far if d is not leaf and leaf.hangs_on(d)), None)
        if not home:
            raise ValueError(f"no table with these join keys: {[d.on for d in far]}")
        home.rows = joined(home.rows, leaf)
        # The size of two joined tables is not known from their own.
        home.small = home.small and leaf.small and measured_bytes(home.rows) <= limit
        far.remove(leaf)
    for dim in sorted(near, key=lambda d: (not d.small, estimated_bytes(d.rows))):
        fact = joined(fact, dim)
    return fact


@dataclass(eq=False)
class _Dimension:
    rows: DataFrame
    on: list
    small: bool

    def hangs_on(self, other) -> bool:
        return all(k in other.rows.columns for k, _ in self.on)


def running_total(df: DataFrame, by, order, value: str, name: str = "running", hot_rows: int | None = None):
    """Sum of ``value`` over the group's rows up to this one.

    ``order`` must be total in each group. Takes the place of a self join on
    ``a.order >= b.order``, whose cost grows with the square of the group.
    """
    return running_sum(df, by, order, value, name, hot_rows)


# Bits of the map that thins a fact: 128 KB whatever the tables' sizes.
REDUCER_BITS = 1 << 20


def reduced_join(fact: DataFrame, dim: DataFrame, on, how: str = "inner", limit: int | None = None, bits: int = REDUCER_BITS, **skew) -> DataFrame:
    """Inner or left semi join that drops fact rows without a partner before they are shuffled.

    A dimension under the broadcast limit is broadcast. Over it, the hashes of its keys are set
    in a bit map of ``bits`` bits, and fact rows whose bit is not set stay where they are. Rows
    that pass by chance (a part of about keys / ``bits``) are dropped by the join itself. With many
    more keys than bits the map lets all through and only costs its making.
    """
    if how not in ("inner", *ONE_SIDED[:1]):
        raise ValueError(f"{how} keeps fact rows without a partner")
    pairs = key_pairs(on)
    if fits_broadcast(dim, limit):
        return equi_join(fact, F.broadcast(dim), pairs, how)
    return skew_join(_with_partner(fact, dim, pairs, bits), dim, pairs, how, **skew)


def _with_partner(fact: DataFrame, dim: DataFrame, pairs, bits: int) -> DataFrame:
    """The fact rows whose key hash is among the dimension's."""
    fk, dk = [a for a, _ in pairs], [b for _, b in pairs]
    # Hashes agree only for keys of one type on both sides.
    kinds = [_common(fact.schema[a].dataType, dim.schema[b].dataType) for a, b in pairs]

    def place(keys):
        return F.pmod(F.xxhash64(*[F.col(k).cast(t) for k, t in zip(keys, kinds)]), F.lit(bits))

    marks = dim.where(~any_null(dk)).select(place(dk).alias("at"))
    # Words are put together where the rows are; there are bits / 64 of them at most.
    words = marks.groupBy(F.shiftright("at", 6).cast("int").alias("i")).agg(F.bit_or(F.expr("shiftleft(1L, CAST(at % 64 AS INT))")).alias("w"))
    every = fact.sparkSession.range(-(-bits // 64)).select(F.col("id").cast("int").alias("i"))
    whole = every.join(words, "i", "left").agg(F.sort_array(F.collect_list(F.struct("i", F.coalesce("w", F.lit(0).cast("long")).alias("w")))).alias("m"))
    held = stored(whole.select(F.transform("m", lambda x: x["w"]).alias("m")), "key-bits").select("m").scalar()
    marked = fact.where(~any_null(fk)).withColumn("__at", place(fk))
    return marked.where(F.getbit(F.get(held, F.shiftright("__at", 6).cast("int")), (F.col("__at") % 64).cast("int")) == 1).drop("__at")


def _common(a: T.DataType, b: T.DataType) -> T.DataType:
    """The type that two keys are compared in."""
    if a == b:
        return a
    if isinstance(a, T.IntegralType) and isinstance(b, T.IntegralType):
        return T.LongType()
    raise TypeError(f"keys of {a.simpleString()} and {b.simpleString()}")
