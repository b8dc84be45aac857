"""Join sizes estimated from stored statistics, next to the true ones, per key."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from tunesmith.operators.statistics import common_values, equi_height
from tunesmith.sources.scratch import stored

# Most common values and histogram buckets of a side; both stay that few whatever the table's size.
COMMON, BUCKETS = 100, 200


def join_statistics(df: DataFrame, col: str, common: int = COMMON, buckets: int = BUCKETS) -> tuple[DataFrame, DataFrame]:
    """The most common values with their rows, and an equi-height histogram of all other values.

    Columns: (v, n), and (low, high, rows, values). NULLs are in neither, as they join nothing.
    """
    often = stored(common_values(df.select(F.col(col).alias("v")), "v", common).select("v", F.col("rows").alias("n")), "common")
    others = df.select(F.col(col).alias("v")).where(F.col("v").isNotNull()).join(F.broadcast(often.select("v")), "v", "left_anti")
    histogram = equi_height(others, "v", buckets).select("low", "high", "rows", F.col("distinct_values").alias("values"))
    return often, stored(histogram, "histogram")


def _spans(histogram: DataFrame) -> list[Column]:
    """The buckets as literals: low, high and the mean rows of a value."""
    rows = histogram.select("low", "high", (F.col("rows") / F.col("values")).alias("mean")).orderBy("low", "high").collect()
    return [F.struct(*[F.lit(x).alias(n) for n, x in r.asDict().items()]) for r in rows]


def _in_bucket(value: Column, spans: list[Column]) -> Column:
    """Mean rows of a value in the first bucket that holds it; a value between two buckets has none."""
    if not spans:
        return F.lit(0.0)
    held = F.filter(F.array(*spans), lambda b: (b["low"] <= value) & (value <= b["high"]))
    return F.coalesce(F.get(held, 0)["mean"], F.lit(0.0))


def _shared_values(kind: str) -> Column:
    """Rows that two overlapping buckets are expected to give: the fewer distinct values all have a partner."""

    def part(side: str) -> Column:
        low, high = F.col(f"{side}low").cast("double"), F.col(f"{side}high").cast("double")
        both = F.least(F.col("lhigh").cast("double"), F.col("rhigh").cast("double")) - F.greatest(F.col("llow").cast("double"), F.col("rlow").cast("double"))
        step = 1.0 if kind in ("tinyint", "smallint", "int", "bigint", "date") else 0.0
        return F.when(high - low + step > 0, F.least((both + step) / (high - low + step), F.lit(1.0))).otherwise(1.0)

    lv, rv = F.col("lvalues") * part("l"), F.col("rvalues") * part("r")
    rows = F.col("lrows") * part("l") * F.col("rrows") * part("r")
    return rows / F.greatest(lv, rv, F.lit(1.0))


def join_estimate(l: DataFrame, r: DataFrame, on, k: int = 20, common: int = COMMON, buckets: int = BUCKETS) -> DataFrame:
    """Estimated and true rows of an equi join on one numeric column: a line for each of the heaviest keys and one for the rest.

    Columns: ``key`` (NULL for the rest), ``estimated_rows``, ``actual_rows``, ``q_error`` (how
    many times one is the other, both at least 1). The heaviest ``k`` keys are those of most
    true pairs, ties by value.

    A key that is common on both sides is estimated exactly; one common on one side by the
    other's histogram bucket. For all other keys the buckets of both sides that overlap are
    paired, and in each overlap the values of the side with fewer of them all find partners.
    The true rows come from one grouping of both sides; the join is not run.
    """
    (lc, rc), = [(on, on)] if isinstance(on, str) else list(on)
    (lcommon, lhist), (rcommon, rhist) = join_statistics(l, lc, common, buckets), join_statistics(r, rc, common, buckets)
    kind = l.schema[lc].dataType.simpleString()
    # The exact side: keys of both, with their rows.
    sides = l.select(F.col(lc).alias("v"), F.lit(1).alias("a"), F.lit(0).alias("b")).unionAll(r.select(F.col(rc).alias("v"), F.lit(0).alias("a"), F.lit(1).alias("b")))
    counts = sides.where(F.col("v").isNotNull()).groupBy("v").agg(F.sum("a").alias("a"), F.sum("b").alias("b"))
    true = stored(counts.where((F.col("a") > 0) & (F.col("b") > 0)).select("v", (F.col("a").cast("double") * F.col("b")).alias("actual")), "pairs")
    heavy = stored(true.orderBy(F.desc("actual"), "v").limit(k), "heavy")
    # The estimate of a key, from statistics alone; all tables below are of bounded size but for the heavy keys.
    listed = lcommon.select("v", F.col("n").alias("ln")).join(rcommon.select("v", F.col("n").alias("rn")), "v", "full")
    lspans, rspans = _spans(lhist), _spans(rhist)

    def side(n: str, spans) -> Column:
        return F.coalesce(F.col(n).cast("double"), _in_bucket(F.col("v"), spans))

    per_key = heavy.join(F.broadcast(listed), "v", "left")
    per_key = per_key.select(F.col("v").alias("key"), (side("ln", lspans) * side("rn", rspans)).alias("estimated"), "actual")
    of_common = listed.select(F.sum(side("ln", lspans) * side("rn", rspans)).alias("e"))
    left = lhist.select(*[F.col(c).alias(f"l{c}") for c in lhist.columns])
    right = rhist.select(*[F.col(c).alias(f"r{c}") for c in rhist.columns])
    # At most BUCKETS x BUCKETS rows.
    met = left.join(F.broadcast(right), (F.col("llow") <= F.col("rhigh")) & (F.col("rlow") <= F.col("lhigh")))
    of_rest = met.select(F.sum(_shared_values(kind)).alias("e"))
    estimated = sum(row["e"] or 0.0 for row in (of_common.first(), of_rest.first()))
    lines = stored(per_key, "lines")
    spent = lines.agg(F.coalesce(F.sum("estimated"), F.lit(0.0)).alias("e"), F.coalesce(F.sum("actual"), F.lit(0.0)).alias("a"))
    rest = true.agg(F.coalesce(F.sum("actual"), F.lit(0.0)).alias("all")).crossJoin(spent)
    rest = rest.select(F.lit(None).cast(l.schema[lc].dataType).alias("key"), F.greatest(F.lit(estimated) - F.col("e"), F.lit(0.0)).alias("estimated"), (F.col("all") - F.col("a")).alias("actual"))
    out = lines.unionByName(rest)
    a, b = F.greatest("estimated", F.lit(1.0)), F.greatest("actual", F.lit(1.0))
    return out.select("key", F.col("estimated").alias("estimated_rows"), F.col("actual").alias("actual_rows"), (F.greatest(a, b) / F.least(a, b)).alias("q_error"))
