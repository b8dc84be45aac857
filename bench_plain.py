"""Times rewrites and layouts against the plain form they replace.

python bench_plain.py [folder] [runs]; prints one line per pair: best of the runs.
The layouts are written before the clock starts.
"""

from __future__ import annotations

import datetime as dt
import sys
import time

from pyspark.sql import SparkSession, functions as F

from tunesmith import queries as q
from tunesmith.functions.exact import money
from tunesmith.plans.inspect import rows_scanned
from tunesmith.sources import layout
from tunesmith.sources.scratch import new_path
from tunesmith.sources.tables import table


def pairs(spark, d):
    items, orders, part = (table(spark, d, t) for t in ("lineitem", "orders", "part"))
    events, customer = table(spark, d, "events"), table(spark, d, "customer")

    def plain_or():
        hit = (F.col("l_partkey") == F.col("p_partkey")) | (F.col("l_suppkey") == F.col("p_partkey"))
        return items.join(part, hit).groupBy("p_brand").agg(F.count("*"), q.total("l_quantity"))

    def plain_aggregate():
        joined = items.join(part, F.col("l_partkey") == F.col("p_partkey")).groupBy("p_brand")
        price, quantity = money("l_extendedprice"), money("l_quantity")
        return joined.agg(F.count(price), F.sum(price), F.avg(quantity), F.min(price), F.max(price))

    def sides(kind, name):
        return events.where(F.col("event_type") == kind).select("user_id", F.col("ts").alias(name), F.col("event_id").alias(f"{name}_id"))

    def plain_band():
        near = "e BETWEEN p - INTERVAL 7200 SECOND AND p + INTERVAL 7200 SECOND"
        return sides("error", "e").join(sides("purchase", "p"), "user_id").where(near)

    def plain_asof():
        bought, seen = sides("purchase", "p"), sides("view", "v").withColumnRenamed("user_id", "u")
        joined = bought.join(seen, (F.col("user_id") == F.col("u")) & (F.col("v") <= F.col("p")), "left")
        return joined.groupBy("user_id", "p", "p_id").agg(F.max_by("v_id", "v"))

    def plain_running():
        a = orders.select("o_orderpriority", "o_custkey", "o_orderdate", "o_orderkey")
        b = orders.select(F.col("o_custkey").alias("c"), F.col("o_orderdate").alias("t"), F.col("o_orderkey").alias("k"), money("o_totalprice").alias("x"))
        upto = (F.col("t") < F.col("o_orderdate")) | ((F.col("t") == F.col("o_orderdate")) & (F.col("k") <= F.col("o_orderkey")))
        return a.join(b, (F.col("o_custkey") == F.col("c")) & upto).groupBy("o_custkey", "o_orderkey").agg(F.sum("x"))

    def plain_fk():
        joined = items.join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
        return joined.groupBy("l_returnflag").agg(F.count("*"), q.total("l_extendedprice"))

    def plain_top1():
        best = orders.groupBy("o_custkey").agg(F.max(F.struct("o_orderdate", "o_orderkey", "o_totalprice")).alias("b"))
        return customer.join(best, F.col("c_custkey") == F.col("o_custkey"), "left")

    path = new_path(spark, "by-date")
    layout.write_clustered(orders, path, "o_orderdate", 8)
    mixed = new_path(spark, "mixed")
    orders.repartition(8, F.xxhash64("o_orderkey")).write.parquet(mixed)
    lo, hi = dt.datetime(1997, 3, 1), dt.datetime(1997, 3, 31)
    columns = ["o_orderkey", "o_custkey", "o_totalprice"]

    def clustered():
        return layout.key_range(spark, path, "o_orderdate", lo, hi, columns)

    def unordered():
        return layout.key_range(spark, mixed, "o_orderdate", lo, hi, columns)

    print(f"rows scanned for one month: clustered {rows_scanned(clustered())}, unordered {rows_scanned(unordered())}")
    return {
        "or_join": (lambda: q.or_join(spark, d), plain_or),
        "eager_agg_join": (lambda: q.eager_agg_join(spark, d), plain_aggregate),
        "band_join": (lambda: q.band_join(spark, d), plain_band),
        "asof_join": (lambda: q.asof_join(spark, d), plain_asof),
        "running_total": (lambda: q.running_total(spark, d), plain_running),
        "drop_fk_join": (lambda: q.drop_fk_join(spark, d), plain_fk),
        "top1_lookup": (lambda: q.top1_lookup(spark, d), plain_top1),
        "key_range": (clustered, unordered),
    }


def main() -> None:
    folder = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    runs = int(sys.argv[2]) if len(sys.argv) > 2 else 3
    spark = (
        SparkSession.builder.master("local[8]")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "8g")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")

    def best(make):
        times = []
        for _ in range(runs + 1):
            start = time.perf_counter()
            make().write.format("noop").mode("overwrite").save()
            times.append(time.perf_counter() - start)
        return min(times[1:])

    for name, (operator, plain) in pairs(spark, folder).items():
        print(f"{name:16s} operator {best(operator):7.2f} s   plain {best(plain):7.2f} s", flush=True)
    spark.stop()


if __name__ == "__main__":
    main()
