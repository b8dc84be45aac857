"""One query per operator over the given tables.

Each takes (spark, folder of the tables) and returns a DataFrame. Sums of
two-decimal values are exact and turned into a double at the end.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, functions as F

from tunesmith.functions.exact import money, seconds_between
from tunesmith.operators import advanced_joins, design, estimates, intervals, joins, lookup, rewrites, sketches, statistics, workload
from tunesmith.sources import buckets, curves, layout, skipping
from tunesmith.sources.scratch import written_once
from tunesmith.sources.tables import table

URGENT = "1-URGENT"


def total(col) -> Column:
    return F.sum(money(col)).cast("double")


def mean(col) -> Column:
    return total(col) / F.count(col)


def stamp(col) -> Column:
    """``yyyy-MM-dd HH:mm:ss`` of a stamp without a zone, in any session zone."""
    return F.substring(F.col(col).cast("string"), 1, 19)


def month(col) -> Column:
    return F.substring(F.col(col).cast("string"), 1, 7)


def seconds(col) -> Column:
    """Seconds since a fixed time, whatever the session's zone."""
    return seconds_between(F.lit("2024-01-01").cast("timestamp_ntz"), F.col(col))


def urgent_orders(spark, d) -> DataFrame:
    orders = table(spark, d, "orders")
    return orders.where((F.col("o_orderpriority") == URGENT) & (F.col("o_totalprice") > 250000))


# ---- joins ---------------------------------------------------------------


def theta_join(spark, d):
    orders = table(spark, d, "orders").select("o_orderkey", "o_totalprice", "o_orderpriority")
    levels = orders.groupBy(F.col("o_orderpriority").alias("level")).agg(mean("o_totalprice").alias("level_mean"))
    dear = joins.theta_join(orders, levels, F.col("o_totalprice") > F.col("level_mean") * 1.5)
    return dear.groupBy("level").agg(F.count("*").alias("n"), total("o_totalprice").alias("total"))


def theta_join_left(spark, d):
    customer = table(spark, d, "customer").select("c_custkey", "c_acctbal")
    levels = table(spark, d, "supplier").groupBy("s_nationkey").agg(F.max("s_acctbal").alias("level_max"))
    return joins.theta_join(customer, levels, F.col("c_acctbal") > F.col("level_max"), "left").select(
        "c_custkey", "s_nationkey"
    )


def merge_join(spark, d):
    items = table(spark, d, "lineitem").select("l_orderkey", "l_extendedprice")
    orders = table(spark, d, "orders").select("o_orderkey", "o_orderpriority")
    joined = joins.merge_join(items, orders, [("l_orderkey", "o_orderkey")])
    return joined.groupBy("o_orderpriority").agg(F.count("*").alias("n"), total("l_extendedprice").alias("total"))


def hash_join(spark, d):
    items = table(spark, d, "lineitem").select("l_partkey", "l_quantity")
    part = table(spark, d, "part").select("p_partkey", "p_brand")
    joined = joins.hash_join(items, part, [("l_partkey", "p_partkey")])
    return joined.groupBy("p_brand").agg(F.count("*").alias("n"), total("l_quantity").alias("total"))


def broadcast_join(spark, d):
    customer = table(spark, d, "customer")
    nation = table(spark, d, "nation").select("n_nationkey", "n_name")
    joined = joins.broadcast_join(customer, nation, [("c_nationkey", "n_nationkey")])
    return joined.groupBy("n_name").agg(F.count("*").alias("n"), total("c_acctbal").alias("total"))


def outer_join_left(spark, d):
    customer = table(spark, d, "customer").select("c_custkey", "c_nationkey")
    orders = urgent_orders(spark, d).select("o_custkey", "o_orderkey")
    return joins.outer_join(customer, orders, [("c_custkey", "o_custkey")], "left")


def outer_join_right(spark, d):
    customer = table(spark, d, "customer").select("c_custkey", "c_nationkey")
    orders = urgent_orders(spark, d).select("o_custkey", "o_orderkey")
    return joins.outer_join(orders, customer, [("o_custkey", "c_custkey")], "right")


def outer_join_full(spark, d):
    bought = urgent_orders(spark, d).groupBy(F.col("o_custkey").alias("person")).agg(F.count("*").alias("orders"))
    failed = (
        table(spark, d, "events")
        .where(F.col("event_type") == "error")
        .groupBy(F.col("user_id").alias("person"))
        .agg(F.count("*").alias("errors"))
    )
    return joins.outer_join(bought, failed, "person", "full")


def scalar_lookup(spark, d):
    customer = table(spark, d, "customer").select("c_custkey", "c_name")
    orders = urgent_orders(spark, d).select("o_custkey", "o_totalprice")
    return joins.scalar_lookup(customer, orders, [("c_custkey", "o_custkey")], F.max("o_totalprice"), "best")


def scalar_lookup_count(spark, d):
    customer = table(spark, d, "customer").select("c_custkey")
    orders = urgent_orders(spark, d).select("o_custkey")
    return joins.scalar_lookup(customer, orders, [("c_custkey", "o_custkey")], F.count("*"), "n", empty=0)


def scalar_filter(spark, d):
    items = table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_quantity")
    half = F.lit(0.5) * F.avg("l_quantity")
    return joins.scalar_filter(items, items, "l_partkey", half, "<", F.col("l_quantity"))


def top1_lookup(spark, d):
    customer = table(spark, d, "customer").select("c_custkey")
    orders = table(spark, d, "orders")
    latest = [F.col("o_orderdate").desc(), F.col("o_orderkey").desc()]
    found = joins.top1_lookup(
        customer, orders, [("c_custkey", "o_custkey")], latest, ["o_orderkey", "o_orderdate", "o_totalprice"]
    )
    return found.withColumn("o_orderdate", stamp("o_orderdate"))


def semi_join(spark, d):
    customer = table(spark, d, "customer").select("c_custkey", "c_name")
    return joins.semi_join(customer, urgent_orders(spark, d), [("c_custkey", "o_custkey")])


def anti_join(spark, d):
    customer = table(spark, d, "customer").select("c_custkey", "c_name")
    return joins.anti_join(customer, urgent_orders(spark, d), [("c_custkey", "o_custkey")])


def not_in(spark, d):
    customer = table(spark, d, "customer").select("c_custkey", "c_name")
    return joins.not_in(customer, urgent_orders(spark, d), [("c_custkey", "o_custkey")])


def not_in_null_list(spark, d):
    customer = table(spark, d, "customer").select("c_custkey", "c_name")
    listed = table(spark, d, "orders").select(
        F.when(F.col("o_orderpriority") == URGENT, F.col("o_custkey")).alias("o_custkey")
    )
    return joins.not_in(customer, listed, [("c_custkey", "o_custkey")])


def band_join(spark, d):
    events = table(spark, d, "events")
    errors = events.where(F.col("event_type") == "error").select(
        "user_id", F.col("event_id").alias("error_id"), seconds("ts").alias("error_at")
    )
    bought = events.where(F.col("event_type") == "purchase").select(
        "user_id", F.col("event_id").alias("purchase_id"), seconds("ts").alias("bought_at")
    )
    pairs = advanced_joins.band_join(errors, bought, "error_at", "bought_at", 7200, keys="user_id")
    return pairs.select("user_id", "error_id", "purchase_id")


def asof_join(spark, d):
    events = table(spark, d, "events")
    bought = events.where(F.col("event_type") == "purchase").select("event_id", "user_id", "ts", "value")
    views = events.where(F.col("event_type") == "view").select(
        "user_id", "ts", F.col("event_id").alias("view_id"), F.col("value").alias("view_value")
    )
    return advanced_joins.asof_join(bought, views, "user_id", "ts").withColumn("ts", stamp("ts"))


def salted_join(spark, d):
    items = table(spark, d, "lineitem").select("l_orderkey", "l_partkey", "l_returnflag", "l_extendedprice")
    levels = items.groupBy(F.col("l_returnflag").alias("flag")).agg(mean("l_extendedprice").alias("flag_mean"))
    # Each of the three flags has a third of all rows. The other side would be broadcast if it might.
    joined = advanced_joins.salted_join(items, levels, [("l_returnflag", "flag")], hot_rows=5_000, limit=-1)
    dear = joined.where(F.col("l_extendedprice") > F.col("flag_mean"))
    return dear.groupBy("flag").agg(F.count("*").alias("n"), total("l_extendedprice").alias("total"))


def star_join(spark, d):
    items = table(spark, d, "lineitem").select("l_partkey", "l_suppkey", "l_extendedprice")
    part = table(spark, d, "part").where(F.col("p_size") > 25).select("p_partkey", "p_type")
    supplier = table(spark, d, "supplier").select("s_suppkey", "s_nationkey")
    nation = table(spark, d, "nation").select("n_nationkey", "n_name", "n_regionkey")
    region = table(spark, d, "region").where(F.col("r_name") == "ASIA").select("r_regionkey")
    joined = advanced_joins.star_join(
        items,
        [
            (part, [("l_partkey", "p_partkey")]),
            (supplier, [("l_suppkey", "s_suppkey")]),
            (nation, [("s_nationkey", "n_nationkey")]),
            (region, [("n_regionkey", "r_regionkey")]),
        ],
    )
    return joined.groupBy("n_name", "p_type").agg(F.count("*").alias("n"), total("l_extendedprice").alias("total"))


def _orders_by_priority(spark, d) -> str:
    orders = table(spark, d, "orders")
    return written_once(spark, ("orders-by-priority", d), lambda path: layout.write_partitioned(orders, path, "o_orderpriority"))


def star_join_pruned(spark, d):
    orders = table(spark, d, "orders").select("o_orderkey", "o_custkey", "o_totalprice", "o_orderpriority")
    path = _orders_by_priority(spark, d)
    wanted = (
        orders.groupBy(F.col("o_orderpriority").alias("priority"))
        .agg(F.count("*").alias("rows"))
        .where(F.col("priority").startswith("1") | F.col("priority").startswith("5"))
        .select("priority")
    )
    customer = table(spark, d, "customer").select("c_custkey", "c_mktsegment")
    joined = advanced_joins.star_join(
        layout.written(spark, path), [(wanted, [("o_orderpriority", "priority")]), (customer, [("o_custkey", "c_custkey")])]
    )
    return joined.groupBy("priority", "c_mktsegment").agg(
        F.count("*").alias("n"), total("o_totalprice").alias("total")
    )


def running_total(spark, d):
    orders = table(spark, d, "orders").select("o_custkey", "o_orderkey", "o_orderdate", money("o_totalprice").alias("x"))
    out = advanced_joins.running_total(orders, ["o_custkey"], ["o_orderdate", "o_orderkey"], "x", "running")
    return out.select("o_custkey", "o_orderkey", F.col("running").cast("double").alias("running"))


def running_total_hot(spark, d):
    """Five groups with a fifth of all rows each, so each is cut along its order."""
    orders = table(spark, d, "orders").select("o_orderpriority", "o_orderkey", money("o_totalprice").alias("x"))
    out = advanced_joins.running_total(orders, ["o_orderpriority"], ["o_orderkey"], "x", "running", hot_rows=2_000)
    return out.select("o_orderpriority", "o_orderkey", F.col("running").cast("double").alias("running"))


def band_join_stamps(spark, d):
    events = table(spark, d, "events")
    errors = events.where(F.col("event_type") == "error").select("user_id", F.col("event_id").alias("error_id"), F.col("ts").alias("error_at"))
    bought = events.where(F.col("event_type") == "purchase").select("user_id", F.col("event_id").alias("purchase_id"), F.col("ts").alias("bought_at"))
    pairs = advanced_joins.band_join(errors, bought, "error_at", "bought_at", dt.timedelta(hours=2), keys="user_id")
    return pairs.select("user_id", "error_id", "purchase_id")


def interval_join(spark, d):
    """Outages, as long as their event's value in minutes, and the sessions of other users that they overlap."""
    events = table(spark, d, "events")
    minutes = F.make_dt_interval(mins=F.round("value").cast("int"))
    outages = events.where((F.col("event_type") == "error") & (F.col("value") > 60)).select(F.col("event_id").alias("outage_id"), F.col("ts").alias("down"), (F.col("ts") + minutes).alias("up"))
    visits = workload.sessions(events, "user_id", "ts", "3 hours").where("calls > 1").select("user_id", "session_start", "last_call")
    visits = rewrites.shared(visits, written=True)
    # Pairs are far more than visits: a start is made text once for each copy of a visit, not in each pair. With
    # the visits on the left, a visit's pairs come one after another, and two of their three columns hardly take room.
    late = ({"started": stamp("session_start")}, {})
    pairs = intervals.interval_join(visits, outages, ("session_start", "last_call"), ("down", "up"), late=late)
    return pairs.select("outage_id", "user_id", F.col("started").alias("session_start"))


def reduced_join(spark, d):
    """The parts are few but, with the limit off, are shuffled; so their keys thin the fact first."""
    items = table(spark, d, "lineitem").select("l_partkey", "l_extendedprice")
    part = table(spark, d, "part").where(F.col("p_size") > 45).select("p_partkey", "p_brand")
    joined = advanced_joins.reduced_join(items, part, [("l_partkey", "p_partkey")], limit=-1)
    return joined.groupBy("p_brand").agg(F.count("*").alias("n"), total("l_extendedprice").alias("total"))


# ---- layout, lookup and key design ----------------------------------------


def _orders_by_date(spark, d) -> str:
    orders = table(spark, d, "orders")
    files = layout.files_for(orders, least=8)
    return written_once(spark, ("orders-by-date", d), lambda path: layout.write_clustered(orders, path, "o_orderdate", files))


def write_clustered(spark, d):
    orders = layout.key_range(spark, _orders_by_date(spark, d), "o_orderdate")
    return orders.groupBy(month("o_orderdate").alias("month")).agg(
        F.count("*").alias("n"), total("o_totalprice").alias("total")
    )


def key_range(spark, d):
    lo, hi = dt.datetime(1997, 3, 1), dt.datetime(1997, 3, 31)
    return layout.key_range(
        spark, _orders_by_date(spark, d), "o_orderdate", lo, hi, ["o_orderkey", "o_custkey", "o_totalprice"]
    )


def write_summary(spark, d):
    items = table(spark, d, "lineitem").select(
        "l_returnflag",
        "l_linestatus",
        month("l_shipdate").alias("month"),
        money("l_extendedprice").alias("price"),
        money("l_quantity").alias("quantity"),
    )
    keys = ["l_returnflag", "l_linestatus", "month"]
    path = written_once(spark, ("item-summary", d), lambda path: lookup.write_summary(items, keys, ["price", "quantity"], path))
    rolled = lookup.from_summary(
        spark,
        path,
        ["l_returnflag", "l_linestatus"],
        {
            "n": ("rows", None),
            "total": ("sum", "price"),
            "mean_quantity": ("avg", "quantity"),
            "least": ("min", "price"),
            "greatest": ("max", "price"),
        },
    )
    return rolled.select(
        "l_returnflag",
        "l_linestatus",
        "n",
        *[F.col(c).cast("double").alias(c) for c in ("total", "mean_quantity", "least", "greatest")],
    )


def late_fetch(spark, d):
    documents = table(spark, d, "documents")
    return lookup.late_fetch(
        documents, "doc_id", [("n_chars", "desc"), ("doc_id", "asc")], 20, ["lang", "source", "text"]
    )


def in_list(spark, d):
    orders = table(spark, d, "orders")
    days = orders.where(F.col("o_totalprice") > 498000).select("o_orderdate")
    spring = (dt.datetime(1996, 3, 1), dt.datetime(1996, 5, 31))
    return lookup.in_list(orders, "o_orderdate", days, [spring]).select("o_orderkey", "o_custkey", "o_totalprice")


def in_list_only(spark, d):
    orders = table(spark, d, "orders")
    overdrawn = table(spark, d, "customer").where(F.col("c_acctbal") < 0).select("c_custkey")
    return lookup.in_list(orders, "o_custkey", overdrawn).select("o_orderkey", "o_custkey", "o_totalprice")


def top_n(spark, d):
    orders = table(spark, d, "orders").select("o_orderkey", "o_custkey", "o_totalprice")
    return lookup.top_n(orders, [F.col("o_totalprice").desc(), F.col("o_orderkey")], 100)


def top_n_per_group(spark, d):
    orders = table(spark, d, "orders").select("o_custkey", "o_orderkey", "o_totalprice")
    return lookup.top_n_per_group(orders, ["o_custkey"], [F.col("o_totalprice").desc(), F.col("o_orderkey")], 3)


def top_n_per_hot_group(spark, d):
    orders = table(spark, d, "orders").select("o_orderpriority", "o_orderkey", "o_totalprice")
    order = [F.col("o_totalprice").desc(), F.col("o_orderkey")]
    return lookup.top_n_per_group(orders, ["o_orderpriority"], order, 1_500, hot_rows=2_000)


def keyset_page(spark, d):
    orders = table(spark, d, "orders").select("o_orderkey", "o_orderdate", "o_totalprice")
    after = [dt.datetime(1998, 6, 15), 5000]
    page = lookup.keyset_page(orders, [("o_orderdate", "desc"), ("o_orderkey", "asc")], after, 50)
    return page.withColumn("o_orderdate", stamp("o_orderdate"))


ORDER_COLUMNS = ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority"]


def rounded(df, *cols, digits=6):
    return df.withColumns({c: F.round(c, digits) for c in cols})


def column_selectivity(spark, d):
    return rounded(design.column_selectivity(table(spark, d, "orders"), ORDER_COLUMNS), "selectivity")


def prefix_selectivity(spark, d):
    keys = ["l_returnflag", "l_linestatus", "l_suppkey", "l_shipdate"]
    return rounded(design.prefix_selectivity(table(spark, d, "lineitem"), keys), "avg_rows")


def clustering_factor(spark, d):
    found = layout.clustering_factor(spark, _orders_by_date(spark, d), "o_orderdate")
    return found.select("rows", "distinct_keys", (F.col("switches") == F.col("blocks") - 1).alias("in_order"))


def order_switches(spark, d):
    return design.order_switches(table(spark, d, "customer"), "c_acctbal", "c_nationkey", hot_rows=500)


def layout_candidates(spark, d):
    uses = spark.createDataFrame(
        [
            ("o_orderdate", "range", 40),
            ("o_orderstatus", "eq", 10),
            ("o_orderpriority", "eq", 25),
            ("o_custkey", "join", 30),
            ("o_custkey", "eq", 5),
            ("o_orderkey", "join", 60),
        ],
        "column_name string, kind string, uses bigint",
    )
    found = design.layout_candidates(table(spark, d, "orders"), uses, max_partitions=1_000, min_rows_per_partition=100)
    return rounded(found, "score")


def scan_footprint(spark, d):
    path = _orders_by_priority(spark, d)
    cond = F.col("o_orderpriority").isin(URGENT, "2-HIGH") & (F.col("o_totalprice") > 300000)
    found = layout.scan_footprint(spark, path, cond)
    return found.select("folders_total", "folders_hit", "rows_total", "rows_hit")


def scan_footprint_files(spark, d):
    """Whether the matches lie in no more files than their share of the rows fills.

    The counts of files depend on how Spark wrote them; range bounds are sampled, so
    two files more than the share are allowed for.
    """
    cond = F.col("o_orderdate") < F.lit("1995-07-01").cast("timestamp_ntz")
    found = layout.scan_footprint(spark, _orders_by_date(spark, d), cond)
    share = F.ceil(F.col("files_total") * F.col("rows_hit") / F.col("rows_total"))
    return found.select("rows_total", "rows_hit", (F.col("files_total") > 4).alias("many_files"), (F.col("files_hit") <= share + 2).alias("files_bounded"))


def write_partitioned(spark, d):
    orders = table(spark, d, "orders").withColumn("year", F.year("o_orderdate"))
    path = written_once(spark, ("orders-by-year", d), lambda path: layout.write_partitioned(orders, path, ["year", "o_orderstatus"]))
    cond = F.col("year").between(1996, 1997) & (F.col("o_orderstatus") == "F")
    return layout.read_partitioned(spark, path, cond, ["o_orderkey", "o_custkey", "o_totalprice", "year"])


def skipping_lookup(spark, d):
    """Orders by key in a table that is sorted by date: four keys, of which one is in no file."""
    wanted = {"o_orderkey": [7, 421, 1333, 99_999_999]}
    return skipping.skipping_lookup(spark, _orders_by_date(spark, d), _order_side(spark, d), wanted, ["o_orderkey", "o_custkey", "o_totalprice"])


def skipping_lookup_range(spark, d):
    wanted = {"o_totalprice": [(495000.0, None), (None, 2000.0)], "o_orderpriority": [URGENT, None]}
    return skipping.skipping_lookup(spark, _orders_by_date(spark, d), _order_side(spark, d), wanted, ["o_orderkey", "o_totalprice", "o_orderpriority"])


def _order_side(spark, d) -> str:
    source = _orders_by_date(spark, d)
    cols = ["o_orderkey", "o_totalprice", "o_orderpriority"]
    return written_once(spark, ("order-files", d), lambda path: skipping.write_skipping(spark, source, cols, path))


def _orders_on_curve(spark, d) -> str:
    orders = table(spark, d, "orders")
    files = layout.files_for(orders, least=16)
    return written_once(spark, ("orders-on-curve", d), lambda path: curves.write_zordered(orders, path, ["o_orderdate", "o_custkey"], files))


def key_box(spark, d):
    box = {"o_orderdate": (dt.datetime(1997, 3, 1), dt.datetime(1998, 2, 28)), "o_custkey": (10, 60)}
    return curves.key_box(spark, _orders_on_curve(spark, d), box, ["o_orderkey", "o_custkey", "o_totalprice"])


def key_box_second_key(spark, d):
    found = curves.key_box(spark, _orders_on_curve(spark, d), {"o_custkey": (100, 130)})
    return found.groupBy("o_custkey").agg(F.count("*").alias("n"), total("o_totalprice").alias("total"))


def bucketed_join(spark, d):
    items = table(spark, d, "lineitem").select("l_orderkey", "l_extendedprice")
    orders = table(spark, d, "orders").select("o_orderkey", "o_orderpriority")
    n = max(4, buckets.buckets_for(items, orders))
    joined = buckets.bucketed_join(buckets.write_bucketed(items, "l_orderkey", n), buckets.write_bucketed(orders, "o_orderkey", n))
    return joined.groupBy("o_orderpriority").agg(F.count("*").alias("n"), total("l_extendedprice").alias("total"))


def bucketed_join_hot(spark, d):
    """Each of the three flags has a third of all rows, so none is in a bucket."""
    items = table(spark, d, "lineitem").select("l_returnflag", "l_orderkey", "l_linenumber", "l_quantity")
    levels = items.groupBy(F.col("l_returnflag").alias("flag")).agg(mean("l_quantity").alias("flag_mean"))
    left = buckets.write_bucketed(items, "l_returnflag", 4, hot_rows=1_500)
    joined = buckets.bucketed_join(left, buckets.write_bucketed(levels, "flag", 4), how="left", hot_rows=5_000)
    return joined.groupBy("l_returnflag").agg(F.count_if(F.col("l_quantity") > F.col("flag_mean")).alias("above"), F.count("*").alias("n"))


def open_page(spark, d):
    orders, source = [("o_orderdate", "desc"), ("o_orderkey", "asc")], _orders_by_date(spark, d)
    pages = spark.read.parquet(source)
    path = written_once(spark, ("order-pages", d), lambda path: lookup.write_pages(pages, orders, 100, path))
    page = lookup.open_page(pages, orders, 100, path, 7)
    return page.select("o_orderkey", stamp("o_orderdate").alias("o_orderdate"), "o_totalprice")


def _with_month(orders: DataFrame) -> DataFrame:
    return orders.withColumn("month", month("o_orderdate")).withColumn("price", money("o_totalprice"))


def from_smallest(spark, d):
    """Of two summaries, the one with the fewer rows that has the keys asked for."""
    source = _orders_by_date(spark, d)
    paths = [
        written_once(spark, (name, d), lambda path, keys=keys: lookup.refresh_summary(spark, source, keys, ["price"], path, _with_month))
        for name, keys in (("orders-by-month", ["month", "o_orderpriority"]), ("orders-by-customer", ["month", "o_orderpriority", "o_custkey"]))
    ]
    aggs = {"n": ("rows", None), "total": ("sum", "price"), "mean": ("avg", "price"), "greatest": ("max", "price")}
    rolled = lookup.from_smallest(spark, [f"{p}/{lookup.ROWS}" for p in paths], ["o_orderpriority"], aggs)
    return rolled.select("o_orderpriority", "n", *[F.col(c).cast("double").alias(c) for c in ("total", "mean", "greatest")])


# ---- workload analysis ----------------------------------------------------


def cardinality_check(spark, d):
    events, orders = table(spark, d, "events"), table(spark, d, "orders")
    found = workload.cardinality_check(events, orders, [("user_id", "o_custkey")])
    return rounded(rounded(found, "estimated_rows", digits=2), "actual_to_estimated")


def trace_profile(spark, d):
    return rounded(workload.trace_profile(table(spark, d, "events"), "event_type", money("value")), "mean", "share")


def response_percentiles(spark, d):
    events = table(spark, d, "events")
    return rounded(workload.response_percentiles(events, ["event_type"], "value", [0.5, 0.95, 0.99]), "value")


def response_percentiles_hot(spark, d):
    """Few groups with many rows: each is put in order in parts."""
    items = table(spark, d, "lineitem")
    marks = [0.25, 0.5, 0.9]
    return rounded(workload.response_percentiles(items, ["l_returnflag"], "l_extendedprice", marks, hot_rows=5_000), "value")


def response_windows(spark, d):
    windows = workload.response_windows(table(spark, d, "events"), "ts", "1 hour", money("value"))
    return rounded(windows, "mean").withColumn("window_start", stamp("window_start"))


def wait_gaps(spark, d):
    events = table(spark, d, "events").select("event_id", "user_id", "ts")
    gaps = workload.wait_gaps(events, "user_id", "ts", 4 * 3600, "event_id")
    return gaps.select(
        "event_id", "user_id", stamp("previous").alias("previous"), F.col("gap_seconds").cast("double").alias("gap_seconds")
    )


def sessions(spark, d):
    found = workload.sessions(table(spark, d, "events"), "user_id", "ts", "6 hours", money("value"))
    return found.select(
        "user_id",
        stamp("session_start").alias("session_start"),
        stamp("last_call").alias("last_call"),
        "calls",
        F.col("busy").cast("double").alias("busy"),
        F.round(F.col("longest_idle").cast("double"), 3).alias("longest_idle"),
        F.round(F.col("seconds").cast("double"), 3).alias("seconds"),
    )


def join_estimate(spark, d):
    events, orders = table(spark, d, "events"), table(spark, d, "orders")
    found = estimates.join_estimate(events, orders, [("user_id", "o_custkey")], k=10, common=20, buckets=16)
    return rounded(found, "estimated_rows", "q_error", digits=3)


# ---- statistics, reuse and rewrites ----------------------------------------


def column_stats(spark, d):
    orders = table(spark, d, "orders")
    plain = orders.withColumn("o_totalprice", money("o_totalprice")).withColumn("o_orderdate", F.to_date("o_orderdate"))
    return statistics.column_stats(plain)


def sketched_stats(spark, d):
    """Bounds and counts of a table from the sketches of its parts, one per priority."""
    orders = table(spark, d, "orders").select("o_orderkey", "o_custkey", "o_totalprice", "o_orderpriority")
    path = written_once(spark, ("order-sketches", d), lambda path: sketches.write_sketches(orders, F.col("o_orderpriority"), path))
    return sketches.sketched_stats(spark, path).select("column_name", "rows", "null_rows", "least", "greatest")


def equi_height(spark, d):
    orders = table(spark, d, "orders").select(money("o_totalprice").alias("price"))
    found = statistics.equi_height(orders, "price", 20, hot_rows=2_000)
    return found.select(
        "bucket", "rows", F.col("low").cast("double").alias("low"), F.col("high").cast("double").alias("high"), "distinct_values"
    )


def equi_height_few_values(spark, d):
    return statistics.equi_height(table(spark, d, "lineitem"), "l_quantity", 64, hot_rows=10)


def common_values(spark, d):
    return statistics.common_values(table(spark, d, "lineitem"), "l_partkey", 25)


def statement_reuse(spark, d):
    log = table(spark, d, "events").select(
        F.concat(
            F.lit("SELECT  value FROM "),
            "event_type",
            F.lit(" WHERE user_id = "),
            F.col("user_id").cast("string"),
            F.lit(" AND props = '"),
            "props",
            F.lit("' -- It''s run 7"),
        ).alias("statement")
    )
    return workload.statement_reuse(log, "statement")


def run_params(spark, d):
    orders = table(spark, d, "orders")
    year = F.trunc("o_orderdate", "year")
    spans = orders.groupBy(year.cast("timestamp_ntz").alias("lo")).agg(
        F.max("o_orderdate").alias("hi"), F.lit(300000.0).alias("floor")
    )
    text = """
        SELECT count(*) AS n, CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS total
        FROM {orders} WHERE o_orderdate >= p.lo AND o_orderdate <= p.hi AND o_totalprice > p.floor
    """
    found = rewrites.run_params(spark, text, rewrites.shared(spans, written=True), orders=orders)
    return found.select(stamp("lo").alias("lo"), stamp("hi").alias("hi"), "n", "total")


def sweep_params(spark, d):
    """The months of each priority's orders of 300,000 and more, as ranges from the first to the last day seen."""
    orders = table(spark, d, "orders").select("o_orderpriority", "o_orderdate", "o_totalprice", money("o_totalprice").alias("price"))
    dear = orders.where(F.col("o_totalprice") > 300000)
    spans = orders.groupBy(F.col("o_orderpriority").alias("priority"), month("o_orderdate").alias("month")).agg(F.min("o_orderdate").alias("lo"), F.max("o_orderdate").alias("hi"))
    found = rewrites.sweep_params(dear, spans, "o_orderdate", "lo", "hi", {"n": ("rows", None), "total": ("sum", "price"), "mean": ("avg", "price")}, [("o_orderpriority", "priority")])
    return found.select("priority", "month", "n", F.col("total").cast("double").alias("total"), "mean")


def run_once(spark, d):
    text = "SELECT o_orderkey, o_totalprice FROM {orders} WHERE o_orderpriority = :priority AND o_totalprice > :floor"
    args = {"priority": URGENT, "floor": 400000.0}
    return rewrites.run_once(spark, text, args, orders=table(spark, d, "orders"))


def shared(spark, d):
    spent = rewrites.shared(
        table(spark, d, "orders").groupBy("o_custkey").agg(F.sum(money("o_totalprice")).alias("spent")), written=True
    )
    customer = table(spark, d, "customer").select("c_custkey", "c_mktsegment")
    by_segment = (
        joins.broadcast_join(customer, spent, [("c_custkey", "o_custkey")])
        .groupBy(F.col("c_mktsegment").alias("label"))
        .agg(F.sum("spent").cast("double").alias("spent"))
    )
    best = lookup.top_n(spent, [F.col("spent").desc(), F.col("o_custkey")], 10).select(
        F.col("o_custkey").cast("string").alias("label"), F.col("spent").cast("double").alias("spent")
    )
    return by_segment.unionByName(best)


def or_join(spark, d):
    items = table(spark, d, "lineitem").select("l_partkey", "l_suppkey", "l_quantity")
    part = table(spark, d, "part").select("p_partkey", "p_brand")
    joined = rewrites.or_join(items, part, [[("l_partkey", "p_partkey")], [("l_suppkey", "p_partkey")]])
    return joined.groupBy("p_brand").agg(F.count("*").alias("n"), total("l_quantity").alias("total"))


def eager_agg_join(spark, d):
    items = table(spark, d, "lineitem").select(
        "l_partkey", money("l_extendedprice").alias("price"), money("l_quantity").alias("quantity")
    )
    part = table(spark, d, "part").select("p_partkey", "p_brand")
    out = rewrites.eager_agg_join(
        items,
        part,
        [("l_partkey", "p_partkey")],
        ["p_brand"],
        {
            "n": ("count", "price"),
            "total": ("sum", "price"),
            "mean_quantity": ("avg", "quantity"),
            "least": ("min", "price"),
            "greatest": ("max", "price"),
        },
    )
    return out.select(
        "p_brand", "n", *[F.col(c).cast("double").alias(c) for c in ("total", "mean_quantity", "least", "greatest")]
    )


def _status_sets(spark, d):
    orders = table(spark, d, "orders")
    pairs = orders.select("o_custkey", "o_orderstatus")
    return pairs.where(F.col("o_orderpriority") == URGENT), pairs.where(F.col("o_orderpriority") == "5-LOW")


def intersect(spark, d):
    return rewrites.intersect(*_status_sets(spark, d))


def except_(spark, d):
    return rewrites.except_(*_status_sets(spark, d))


def drop_fk_join(spark, d):
    items = rewrites.drop_fk_join(table(spark, d, "lineitem"), "l_orderkey")
    return items.groupBy("l_returnflag").agg(F.count("*").alias("n"), total("l_extendedprice").alias("total"))


def orphan_rows(spark, d):
    return rewrites.orphan_rows(
        table(spark, d, "lineitem"), table(spark, d, "orders"), [("l_orderkey", "o_orderkey")]
    )


def best_order_of_nation(spark, d):
    """Each customer of one nation with their dearest order."""
    nation = table(spark, d, "nation").where(F.col("n_name") == "NATION_12").select("n_nationkey")
    customer = table(spark, d, "customer").select("c_custkey", "c_name", "c_nationkey")
    local = joins.broadcast_join(customer, nation, [("c_nationkey", "n_nationkey")]).select("c_custkey", "c_name")
    orders = table(spark, d, "orders").select("o_custkey", "o_totalprice")
    return joins.scalar_lookup(local, orders, [("c_custkey", "o_custkey")], F.max("o_totalprice"), "best")


ALL = [
    best_order_of_nation,
    theta_join,
    theta_join_left,
    merge_join,
    hash_join,
    broadcast_join,
    outer_join_left,
    outer_join_right,
    outer_join_full,
    scalar_lookup,
    scalar_lookup_count,
    scalar_filter,
    top1_lookup,
    semi_join,
    anti_join,
    not_in,
    not_in_null_list,
    band_join,
    band_join_stamps,
    interval_join,
    reduced_join,
    asof_join,
    salted_join,
    star_join,
    star_join_pruned,
    running_total,
    running_total_hot,
    write_clustered,
    key_range,
    write_summary,
    late_fetch,
    in_list,
    in_list_only,
    top_n,
    top_n_per_group,
    top_n_per_hot_group,
    keyset_page,
    open_page,
    from_smallest,
    skipping_lookup,
    skipping_lookup_range,
    key_box,
    key_box_second_key,
    bucketed_join,
    bucketed_join_hot,
    column_selectivity,
    prefix_selectivity,
    clustering_factor,
    order_switches,
    layout_candidates,
    scan_footprint,
    scan_footprint_files,
    write_partitioned,
    cardinality_check,
    trace_profile,
    response_percentiles,
    response_percentiles_hot,
    response_windows,
    wait_gaps,
    sessions,
    join_estimate,
    sketched_stats,
    column_stats,
    equi_height,
    equi_height_few_values,
    common_values,
    statement_reuse,
    run_params,
    sweep_params,
    run_once,
    shared,
    or_join,
    eager_agg_join,
    intersect,
    except_,
    drop_fk_join,
    orphan_rows,
]

QUERIES = {q.__name__.rstrip("_"): q for q in ALL}
