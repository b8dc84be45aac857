"""The same results in plain SQL, for DuckDB.

Rewrites are checked against the query they replace, layouts against the plain
table.
"""

from __future__ import annotations


def _total(col: str) -> str:
    return f"CAST(sum(CAST({col} AS DECIMAL(18,2))) AS DOUBLE)"


def _mean(col: str) -> str:
    return f"{_total(col)} / count({col})"


def _stamp(col: str) -> str:
    return f"strftime({col}, '%Y-%m-%d %H:%M:%S')"


URGENT = "(SELECT * FROM orders WHERE o_orderpriority = '1-URGENT' AND o_totalprice > 250000)"


def _column_profile(col: str, text: str | None = None) -> str:
    text = text or f"CAST({{f}}({col}) AS VARCHAR)"
    return f"""
        SELECT '{col}' AS column_name, count(*) AS rows, count(*) - count({col}) AS null_rows,
               count(DISTINCT {col}) AS distinct_values,
               {text.format(f='min')} AS min_value, {text.format(f='max')} AS max_value
        FROM orders"""


def _selectivity(col: str) -> str:
    return f"""
        SELECT '{col}' AS column_name, CAST(sum(n) AS BIGINT) AS rows,
               CAST(sum(CASE WHEN v IS NULL THEN n ELSE 0 END) AS BIGINT) AS null_rows,
               count(v) AS distinct_values, max(CASE WHEN v IS NOT NULL THEN n END) AS max_rows,
               round(CAST(count(v) AS DOUBLE) / sum(n), 6) AS selectivity
        FROM (SELECT {col} AS v, count(*) AS n FROM orders GROUP BY 1)"""


ORDER_COLUMNS = ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority"]
PREFIX = ["l_returnflag", "l_linestatus", "l_suppkey", "l_shipdate"]


def _prefix(n: int) -> str:
    keys = ", ".join(PREFIX[:n])
    return f"""
        SELECT CAST({n} AS INTEGER) AS prefix_length, '{keys}' AS prefix, count(*) AS distinct_keys,
               max(n) AS max_rows, round(CAST(sum(n) AS DOUBLE) / count(*), 6) AS avg_rows
        FROM (SELECT {keys}, count(*) AS n FROM lineitem GROUP BY {keys})"""


def _percentiles(by: str, x: str, ps, source: str) -> str:
    return " UNION ALL ".join(
        f"SELECT {by}, CAST({p} AS DOUBLE) AS p, round(quantile_cont({x}, {p}), 6) AS value FROM {source} GROUP BY {by}"
        for p in ps
    )


def _histogram(col: str, source: str, buckets: int) -> str:
    return f"""
        SELECT bucket, count(*) AS rows, CAST(min(v) AS DOUBLE) AS low, CAST(max(v) AS DOUBLE) AS high,
               count(DISTINCT v) AS distinct_values
        FROM (SELECT {col} AS v, ntile({buckets}) OVER (ORDER BY {col}) AS bucket FROM {source}) GROUP BY bucket"""


def _layout_rule() -> str:
    uses = {
        "o_orderdate": (0, 40, 0),
        "o_orderstatus": (10, 0, 0),
        "o_orderpriority": (25, 0, 0),
        "o_custkey": (5, 0, 30),
        "o_orderkey": (0, 0, 60),
    }
    profiles = " UNION ALL ".join(
        f"""
        SELECT '{c}' AS column_name, CAST(sum(n) AS BIGINT) AS rows, count(v) AS distinct_values, max(n) AS max_rows,
               {f} AS filters, {j} AS joins
        FROM (SELECT {c} AS v, count(*) AS n FROM orders GROUP BY 1)"""
        for c, (e, r, j) in uses.items()
        for f in [e + r]
    )
    return f"""
        WITH p AS ({profiles}), scored AS (
            SELECT column_name, rows, distinct_values, max_rows, 'partition' AS role,
                   CASE WHEN distinct_values > 1000 OR rows < distinct_values * 100 THEN 0.0
                        ELSE CAST(filters AS DOUBLE) END AS score FROM p
            UNION ALL
            SELECT column_name, rows, distinct_values, max_rows, 'sort',
                   round(filters * (1.0 - CAST(1 AS DOUBLE) / distinct_values), 6) FROM p
            UNION ALL
            SELECT column_name, rows, distinct_values, max_rows, 'bucket',
                   CASE WHEN max_rows > rows * 0.05 THEN 0.0 ELSE CAST(joins AS DOUBLE) END FROM p)
        SELECT *, CAST(row_number() OVER (PARTITION BY role ORDER BY score DESC, column_name) AS INTEGER) AS rank
        FROM scored WHERE score > 0"""


def _sessions(idle: str) -> str:
    """Each user's calls with the number of their session."""
    return f"""
        WITH paired AS (SELECT user_id, ts, value, lag(ts) OVER (PARTITION BY user_id ORDER BY ts) AS before FROM events),
        marked AS (SELECT *, CASE WHEN before IS NULL OR ts - before >= INTERVAL {idle} THEN 1 ELSE 0 END AS begins FROM paired),
        numbered AS (SELECT *, sum(begins) OVER (PARTITION BY user_id ORDER BY ts ROWS UNBOUNDED PRECEDING) AS session FROM marked)"""


ORACLE = {
    "best_order_of_nation": """
        SELECT c_custkey, c_name,
               (SELECT max(o_totalprice) FROM orders WHERE o_custkey = c_custkey) AS best
        FROM customer JOIN nation ON c_nationkey = n_nationkey WHERE n_name = 'NATION_12'""",
    "theta_join": f"""
        WITH levels AS (SELECT o_orderpriority AS level, {_mean('o_totalprice')} AS level_mean FROM orders GROUP BY 1)
        SELECT level, count(*) AS n, {_total('o_totalprice')} AS total
        FROM orders JOIN levels ON o_totalprice > level_mean * CAST(1.5 AS DOUBLE) GROUP BY level""",
    "theta_join_left": """
        SELECT c_custkey, s_nationkey FROM customer LEFT JOIN
            (SELECT s_nationkey, max(s_acctbal) AS level_max FROM supplier GROUP BY 1) ON c_acctbal > level_max""",
    "merge_join": f"""
        SELECT o_orderpriority, count(*) AS n, {_total('l_extendedprice')} AS total
        FROM lineitem JOIN orders ON l_orderkey = o_orderkey GROUP BY 1""",
    "hash_join": f"""
        SELECT p_brand, count(*) AS n, {_total('l_quantity')} AS total
        FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY 1""",
    "broadcast_join": f"""
        SELECT n_name, count(*) AS n, {_total('c_acctbal')} AS total
        FROM customer JOIN nation ON c_nationkey = n_nationkey GROUP BY 1""",
    "outer_join_left": f"""
        SELECT c_custkey, c_nationkey, o_custkey, o_orderkey FROM customer LEFT JOIN {URGENT} ON c_custkey = o_custkey""",
    "outer_join_right": f"""
        SELECT c_custkey, c_nationkey, o_custkey, o_orderkey FROM {URGENT} RIGHT JOIN customer ON c_custkey = o_custkey""",
    "outer_join_full": f"""
        SELECT person, orders, errors FROM
            (SELECT o_custkey AS person, count(*) AS orders FROM {URGENT} GROUP BY 1) FULL JOIN
            (SELECT user_id AS person, count(*) AS errors FROM events WHERE event_type = 'error' GROUP BY 1) USING (person)""",
    "scalar_lookup": f"""
        SELECT c_custkey, c_name, (SELECT max(o_totalprice) FROM {URGENT} WHERE o_custkey = c_custkey) AS best
        FROM customer""",
    "scalar_lookup_count": f"""
        SELECT c_custkey, (SELECT count(*) FROM {URGENT} WHERE o_custkey = c_custkey) AS n FROM customer""",
    "scalar_filter": """
        SELECT l_orderkey, l_linenumber, l_partkey, l_quantity FROM lineitem l
        WHERE l_quantity < (SELECT CAST(0.5 AS DOUBLE) * avg(l_quantity) FROM lineitem i WHERE i.l_partkey = l.l_partkey)""",
    "top1_lookup": f"""
        SELECT c_custkey, o_orderkey, {_stamp('o_orderdate')} AS o_orderdate, o_totalprice FROM customer LEFT JOIN
            (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) AS rn
             FROM orders) ON o_custkey = c_custkey AND rn = 1""",
    "semi_join": f"""
        SELECT c_custkey, c_name FROM customer WHERE EXISTS (SELECT 1 FROM {URGENT} WHERE o_custkey = c_custkey)""",
    "anti_join": f"""
        SELECT c_custkey, c_name FROM customer WHERE NOT EXISTS (SELECT 1 FROM {URGENT} WHERE o_custkey = c_custkey)""",
    "not_in": f"SELECT c_custkey, c_name FROM customer WHERE c_custkey NOT IN (SELECT o_custkey FROM {URGENT})",
    "not_in_null_list": """
        SELECT c_custkey, c_name FROM customer WHERE c_custkey NOT IN
            (SELECT CASE WHEN o_orderpriority = '1-URGENT' THEN o_custkey END FROM orders)""",
    "band_join": """
        SELECT e.user_id, e.event_id AS error_id, p.event_id AS purchase_id FROM events e JOIN events p
        ON e.user_id = p.user_id AND e.event_type = 'error' AND p.event_type = 'purchase'
           AND e.ts BETWEEN p.ts - INTERVAL 7200 SECOND AND p.ts + INTERVAL 7200 SECOND""",
    "asof_join": f"""
        SELECT p.event_id, p.user_id, {_stamp('p.ts')} AS ts, p.value, v.event_id AS view_id, v.value AS view_value
        FROM (SELECT * FROM events WHERE event_type = 'purchase') p
        ASOF LEFT JOIN (SELECT * FROM events WHERE event_type = 'view') v ON p.user_id = v.user_id AND p.ts >= v.ts""",
    "salted_join": f"""
        WITH levels AS (SELECT l_returnflag AS flag, {_mean('l_extendedprice')} AS flag_mean FROM lineitem GROUP BY 1)
        SELECT flag, count(*) AS n, {_total('l_extendedprice')} AS total
        FROM lineitem JOIN levels ON l_returnflag = flag WHERE l_extendedprice > flag_mean GROUP BY flag""",
    "star_join": f"""
        SELECT n_name, p_type, count(*) AS n, {_total('l_extendedprice')} AS total
        FROM lineitem, part, supplier, nation, region
        WHERE l_partkey = p_partkey AND p_size > 25 AND l_suppkey = s_suppkey AND s_nationkey = n_nationkey
          AND n_regionkey = r_regionkey AND r_name = 'ASIA' GROUP BY 1, 2""",
    "star_join_pruned": f"""
        SELECT o_orderpriority AS priority, c_mktsegment, count(*) AS n, {_total('o_totalprice')} AS total
        FROM orders JOIN customer ON o_custkey = c_custkey
        WHERE o_orderpriority LIKE '1%' OR o_orderpriority LIKE '5%' GROUP BY 1, 2""",
    "running_total": f"""
        SELECT a.o_custkey, a.o_orderkey, {_total('b.o_totalprice')} AS running
        FROM orders a JOIN orders b ON a.o_custkey = b.o_custkey
             AND (b.o_orderdate < a.o_orderdate OR (b.o_orderdate = a.o_orderdate AND b.o_orderkey <= a.o_orderkey))
        GROUP BY 1, 2""",
    "running_total_hot": """
        SELECT o_orderpriority, o_orderkey, CAST(sum(CAST(o_totalprice AS DECIMAL(18,2)))
               OVER (PARTITION BY o_orderpriority ORDER BY o_orderkey ROWS UNBOUNDED PRECEDING) AS DOUBLE) AS running
        FROM orders""",
    "write_clustered": f"""
        SELECT strftime(o_orderdate, '%Y-%m') AS month, count(*) AS n, {_total('o_totalprice')} AS total
        FROM orders GROUP BY 1""",
    "key_range": """
        SELECT o_orderkey, o_custkey, o_totalprice FROM orders
        WHERE o_orderdate BETWEEN TIMESTAMP '1997-03-01' AND TIMESTAMP '1997-03-31'""",
    "write_summary": f"""
        SELECT l_returnflag, l_linestatus, count(*) AS n, {_total('l_extendedprice')} AS total,
               {_mean('l_quantity')} AS mean_quantity, min(l_extendedprice) AS least, max(l_extendedprice) AS greatest
        FROM lineitem GROUP BY 1, 2""",
    "late_fetch": """
        SELECT doc_id, n_chars, lang, source, text FROM documents ORDER BY n_chars DESC, doc_id LIMIT 20""",
    "in_list": """
        SELECT o_orderkey, o_custkey, o_totalprice FROM orders
        WHERE o_orderdate IN (SELECT o_orderdate FROM orders WHERE o_totalprice > 498000)
           OR o_orderdate BETWEEN TIMESTAMP '1996-03-01' AND TIMESTAMP '1996-05-31'""",
    "in_list_only": """
        SELECT o_orderkey, o_custkey, o_totalprice FROM orders
        WHERE o_custkey IN (SELECT c_custkey FROM customer WHERE c_acctbal < 0)""",
    "top_n": """
        SELECT o_orderkey, o_custkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 100""",
    "top_n_per_group": """
        SELECT o_custkey, o_orderkey, o_totalprice FROM orders
        QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_totalprice DESC, o_orderkey) <= 3""",
    "top_n_per_hot_group": """
        SELECT o_orderpriority, o_orderkey, o_totalprice FROM orders
        QUALIFY row_number() OVER (PARTITION BY o_orderpriority ORDER BY o_totalprice DESC, o_orderkey) <= 1500""",
    "keyset_page": f"""
        SELECT o_orderkey, {_stamp('o_orderdate')} AS o_orderdate, o_totalprice FROM (
            SELECT * FROM orders WHERE o_orderdate < TIMESTAMP '1998-06-15'
                OR (o_orderdate = TIMESTAMP '1998-06-15' AND o_orderkey > 5000)
            ORDER BY o_orderdate DESC, o_orderkey LIMIT 50)""",
    "column_selectivity": " UNION ALL ".join(_selectivity(c) for c in ORDER_COLUMNS),
    "prefix_selectivity": " UNION ALL ".join(_prefix(n) for n in (1, 2, 3, 4)),
    "clustering_factor": """
        SELECT count(*) AS rows, count(DISTINCT o_orderdate) AS distinct_keys, true AS in_order FROM orders""",
    "order_switches": """
        SELECT count(*) AS rows, count(DISTINCT c_acctbal) AS distinct_keys,
               CAST(sum(CASE WHEN before <> c_nationkey THEN 1 ELSE 0 END) AS BIGINT) AS switches,
               count(DISTINCT c_nationkey) AS blocks
        FROM (SELECT *, lag(c_nationkey) OVER (ORDER BY c_acctbal, c_nationkey) AS before FROM customer)""",
    "layout_candidates": _layout_rule(),
    "scan_footprint": """
        SELECT count(*) AS folders_total, count(*) FILTER (hits > 0) AS folders_hit,
               CAST(sum(n) AS BIGINT) AS rows_total, CAST(sum(hits) AS BIGINT) AS rows_hit
        FROM (SELECT o_orderpriority, count(*) AS n,
                     count(*) FILTER (o_orderpriority IN ('1-URGENT', '2-HIGH') AND o_totalprice > 300000) AS hits
              FROM orders GROUP BY 1)""",
    "scan_footprint_files": """
        SELECT count(*) AS rows_total, count(*) FILTER (o_orderdate < TIMESTAMP '1995-07-01') AS rows_hit,
               true AS many_files, true AS files_bounded FROM orders""",
    "write_partitioned": """
        SELECT o_orderkey, o_custkey, o_totalprice, CAST(year(o_orderdate) AS INTEGER) AS year FROM orders
        WHERE year(o_orderdate) BETWEEN 1996 AND 1997 AND o_orderstatus = 'F'""",
    "cardinality_check": """
        WITH l AS (SELECT user_id AS k, count(*) AS a FROM events GROUP BY 1),
             r AS (SELECT o_custkey AS k, count(*) AS b FROM orders GROUP BY 1),
             s AS (SELECT (SELECT sum(a) FROM l) AS left_rows, (SELECT sum(b) FROM r) AS right_rows,
                          (SELECT count(k) FROM l) AS left_keys, (SELECT count(k) FROM r) AS right_keys,
                          (SELECT sum(a * b) FROM l JOIN r USING (k)) AS actual),
             e AS (SELECT *, CAST(left_rows AS DOUBLE) * CAST(right_rows AS DOUBLE)
                             / greatest(left_keys, right_keys) AS estimate FROM s)
        SELECT CAST(left_rows AS BIGINT) AS left_rows, CAST(right_rows AS BIGINT) AS right_rows, left_keys, right_keys,
               CAST(actual AS DOUBLE) AS actual_rows, round(estimate, 2) AS estimated_rows,
               round(CAST(actual AS DOUBLE) / estimate, 6) AS actual_to_estimated FROM e""",
    "trace_profile": f"""
        SELECT event_type, count(*) AS calls, {_total('value')} AS total, max(value) AS greatest,
               round({_mean('value')}, 6) AS mean,
               round({_total('value')} / (SELECT {_total('value')} FROM events), 6) AS share
        FROM events GROUP BY 1""",
    "response_percentiles": _percentiles("event_type", "value", [0.5, 0.95, 0.99], "events"),
    "response_percentiles_hot": _percentiles("l_returnflag", "l_extendedprice", [0.25, 0.5, 0.9], "lineitem"),
    "response_windows": f"""
        SELECT strftime(date_trunc('hour', ts), '%Y-%m-%d %H:%M:%S') AS window_start, count(*) AS calls,
               {_total('value')} AS total, round({_mean('value')}, 6) AS mean, max(value) AS greatest
        FROM events GROUP BY 1""",
    "wait_gaps": f"""
        SELECT event_id, user_id, {_stamp('previous')} AS previous,
               CAST(epoch_us(ts) - epoch_us(previous) AS DOUBLE) / 1000000 AS gap_seconds
        FROM (SELECT *, lag(ts) OVER (PARTITION BY user_id ORDER BY ts) AS previous FROM events)
        WHERE epoch_us(ts) - epoch_us(previous) >= CAST(14400 AS BIGINT) * 1000000""",
    "column_stats": " UNION ALL ".join(
        [
            _column_profile("o_orderkey"),
            _column_profile("o_custkey"),
            _column_profile("o_orderstatus"),
            _column_profile("o_totalprice", "CAST(CAST({f}(o_totalprice) AS DECIMAL(18,2)) AS VARCHAR)"),
            _column_profile("o_orderdate", "CAST(CAST({f}(o_orderdate) AS DATE) AS VARCHAR)"),
            _column_profile("o_orderpriority"),
        ]
    ),
    "equi_height": _histogram("o_totalprice", "orders", 20),
    "equi_height_few_values": _histogram("l_quantity", "lineitem", 64),
    "common_values": """
        SELECT l_partkey, count(*) AS rows FROM lineitem GROUP BY 1 ORDER BY rows DESC, l_partkey LIMIT 25""",
    "statement_reuse": r"""
        WITH log AS (SELECT 'SELECT  value FROM ' || event_type || ' WHERE user_id = ' || user_id || ' AND props = '''
                            || props || ''' -- It''''s run 7' AS t FROM events),
             shaped AS (SELECT t, lower(trim(regexp_replace(regexp_replace(regexp_replace(t,
                            '''(?:[^'']|'''')*''', '?', 'g'),
                            '\b[0-9]+(?:\.[0-9]+)?(?:[eE][+-]?[0-9]+)?\b', '?', 'g'), '\s+', ' ', 'g'))) AS fingerprint
                        FROM log)
        SELECT fingerprint, count(*) AS executions, count(DISTINCT t) AS distinct_texts FROM shaped GROUP BY 1""",
    "run_params": f"""
        WITH p AS (SELECT date_trunc('year', o_orderdate) AS lo, max(o_orderdate) AS hi FROM orders GROUP BY 1)
        SELECT {_stamp('lo')} AS lo, {_stamp('hi')} AS hi, count(o_orderkey) AS n, {_total('o_totalprice')} AS total
        FROM p LEFT JOIN orders ON o_orderdate >= lo AND o_orderdate <= hi AND o_totalprice > 300000 GROUP BY lo, hi""",
    "run_once": """
        SELECT o_orderkey, o_totalprice FROM orders WHERE o_orderpriority = '1-URGENT' AND o_totalprice > 400000""",
    "shared": f"""
        SELECT c_mktsegment AS label, {_total('o_totalprice')} AS spent
        FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY 1
        UNION ALL
        SELECT * FROM (SELECT CAST(o_custkey AS VARCHAR), {_total('o_totalprice')} AS spent FROM orders
                       GROUP BY o_custkey ORDER BY spent DESC, o_custkey LIMIT 10)""",
    "or_join": f"""
        SELECT p_brand, count(*) AS n, {_total('l_quantity')} AS total
        FROM lineitem JOIN part ON l_partkey = p_partkey OR l_suppkey = p_partkey GROUP BY 1""",
    "eager_agg_join": f"""
        SELECT p_brand, count(l_extendedprice) AS n, {_total('l_extendedprice')} AS total,
               {_mean('l_quantity')} AS mean_quantity, min(l_extendedprice) AS least, max(l_extendedprice) AS greatest
        FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY 1""",
    "intersect": """
        SELECT o_custkey, o_orderstatus FROM orders WHERE o_orderpriority = '1-URGENT'
        INTERSECT SELECT o_custkey, o_orderstatus FROM orders WHERE o_orderpriority = '5-LOW'""",
    "except": """
        SELECT o_custkey, o_orderstatus FROM orders WHERE o_orderpriority = '1-URGENT'
        EXCEPT SELECT o_custkey, o_orderstatus FROM orders WHERE o_orderpriority = '5-LOW'""",
    "drop_fk_join": f"""
        SELECT l_returnflag, count(*) AS n, {_total('l_extendedprice')} AS total
        FROM lineitem JOIN orders ON l_orderkey = o_orderkey GROUP BY 1""",
    "orphan_rows": """
        SELECT count(*) AS orphans FROM lineitem WHERE l_orderkey NOT IN (SELECT o_orderkey FROM orders)""",
    "band_join_stamps": """
        SELECT e.user_id, e.event_id AS error_id, p.event_id AS purchase_id FROM events e JOIN events p
        ON e.user_id = p.user_id AND e.event_type = 'error' AND p.event_type = 'purchase'
           AND e.ts BETWEEN p.ts - INTERVAL 2 HOUR AND p.ts + INTERVAL 2 HOUR""",
    "sessions": f"""
        {_sessions('6 HOUR')}
        SELECT user_id, {_stamp('min(ts)')} AS session_start, {_stamp('max(ts)')} AS last_call, count(*) AS calls, {_total('value')} AS busy,
               round(max(CASE WHEN begins = 0 THEN epoch_us(ts) - epoch_us(before) END) / 1e6, 3) AS longest_idle,
               round((epoch_us(max(ts)) - epoch_us(min(ts))) / 1e6, 3) AS seconds
        FROM numbered GROUP BY user_id, session""",
    "interval_join": f"""
        {_sessions('3 HOUR')},
        visits AS (SELECT user_id, min(ts) AS first, max(ts) AS last FROM numbered GROUP BY user_id, session HAVING count(*) > 1),
        outages AS (SELECT event_id AS outage_id, ts AS down, ts + to_minutes(CAST(round(value) AS INTEGER)) AS up FROM events WHERE event_type = 'error' AND value > 60)
        SELECT outage_id, user_id, {_stamp('first')} AS session_start FROM outages JOIN visits ON down < last AND first < up AND down < up AND first < last""",
    "reduced_join": f"""
        SELECT p_brand, count(*) AS n, {_total('l_extendedprice')} AS total
        FROM lineitem JOIN part ON l_partkey = p_partkey WHERE p_size > 45 GROUP BY 1""",
    "skipping_lookup": """
        SELECT o_orderkey, o_custkey, o_totalprice FROM orders WHERE o_orderkey IN (7, 421, 1333, 99999999)""",
    "skipping_lookup_range": """
        SELECT o_orderkey, o_totalprice, o_orderpriority FROM orders
        WHERE (o_totalprice >= 495000 OR o_totalprice <= 2000) AND (o_orderpriority = '1-URGENT' OR o_orderpriority IS NULL)""",
    "key_box": """
        SELECT o_orderkey, o_custkey, o_totalprice FROM orders
        WHERE o_orderdate BETWEEN TIMESTAMP '1997-03-01' AND TIMESTAMP '1998-02-28' AND o_custkey BETWEEN 10 AND 60""",
    "key_box_second_key": f"""
        SELECT o_custkey, count(*) AS n, {_total('o_totalprice')} AS total FROM orders WHERE o_custkey BETWEEN 100 AND 130 GROUP BY 1""",
    "bucketed_join": f"""
        SELECT o_orderpriority, count(*) AS n, {_total('l_extendedprice')} AS total
        FROM lineitem JOIN orders ON l_orderkey = o_orderkey GROUP BY 1""",
    "bucketed_join_hot": f"""
        SELECT l_returnflag, count(*) FILTER (l_quantity > flag_mean) AS above, count(*) AS n
        FROM lineitem LEFT JOIN (SELECT l_returnflag AS flag, {_mean('l_quantity')} AS flag_mean FROM lineitem GROUP BY 1) ON l_returnflag = flag
        GROUP BY 1""",
    "open_page": f"""
        SELECT o_orderkey, {_stamp('o_orderdate')} AS o_orderdate, o_totalprice FROM orders
        ORDER BY orders.o_orderdate DESC, o_orderkey LIMIT 100 OFFSET 600""",
    "from_smallest": f"""
        SELECT o_orderpriority, count(*) AS n, {_total('o_totalprice')} AS total, {_mean('o_totalprice')} AS mean, max(o_totalprice) AS greatest
        FROM orders GROUP BY 1""",
    "sketched_stats": """
        SELECT 'o_orderkey' AS column_name, CAST(count(*) AS BIGINT) AS rows, CAST(count(*) - count(o_orderkey) AS BIGINT) AS null_rows,
               CAST(min(o_orderkey) AS DOUBLE) AS least, CAST(max(o_orderkey) AS DOUBLE) AS greatest FROM orders
        UNION ALL SELECT 'o_custkey', count(*), count(*) - count(o_custkey), min(o_custkey), max(o_custkey) FROM orders
        UNION ALL SELECT 'o_totalprice', count(*), count(*) - count(o_totalprice), min(o_totalprice), max(o_totalprice) FROM orders
        UNION ALL SELECT 'o_orderpriority', count(*), count(*) - count(o_orderpriority), NULL, NULL FROM orders""",
    "sweep_params": f"""
        WITH p AS (SELECT o_orderpriority AS priority, strftime(o_orderdate, '%Y-%m') AS month, min(o_orderdate) AS lo, max(o_orderdate) AS hi FROM orders GROUP BY 1, 2)
        SELECT priority, month, count(o_orderkey) AS n, {_total('o_totalprice')} AS total, {_mean('o_totalprice')} AS mean
        FROM p LEFT JOIN orders ON o_orderpriority = priority AND o_orderdate BETWEEN lo AND hi AND o_totalprice > 300000 GROUP BY 1, 2""",
    "join_estimate": """
        WITH l AS (SELECT user_id AS v FROM events WHERE user_id IS NOT NULL), r AS (SELECT o_custkey AS v FROM orders WHERE o_custkey IS NOT NULL),
        lc AS (SELECT v, count(*) AS n FROM l GROUP BY v ORDER BY n DESC, v LIMIT 20), rc AS (SELECT v, count(*) AS n FROM r GROUP BY v ORDER BY n DESC, v LIMIT 20),
        lh AS (SELECT min(v) AS low, max(v) AS high, count(*) AS n, count(DISTINCT v) AS d
               FROM (SELECT v, ntile(16) OVER (ORDER BY v) AS b FROM l WHERE v NOT IN (SELECT v FROM lc)) GROUP BY b),
        rh AS (SELECT min(v) AS low, max(v) AS high, count(*) AS n, count(DISTINCT v) AS d
               FROM (SELECT v, ntile(16) OVER (ORDER BY v) AS b FROM r WHERE v NOT IN (SELECT v FROM rc)) GROUP BY b),
        listed AS (SELECT coalesce(lc.v, rc.v) AS v, lc.n AS ln, rc.n AS rn FROM lc FULL JOIN rc ON lc.v = rc.v),
        guessed AS (SELECT v, coalesce(ln, (SELECT arg_min(n / d, (low, high)) FROM lh WHERE v BETWEEN low AND high), 0.0)
                            * coalesce(rn, (SELECT arg_min(n / d, (low, high)) FROM rh WHERE v BETWEEN low AND high), 0.0) AS e FROM listed),
        met AS (SELECT lh.n AS ln, rh.n AS rn, lh.d AS ld, rh.d AS rd, (least(lh.high, rh.high) - greatest(lh.low, rh.low) + 1) / (lh.high - lh.low + 1) AS lp,
                       (least(lh.high, rh.high) - greatest(lh.low, rh.low) + 1) / (rh.high - rh.low + 1) AS rp
                FROM lh JOIN rh ON lh.low <= rh.high AND rh.low <= lh.high),
        whole AS (SELECT coalesce((SELECT sum(e) FROM guessed), 0) + coalesce((SELECT sum(ln * lp * rn * rp / greatest(ld * lp, rd * rp, 1)) FROM met), 0) AS e),
        pairs AS (SELECT a.v, CAST(a.n AS DOUBLE) * b.n AS actual FROM (SELECT v, count(*) AS n FROM l GROUP BY v) a JOIN (SELECT v, count(*) AS n FROM r GROUP BY v) b ON a.v = b.v),
        heavy AS (SELECT v, actual FROM pairs ORDER BY actual DESC, v LIMIT 10),
        lines AS (
          SELECT heavy.v AS key, actual, coalesce(ln, (SELECT arg_min(n / d, (low, high)) FROM lh WHERE heavy.v BETWEEN low AND high), 0.0)
                                 * coalesce(rn, (SELECT arg_min(n / d, (low, high)) FROM rh WHERE heavy.v BETWEEN low AND high), 0.0) AS e
          FROM heavy LEFT JOIN listed ON heavy.v = listed.v),
        every AS (SELECT key, e, actual FROM lines
                  UNION ALL SELECT NULL, greatest((SELECT e FROM whole) - (SELECT sum(e) FROM lines), 0.0), (SELECT sum(actual) FROM pairs) - (SELECT sum(actual) FROM lines))
        SELECT key, round(e, 3) AS estimated_rows, actual AS actual_rows, round(greatest(e, actual, 1.0) / least(greatest(e, 1.0), greatest(actual, 1.0)), 3) AS q_error FROM every""",
}
