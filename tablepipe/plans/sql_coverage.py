"""Q1 coverage: what users run through the SQL passthrough, one query per
category, each with its DuckDB-dialect twin.

Shapes are chosen to hold at scale: dimension joins let Spark broadcast only
below its size threshold (sort-merge join above it, AQE splits skewed
partitions); windows partition by customer, not by a 5-value segment; the
as-of query splits each key by day (no join pairs, no whole-key window); the
range join meets a calendar by the month; sums that would depend on addition
order are exact decimals.
"""

from __future__ import annotations

from .catalog import register
from .query import register_dir, run_sql


def sql_query(name: str, spark_sql: str, duck_sql: str | None = None, tables=()):
    def run(spark, sf_dir):
        register_dir(spark, sf_dir, tables)
        return run_sql(spark, spark_sql)
    run.__name__ = name
    register(name, duck_sql if duck_sql is not None else spark_sql)(run)


# projection / filter / predicates
sql_query("sql_filter_predicates", """
SELECT l_orderkey, l_linenumber, l_quantity, l_returnflag,
       CASE WHEN l_discount >= 0.05 THEN 'high' ELSE 'low' END AS disc_band
FROM lineitem
WHERE l_shipdate >= TIMESTAMP_NTZ '1996-01-01' AND l_shipdate < TIMESTAMP_NTZ '1998-01-01'
  AND l_returnflag IN ('A', 'R') AND l_quantity BETWEEN 10 AND 30
""", """
SELECT l_orderkey, l_linenumber, l_quantity, l_returnflag,
       CASE WHEN l_discount >= 0.05 THEN 'high' ELSE 'low' END AS disc_band
FROM lineitem
WHERE l_shipdate >= TIMESTAMP '1996-01-01' AND l_shipdate < TIMESTAMP '1998-01-01'
  AND l_returnflag IN ('A', 'R') AND l_quantity BETWEEN 10 AND 30
""", ("lineitem",))

# equi join over the star (broadcast below the size threshold, sort-merge above)
sql_query("sql_join_star", """
SELECT n.n_name, r.r_name, count(*) AS n_orders,
       CAST(sum(CAST(o.o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS total_price
FROM orders o
JOIN customer c ON o.o_custkey = c.c_custkey
JOIN nation n ON c.c_nationkey = n.n_nationkey
JOIN region r ON n.n_regionkey = r.r_regionkey
WHERE c.c_mktsegment LIKE '%BUIL%' OR c.c_mktsegment LIKE 'AUTO%'
GROUP BY n.n_name, r.r_name
""", None, ("orders", "customer", "nation", "region"))

# the lineitem side of the star: revenue per supplier nation and part type
sql_query("sql_join_lineitem", """
SELECT n.n_name, p.p_type, count(*) AS n_lines,
       CAST(sum(CAST(l.l_extendedprice AS DECIMAL(18,2))) AS DOUBLE) AS revenue
FROM lineitem l
JOIN supplier s ON l.l_suppkey = s.s_suppkey
JOIN nation n ON s.s_nationkey = n.n_nationkey
JOIN part p ON l.l_partkey = p.p_partkey
GROUP BY n.n_name, p.p_type
""", None, ("lineitem", "supplier", "nation", "part"))

# left outer join
sql_query("sql_left_join", """
SELECT c.c_custkey, count(o.o_orderkey) AS n_orders
FROM customer c LEFT JOIN orders o ON c.c_custkey = o.o_custkey
GROUP BY c.c_custkey
""", None, ("customer", "orders"))

# semi / anti join
sql_query("sql_semi_anti", """
SELECT 'with_orders' AS kind, count(*) AS n FROM customer c LEFT SEMI JOIN orders o ON c.c_custkey = o.o_custkey
UNION ALL
SELECT 'without_orders', count(*) FROM customer c LEFT ANTI JOIN orders o ON c.c_custkey = o.o_custkey
""", """
SELECT 'with_orders' AS kind, count(*) AS n FROM customer c
WHERE EXISTS (SELECT 1 FROM orders o WHERE o.o_custkey = c.c_custkey)
UNION ALL
SELECT 'without_orders', count(*) FROM customer c
WHERE NOT EXISTS (SELECT 1 FROM orders o WHERE o.o_custkey = c.c_custkey)
""", ("customer", "orders"))

# full outer join: each side is aggregated per nation first, so the join
# meets one row per nation on each side (no supplier x customer pairs)
sql_query("sql_full_outer", """
SELECT coalesce(s.nationkey, c.nationkey) AS nationkey,
       coalesce(s.n_suppliers, 0) AS n_suppliers, coalesce(c.n_customers, 0) AS n_customers
FROM (SELECT s_nationkey AS nationkey, count(DISTINCT s_suppkey) AS n_suppliers
      FROM supplier WHERE s_acctbal > 0 GROUP BY s_nationkey) s
FULL OUTER JOIN (SELECT c_nationkey AS nationkey, count(DISTINCT c_custkey) AS n_customers
                 FROM customer WHERE c_acctbal > 5000 GROUP BY c_nationkey) c
  ON s.nationkey = c.nationkey
""", None, ("supplier", "customer"))

# range join: orders to the months of their own date span; an order meets the
# one month it is truncated to, the interval is the residual condition
sql_query("sql_range_join", """
WITH span AS (SELECT date_trunc('MONTH', min(o_orderdate)) AS lo, max(o_orderdate) AS hi FROM orders),
months AS (
  SELECT m AS m_start, m + INTERVAL 1 MONTH AS m_end
  FROM span LATERAL VIEW explode(sequence(lo, hi, INTERVAL 1 MONTH)) t AS m)
SELECT m.m_start, count(*) AS n_orders
FROM orders o JOIN months m ON date_trunc('MONTH', o.o_orderdate) = m.m_start
  AND o.o_orderdate >= m.m_start AND o.o_orderdate < m.m_end
GROUP BY m.m_start
""", """
WITH span AS (SELECT date_trunc('month', min(o_orderdate)) AS lo, max(o_orderdate) AS hi FROM orders),
months AS (
  SELECT CAST(m AS TIMESTAMP) AS m_start, CAST(m + INTERVAL 1 MONTH AS TIMESTAMP) AS m_end
  FROM span, unnest(generate_series(lo, hi, INTERVAL 1 MONTH)) t(m))
SELECT m.m_start, count(*) AS n_orders
FROM orders o JOIN months m ON o.o_orderdate >= m.m_start AND o.o_orderdate < m.m_end
GROUP BY m.m_start
""", ("orders",))

# equi join with a range condition
sql_query("sql_band_join", """
SELECT l.l_returnflag, count(*) AS n_lines
FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey
WHERE l.l_shipdate BETWEEN o.o_orderdate AND o.o_orderdate + INTERVAL 365 DAYS
GROUP BY l.l_returnflag
""", """
SELECT l.l_returnflag, count(*) AS n_lines
FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey
WHERE l.l_shipdate BETWEEN o.o_orderdate AND o.o_orderdate + INTERVAL 365 DAYS
GROUP BY l.l_returnflag
""", ("lineitem", "orders"))

# as-of: the customer's last order at or before each event.  No join pairs and
# no window over a whole key: within a (customer, day) bucket a window over
# the union of both sides finds the in-bucket match; the last order of the
# earlier buckets comes from a window over the small (customer, day) summary,
# whose size per key is bounded by the number of days.
_ASOF = """
WITH u AS (
  SELECT o_custkey AS k, date_trunc('{month}', o_orderdate) AS b, o_orderdate AS t, 0 AS side,
         CAST(NULL AS BIGINT) AS event_id, o_orderkey AS orderkey
  FROM orders WHERE o_custkey IN (SELECT user_id FROM events)
  UNION ALL
  SELECT user_id, date_trunc('{month}', ts), ts, 1, event_id, CAST(NULL AS BIGINT) FROM events),
in_bucket AS (
  SELECT k, b, event_id, side,
         {last} OVER (PARTITION BY k, b ORDER BY t, side, orderkey
                      ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS hit,
         {last} OVER (PARTITION BY k, b ORDER BY t, side, orderkey
                      ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING) AS bucket_last
  FROM u),
buckets AS (SELECT k, b, max(bucket_last) AS last_in_bucket FROM in_bucket GROUP BY k, b),
carry AS (
  SELECT k, b, {last_carry} OVER (PARTITION BY k ORDER BY b
                                  ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS carried
  FROM buckets)
SELECT i.event_id, i.k AS user_id, coalesce(i.hit, c.carried) AS last_orderkey
FROM in_bucket i JOIN carry c ON i.k = c.k AND i.b = c.b
WHERE i.side = 1
"""
sql_query("sql_asof",
          _ASOF.format(month="DAY", last="last(orderkey, true)",
                       last_carry="last(last_in_bucket, true)"),
          """
SELECT e.event_id, e.user_id,
       (SELECT max({'t': o.o_orderdate, 'k': o.o_orderkey}).k FROM orders o
        WHERE o.o_custkey = e.user_id AND o.o_orderdate <= e.ts) AS last_orderkey
FROM events e
""", ("events", "orders"))

# group-by, distinct, having
sql_query("sql_group_having", """
SELECT c_mktsegment, count(DISTINCT c_nationkey) AS n_nations, count(*) AS n_customers,
       round(avg(c_acctbal), 2) AS avg_bal
FROM customer GROUP BY c_mktsegment HAVING count(*) > 10
""", None, ("customer",))

sql_query("sql_distinct", """
SELECT DISTINCT o_orderstatus, o_orderpriority FROM orders
""", None, ("orders",))

# grouping sets / rollup / cube
_GROUPING = """
SELECT l_returnflag, l_linestatus, CAST(GROUPING(l_returnflag) AS INT) AS g_flag,
       CAST(GROUPING(l_linestatus) AS INT) AS g_status,
       count(*) AS n_lines, sum(l_quantity) AS sum_qty
FROM lineitem GROUP BY {g}
"""
sql_query("sql_rollup", _GROUPING.format(g="ROLLUP (l_returnflag, l_linestatus)"), None, ("lineitem",))
sql_query("sql_cube", _GROUPING.format(g="CUBE (l_returnflag, l_linestatus)"), None, ("lineitem",))
sql_query("sql_grouping_sets", _GROUPING.format(
    g="GROUPING SETS ((l_returnflag, l_linestatus), (l_returnflag), ())"), None, ("lineitem",))

# windows: ranking, analytic, running frame per customer.  A customer holding
# a third of all rows must not land in one task, so every window runs over a
# (customer, bucket) split and a window over the small per-bucket summary
# carries what earlier buckets contribute: month buckets for the running total
# and the previous order date, price bands for the rank.  The oracle is the
# plain definition with whole-customer windows.
sql_query("sql_window", """
WITH o AS (
  SELECT o_orderkey, o_custkey AS k, o_orderdate AS t, CAST(o_totalprice AS DECIMAL(18,2)) AS p,
         date_trunc('MONTH', o_orderdate) AS b, CAST(floor(o_totalprice / 10000) AS BIGINT) AS pb
  FROM orders),
in_b AS (
  SELECT o_orderkey, k, b, pb,
         sum(p) OVER (PARTITION BY k, b ORDER BY t, o_orderkey
                      ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS run_in_b,
         lag(t) OVER (PARTITION BY k, b ORDER BY t, o_orderkey) AS prev_in_b,
         row_number() OVER (PARTITION BY k, pb ORDER BY p DESC, o_orderkey) AS rn_in_pb
  FROM o),
months AS (
  SELECT k, b,
         coalesce(sum(s) OVER (PARTITION BY k ORDER BY b ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)
           AS before_b,
         max(last_t) OVER (PARTITION BY k ORDER BY b ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
           AS last_before_b
  FROM (SELECT k, b, sum(p) AS s, max(t) AS last_t FROM o GROUP BY k, b) m),
bands AS (
  SELECT k, pb,
         coalesce(sum(c) OVER (PARTITION BY k ORDER BY pb DESC ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)
           AS above
  FROM (SELECT k, pb, count(*) AS c FROM o GROUP BY k, pb) c)
SELECT i.o_orderkey, i.k AS o_custkey,
       CAST(bd.above + i.rn_in_pb AS INT) AS price_rank,
       coalesce(i.prev_in_b, m.last_before_b) AS prev_orderdate,
       CAST(m.before_b + i.run_in_b AS DOUBLE) AS running_total
FROM in_b i
JOIN months m ON m.k = i.k AND m.b = i.b
JOIN bands bd ON bd.k = i.k AND bd.pb = i.pb
""", """
SELECT o_orderkey, o_custkey,
       CAST(rank() OVER (PARTITION BY o_custkey ORDER BY o_totalprice DESC, o_orderkey) AS INT) AS price_rank,
       lag(o_orderdate) OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) AS prev_orderdate,
       CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) OVER (
         PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey
         ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS DOUBLE) AS running_total
FROM orders
""", ("orders",))

# top-k overall and per group (row_number <= k is limited per task before the shuffle)
sql_query("sql_topk", """
SELECT o_orderkey, o_custkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 20
""", None, ("orders",))
sql_query("sql_topk_per_group", """
SELECT o_custkey, o_orderkey, o_totalprice FROM (
  SELECT o_custkey, o_orderkey, o_totalprice,
         row_number() OVER (PARTITION BY o_custkey ORDER BY o_totalprice DESC, o_orderkey) AS rn
  FROM orders) t
WHERE rn <= 3
""", None, ("orders",))

# set operations
sql_query("sql_setops", """
SELECT 'union' AS op, count(*) AS n FROM (SELECT c_nationkey AS k FROM customer UNION SELECT s_nationkey FROM supplier) a
UNION ALL SELECT 'intersect', count(*) FROM (SELECT c_custkey FROM customer INTERSECT SELECT o_custkey FROM orders) b
UNION ALL SELECT 'except', count(*) FROM (SELECT c_custkey FROM customer EXCEPT SELECT o_custkey FROM orders) c
UNION ALL SELECT 'union_all', count(*) FROM (SELECT o_custkey FROM orders UNION ALL SELECT c_custkey FROM customer) d
""", None, ("customer", "supplier", "orders"))

# scalar functions: string, date, math, json
sql_query("sql_scalar_events", """
SELECT event_id, upper(event_type) AS event_type_uc, date_trunc('DAY', ts) AS day,
       CAST(round(CAST(value AS DECIMAL(18,2)) * 1.5, 2) AS DOUBLE) AS value_x, CAST(get_json_object(props, '$.k') AS INT) AS k,
       length(props) AS props_len, abs(value - 10) AS dist
FROM events
""", """
SELECT event_id, upper(event_type) AS event_type_uc, date_trunc('day', ts) AS day,
       CAST(round(CAST(value AS DECIMAL(18,2)) * 1.5, 2) AS DOUBLE) AS value_x, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k,
       length(props) AS props_len, abs(value - 10) AS dist
FROM events
""", ("events",))

# arrays
sql_query("sql_array", """
SELECT vec_id, label, size(embedding) AS dims FROM embeddings
""", """
SELECT vec_id, label, CAST(len(embedding) AS INTEGER) AS dims FROM embeddings
""", ("embeddings",))

# subqueries and CTEs
sql_query("sql_subquery_cte", """
WITH per_cust AS (SELECT o_custkey, count(*) AS n FROM orders GROUP BY o_custkey)
SELECT c.c_custkey, c.c_mktsegment, p.n,
       (SELECT max(o.o_totalprice) FROM orders o WHERE o.o_custkey = c.c_custkey) AS max_price
FROM customer c JOIN per_cust p ON p.o_custkey = c.c_custkey
WHERE EXISTS (SELECT 1 FROM orders o2 WHERE o2.o_custkey = c.c_custkey AND o2.o_orderstatus = 'F')
  AND p.n > (SELECT avg(n) FROM per_cust)
""", None, ("customer", "orders"))

# text tables: string sizes per language, labels coverage, conversation shape
sql_query("sql_text_profile", """
SELECT lang, count(*) AS n_docs, CAST(sum(n_chars) AS BIGINT) AS sum_chars, max(length(text)) AS max_len,
       CAST(sum(size(split(text, ' '))) AS BIGINT) AS n_tokens
FROM documents GROUP BY lang
""", """
SELECT lang, count(*) AS n_docs, CAST(sum(n_chars) AS BIGINT) AS sum_chars, max(length(text)) AS max_len,
       CAST(sum(len(string_split(text, ' '))) AS BIGINT) AS n_tokens
FROM documents GROUP BY lang
""", ("documents",))

sql_query("sql_labels_join", """
SELECT d.lang, count(*) AS n_docs, count(l.doc_id) AS n_labelled, CAST(sum(l.quality) AS BIGINT) AS n_quality,
       CAST(sum(l.toxic) AS BIGINT) AS n_toxic
FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id
GROUP BY d.lang
""", None, ("documents", "labels"))

sql_query("sql_conversations", """
SELECT conv_id, count(*) AS turns, min_by(role, turn) AS first_role,
       CAST(sum(length(text)) AS BIGINT) AS chars
FROM conversations GROUP BY conv_id
""", """
SELECT conv_id, count(*) AS turns, arg_min(role, turn) AS first_role,
       CAST(sum(length(text)) AS BIGINT) AS chars
FROM conversations GROUP BY conv_id
""", ("conversations",))

sql_query("sql_pages", """
SELECT parse_url(url, 'HOST') AS host, count(*) AS n_pages, CAST(sum(length(html)) AS BIGINT) AS html_chars
FROM pages GROUP BY parse_url(url, 'HOST')
""", """
SELECT regexp_extract(url, '^[a-zA-Z][a-zA-Z0-9+.-]*://([^/:?#]+)', 1) AS host, count(*) AS n_pages,
       CAST(sum(length(html)) AS BIGINT) AS html_chars
FROM pages GROUP BY 1
""", ("pages",))
