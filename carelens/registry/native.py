"""Operators straight on the given tables, without the domain views."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from carelens.operators import cross, keys, linkage, profile, rules, spans, summary
from carelens.registry.catalog import query
from carelens.registry.level3 import _percentile_sql, cross_tab_sql
from carelens.registry.views import Data


@query(
    "k1_native_lineitem",
    "SELECT 'LINEITEM' AS tabid, CAST(COALESCE(SUM(n - 1), 0) AS BIGINT) AS count_dup FROM (SELECT COUNT(*) AS n FROM lineitem GROUP BY l_orderkey, l_linenumber) AS g",
)
def _(d: Data) -> DataFrame:
    return keys.surplus_duplicates(d("lineitem"), ["l_orderkey", "l_linenumber"], "lineitem")


@query(
    "k2_native_lineitem",
    """SELECT l_orderkey, l_linenumber, l_partkey, l_quantity FROM (SELECT *, COUNT(*) OVER (PARTITION BY l_orderkey, l_linenumber) AS n FROM lineitem) AS w WHERE n > 1""",
)
def _(d: Data) -> DataFrame:
    out = ["l_orderkey", "l_linenumber", "l_partkey", "l_quantity"]
    return keys.duplicate_rows(d("lineitem").select(*out), ["l_orderkey", "l_linenumber"])


@query("k11_native_priority", "SELECT o_orderkey, o_orderpriority FROM orders WHERE o_orderpriority NOT IN ('1-URGENT', '2-HIGH')")
def _(d: Data) -> DataFrame:
    bad = rules.outside_domain("o_orderpriority", ["1-URGENT", "2-HIGH"])
    return rules.hits(d("orders"), bad).select("o_orderkey", "o_orderpriority")


@query("p4_native_contents", """
SELECT 'PART' AS tabid, COUNT(*) AS nobs, 'p_partkey' AS name, 1 AS varnum, 'N' AS type, 8 AS length FROM part
UNION ALL SELECT 'PART', COUNT(*), 'p_name', 2, 'C', CAST(MAX(LENGTH(p_name)) AS INTEGER) FROM part
UNION ALL SELECT 'PART', COUNT(*), 'p_brand', 3, 'C', CAST(MAX(LENGTH(p_brand)) AS INTEGER) FROM part
UNION ALL SELECT 'PART', COUNT(*), 'p_type', 4, 'C', CAST(MAX(LENGTH(p_type)) AS INTEGER) FROM part
UNION ALL SELECT 'PART', COUNT(*), 'p_size', 5, 'N', 8 FROM part
UNION ALL SELECT 'PART', COUNT(*), 'p_retailprice', 6, 'N', 8 FROM part""")
def _(d: Data) -> DataFrame:
    return profile.contents(d("part"), "part")


@query("x1_native_customers", "SELECT c_custkey FROM customer WHERE c_custkey NOT IN (SELECT user_id FROM events)")
def _(d: Data) -> DataFrame:
    return cross.not_in_reference(d("customer"), d("events"), {"c_custkey": "user_id"})


@query(
    "x12_native_dates",
    """SELECT a.user_id, COUNT(*) AS n_pairs FROM (SELECT user_id, CAST(ts AS DATE) AS d FROM events) AS a
       JOIN (SELECT o_custkey, CAST(o_orderdate AS DATE) AS d FROM orders) AS b ON a.user_id = b.o_custkey WHERE a.d > b.d GROUP BY 1
       UNION ALL SELECT user_id, COUNT(*) FROM events WHERE user_id NOT IN (SELECT o_custkey FROM orders) GROUP BY 1""",
)
def _(d: Data) -> DataFrame:
    seen = d("events").select("user_id", F.col("ts").cast("date").alias("d"))
    ordered = d("orders").select(F.col("o_custkey").alias("user_id"), F.col("o_orderdate").cast("date").alias("d"))
    return cross.date_order_pairs(seen, ordered, "d", "d", later=True, key="user_id")


@query(
    "x13_native_keys",
    """WITH ids AS (SELECT DISTINCT c_custkey AS id, 'c' AS t FROM customer UNION ALL SELECT DISTINCT o_custkey, 'o' FROM orders
        UNION ALL SELECT DISTINCT l_suppkey, 'l' FROM lineitem),
      w AS (SELECT id, CAST(COUNT(*) FILTER (WHERE t = 'c') AS VARCHAR) AS customer, CAST(COUNT(*) FILTER (WHERE t = 'o') AS VARCHAR) AS orders,
            CAST(COUNT(*) FILTER (WHERE t = 'l') AS VARCHAR) AS lineitem FROM ids GROUP BY id)
      SELECT customer, orders, lineitem, COUNT(*) AS count FROM w GROUP BY ALL""",
)
def _(d: Data) -> DataFrame:
    columns = {"customer": "c_custkey", "orders": "o_custkey", "lineitem": "l_suppkey"}
    return cross.presence_matrix({t: (d(t), c) for t, c in columns.items()})


_LINE_CLASSES = ["l_returnflag", "l_linestatus", "l_linenumber", "year"]
_LINES = "SELECT l_returnflag, l_linestatus, l_linenumber, strftime(l_shipdate, '%Y') AS year FROM lineitem"


@query("c9_native_lineitem", cross_tab_sql(_LINES, _LINE_CLASSES))
def _(d: Data) -> DataFrame:
    lines = d("lineitem").withColumn("year", F.date_format("l_shipdate", "yyyy"))
    return linkage.cross_tab(lines, _LINE_CLASSES)


@query(
    "s1_native_months",
    """WITH m AS (SELECT 'ORDERS' AS tabid, CAST(date_trunc('month', o_orderdate) AS DATE) AS month, COUNT(*) AS n FROM orders GROUP BY ALL
         UNION ALL SELECT 'LINEITEM', CAST(date_trunc('month', l_shipdate) AS DATE), COUNT(*) FROM lineitem GROUP BY ALL),
       q AS (SELECT *, ROW_NUMBER() OVER w AS nth, n / LEAD(n) OVER w >= 0.9 AS lo, n / LAG(n) OVER w >= 0.9 AS hi FROM m WINDOW w AS (PARTITION BY tabid ORDER BY month))
       SELECT tabid, MIN(month) FILTER (WHERE lo) AS mindate, last_day(MAX(month) FILTER (WHERE hi)) AS maxdate,
         CAST(MAX(nth) FILTER (WHERE hi) - MAX(nth) AS INTEGER) AS months_from_last FROM q GROUP BY tabid""",
)
def _(d: Data) -> DataFrame:
    return summary.completeness({"orders": (d("orders"), "o_orderdate"), "lineitem": (d("lineitem"), "l_shipdate")}, 0.9)


@query("s3_native_shipdate", _percentile_sql("(SELECT CAST(l_shipdate AS DATE) AS shipdate FROM lineitem) AS s", "shipdate"))
def _(d: Data) -> DataFrame:
    counts = d("lineitem").groupBy(F.col("l_shipdate").cast("date").alias("shipdate")).agg(F.count("*").alias("n"))
    return summary.date_percentiles(counts, ["shipdate"])


# every event holds its user for as many days as its id says
SPANS = "SELECT user_id, CAST(ts AS DATE) AS first_day, CAST(ts AS DATE) + CAST(event_id % 3 AS INT) AS last_day FROM events"


@query(
    "e6_native_event_spans",
    f"""WITH src AS (SELECT DISTINCT * FROM ({SPANS}) AS s),
      r AS (SELECT *, MAX(last_day) OVER (PARTITION BY user_id ORDER BY first_day, last_day ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS reach FROM src),
      f AS (SELECT *, SUM(CASE WHEN first_day > reach + 1 THEN 1 ELSE 0 END) OVER (PARTITION BY user_id ORDER BY first_day, last_day) AS p FROM r)
      SELECT user_id, MIN(first_day) AS first_day, MAX(last_day) AS last_day FROM f GROUP BY user_id, p""",
)
def _(d: Data) -> DataFrame:
    return spans.merge_periods(d.sql(SPANS), ["user_id"], "first_day", "last_day")


@query(
    "x10_native_event_coverage",
    f"""SELECT user_id, day, COUNT(*) AS n, (SELECT COUNT(*) FROM ({SPANS}) AS s WHERE s.user_id = q.user_id AND q.day BETWEEN s.first_day AND s.last_day) AS open_spans
      FROM (SELECT user_id, CAST(ts AS DATE) AS day FROM events) AS q GROUP BY user_id, day""",
)
def _(d: Data) -> DataFrame:
    seen = d("events").select("user_id", F.col("ts").cast("date").alias("d"))
    days = spans.day_coverage(seen, d.sql(SPANS), ["user_id"], "d", start="first_day", end="last_day")
    return days.select("user_id", "day", "n", "open_spans")


@query("a1_native_orders", """WITH n AS (SELECT COUNT(*) AS n0, COUNT(*) FILTER (WHERE NOT o_totalprice < 50000) AS n1,
  COUNT(*) FILTER (WHERE NOT o_totalprice < 50000 AND NOT o_orderstatus = 'P') AS n2 FROM orders)
  SELECT 'orders' AS analysisgrp, '1' AS level, n1 AS num, n0 - n1 AS removed FROM n UNION ALL SELECT 'orders', '2', n2, n1 - n2 FROM n""")
def _(d: Data) -> DataFrame:
    steps = [F.col("o_totalprice") < 50000, F.col("o_orderstatus") == "P"]
    return summary.attrition(d("orders"), steps, "orders")


@query("d3_native_categories", """SELECT 'c_mktsegment' AS variable, c_mktsegment AS value, COUNT(*) AS count FROM customer GROUP BY 2
  UNION ALL SELECT 'c_nationkey', CAST(c_nationkey AS VARCHAR), COUNT(*) FROM customer GROUP BY 2""")
def _(d: Data) -> DataFrame:
    cells = d("customer").groupBy("c_mktsegment", "c_nationkey").agg(F.count("*").alias("n"))
    return summary.category_counts(cells, ["c_mktsegment", "c_nationkey"])
