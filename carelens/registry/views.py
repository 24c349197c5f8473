"""Domain tables as views over the given tables; the same text runs on Spark and in the SQL twin."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession

from carelens.operators.spans import PARTS
from carelens.sources.tables import Tables, read_tables, table

BASE = (
    "region nation customer supplier part orders lineitem events documents embeddings pages"
    " benchmark labels conversations"
).split()

VIEWS = {
    "mil": """
WITH b AS (
  SELECT l.l_orderkey AS k, l.l_linenumber AS n, l.l_partkey AS p, o.o_custkey AS c,
         CAST(o.o_orderdate AS DATE) AS d, g.m AS m
  FROM lineitem l JOIN orders o ON o.o_orderkey = l.l_orderkey
  JOIN (SELECT l_orderkey AS mk, COUNT(*) AS m FROM lineitem GROUP BY l_orderkey) g ON g.mk IS NOT DISTINCT FROM l.l_orderkey)
SELECT CASE WHEN k % 13 = 0 THEN NULL ELSE 'M' || CAST(c AS STRING) END AS mpatid,
       CASE WHEN k % 7 = 0 OR (k + n) % 11 = 0 THEN NULL
            ELSE 'C' || CAST(k AS STRING) || '-' || CAST(n % 4 AS STRING) END AS cpatid,
       d AS adate,
       CASE WHEN k % 3 = 0 THEN CAST(NULL AS DATE) ELSE d + CAST(k % 5 AS INT) END AS ddate,
       'E' || CAST(k AS STRING) AS encounterid,
       CASE k % 4 WHEN 0 THEN 'IP' WHEN 1 THEN 'ED' WHEN 2 THEN 'AV' ELSE NULL END AS enctype,
       CAST(CASE WHEN k % 10 = 0 THEN 9 WHEN k % 10 = 1 THEN m + 1
                 WHEN k % 10 = 2 AND m > 1 THEN m - 1 WHEN k % 10 = 3 THEN 1 ELSE m END AS INT) AS birth_type,
       CAST(8 + c % 50 AS INT) AS age,
       CASE p % 3 WHEN 0 THEN 'F' WHEN 1 THEN 'M' ELSE 'O' END AS sex,
       CASE WHEN p % 17 = 0 THEN CAST(NULL AS DATE) ELSE d + CAST(p % 9 - 4 AS INT) END AS cbirth_date,
       d - CAST((8 + c % 50) * 365 AS INT) AS mbirth_date,
       CASE k % 6 WHEN 0 THEN 'RE' WHEN 1 THEN 'SI' WHEN 2 THEN 'LA' WHEN 3 THEN 'N1' WHEN 4 THEN 'ZZ' ELSE NULL END AS matchmethod,
       CASE WHEN p % 19 = 0 THEN CAST(NULL AS DATE) ELSE d + CAST(p % 400 - 10 AS INT) END AS cenr_start
FROM b
""",
    "enr": """
WITH b AS (SELECT o_orderkey AS k, o_custkey AS c, CAST(o_orderdate AS DATE) - CAST(o_orderkey % 40 AS INT) AS s FROM orders)
SELECT 'M' || CAST(c AS STRING) AS patid, s AS enr_start,
       CASE WHEN k % 37 = 0 THEN s - 1 ELSE s + CAST(20 + k % 200 AS INT) END AS enr_end,
       CASE WHEN k % 9 = 0 THEN 'N' ELSE 'Y' END AS medcov,
       CASE WHEN k % 5 = 0 THEN 'N' ELSE 'Y' END AS drugcov,
       CASE WHEN k % 2 = 0 THEN 'Y' ELSE 'N' END AS chart
FROM b WHERE c % 8 <> 0
""",
    "dem": """
SELECT 'M' || CAST(c_custkey AS STRING) AS patid,
       CASE WHEN c_custkey % 23 = 0 THEN CAST(NULL AS DATE) ELSE DATE '1930-01-01' + CAST((c_custkey * 97) % 24000 AS INT) END AS birth_date,
       CASE c_custkey % 4 WHEN 0 THEN 'F' WHEN 1 THEN 'M' WHEN 2 THEN 'A' ELSE 'U' END AS sex,
       CASE c_custkey % 3 WHEN 0 THEN 'Y' WHEN 1 THEN 'N' ELSE 'U' END AS hispanic,
       CAST(c_custkey % 6 AS STRING) AS race,
       CASE WHEN c_custkey % 29 = 0 THEN NULL ELSE CAST(10000 + c_nationkey AS STRING) END AS postalcode
FROM customer
""",
    "enc": """
SELECT 'M' || CAST(o_custkey AS STRING) AS patid, 'E' || CAST(o_orderkey AS STRING) AS encounterid,
       CASE WHEN o_orderkey % 31 = 0 THEN CAST(NULL AS DATE) ELSE CAST(o_orderdate AS DATE) END AS adate,
       CASE o_orderkey % 4 WHEN 0 THEN 'IP' WHEN 1 THEN 'AV' WHEN 2 THEN 'AV' ELSE 'ED' END AS enctype
FROM orders
""",
    "dis": """
SELECT 'M' || CAST(o.o_custkey AS STRING) AS patid, CAST(l.l_shipdate AS DATE) AS rxdate
FROM lineitem l JOIN orders o ON o.o_orderkey = l.l_orderkey
""",
    "lab": """
SELECT 'M' || CAST(o.o_custkey AS STRING) AS patid,
       CASE WHEN l.l_linenumber % 3 = 0 THEN CAST(l.l_shipdate AS DATE) END AS lab_dt,
       CASE WHEN l.l_linenumber % 3 = 1 THEN CAST(l.l_shipdate AS DATE) + 1 END AS result_dt,
       CASE WHEN l.l_linenumber % 5 <> 0 THEN CAST(l.l_shipdate AS DATE) - 2 END AS order_dt
FROM lineitem l JOIN orders o ON o.o_orderkey = l.l_orderkey
""",
    "vit": """
SELECT 'M' || CAST(o.o_custkey AS STRING) AS patid, CAST(l.l_shipdate AS DATE) AS measure_date,
       CASE WHEN l.l_partkey % 5 = 0 THEN NULL ELSE l.l_quantity END AS ht,
       CASE WHEN l.l_partkey % 7 = 0 THEN NULL ELSE l.l_quantity * 2 END AS wt,
       CASE WHEN l.l_linenumber % 3 = 0 THEN NULL ELSE l.l_quantity + 60 END AS diastolic,
       CASE WHEN l.l_linenumber % 4 = 0 THEN NULL ELSE l.l_quantity + 100 END AS systolic
FROM lineitem l JOIN orders o ON o.o_orderkey = l.l_orderkey
""",
    "dth": """
SELECT 'M' || CAST(c_custkey AS STRING) AS patid FROM customer WHERE c_custkey % 11 = 0
""",
    "cod": """
SELECT 'M' || CAST(o_custkey AS STRING) AS patid FROM orders WHERE o_custkey % 11 = 0
""",
    "del": """
SELECT 'M' || CAST(o_custkey AS STRING) AS mpatid, 'E' || CAST(o_orderkey AS STRING) AS encounterid
FROM orders WHERE o_orderkey % 12 <> 0
""",
    "inf": """
SELECT DISTINCT 'C' || CAST(l_orderkey AS STRING) || '-' || CAST(l_linenumber % 4 AS STRING) AS cpatid
FROM lineitem WHERE l_orderkey % 14 <> 1
""",
    "prior_flags": """
SELECT 'MIL_3_00_00-0_39' || CAST(n_nationkey % 10 AS STRING) AS flagid, 'Warn' AS flagtype, CAST(SUM(n_nationkey * 7) AS BIGINT) AS count
FROM nation GROUP BY 1, 2
""",
}


def _names(text: str) -> list[str]:
    return re.findall(r"\b(?:FROM|JOIN)\s+([a-z_]+)", text)


class Data:
    """The given tables and the views over them, by name."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir
        self._known: Tables = {}

    def __call__(self, name: str) -> DataFrame:
        if name not in self._known:
            self._known[name] = self._view(name) if name in VIEWS else self._base(name)
        return self._known[name]

    def many(self, *names: str) -> Tables:
        return {n: self(n) for n in names}

    def _base(self, name: str) -> DataFrame:
        return table(read_tables(self.spark, {name: f"{self.sf_dir}/{name}.parquet"}), name)

    def _view(self, name: str) -> DataFrame:
        return self.sql(VIEWS[name])

    def sql(self, text: str) -> DataFrame:
        names = _names(text)
        # Lines meet their orders in a fixed number of tasks; sorts of many packed partitions in one would grow with the tables.
        dealt = {"lineitem": "l_orderkey", "orders": "o_orderkey"} if {"lineitem", "orders"} <= set(names) else {}
        for used in names:
            if used in BASE or used in VIEWS:
                df = self(used).repartition(PARTS, dealt[used]) if used in dealt else self(used)
                df.createOrReplaceTempView(used)
        if dealt:
            # A line that met its order has a key, so a plain join finds the same and stays where the lines are dealt; the
            # null-safe one has a shuffle of its own, in as many tasks as its packed bytes ask for.
            text = text.replace("IS NOT DISTINCT FROM l.l_orderkey", "= l.l_orderkey")
        return self.spark.sql(text)


def with_views(body: str) -> str:
    """The SQL with the views it uses as leading common table expressions."""
    body = body.strip()
    used = [n for n in dict.fromkeys(_names(body)) if n in VIEWS]
    if not used:
        return body
    ctes = ", ".join(f"{n} AS ({VIEWS[n].strip()})" for n in used)
    if re.match(r"WITH\s", body):
        return f"WITH {ctes}, {body[5:].lstrip()}"
    return f"WITH {ctes} {body}"
