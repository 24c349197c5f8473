"""Metadata consistency, comparison of result tables, logs."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from carelens.operators import compare, linkage, profile
from carelens.operators import flags as fl
from carelens.registry.catalog import query
from carelens.registry.level1 import contents_sql
from carelens.registry.level3 import _GAPS, _IDS, _gap_sql
from carelens.registry.views import Data
from carelens.sources import logs, tables

# Fixed values throughout this file: test groups, grades, sources and result texts of the published consistency report.

# --- table names ----------------------------------------------------------------------------

ACTUAL = "SELECT upper(event_type) || CAST(user_id % 4 AS STRING) AS memname FROM events"
EXPECTED = """SELECT DISTINCT upper(event_type) || 'TABLE' AS variable, event_type AS value FROM events
UNION ALL SELECT DISTINCT upper(role) || 'TABLE', role FROM conversations"""


@query(
    "t1_table_names",
    f"""SELECT 'SCDM TABLE NAMES' AS test_group, CASE WHEN a.m IS NULL THEN 'FAIL' ELSE 'PASS' END AS grade,
      'Check if SCDM table names match between QA results and actual tables' AS details,
      CASE WHEN a.m IS NULL THEN 'Expected name for ' || variable || ' is ' || LOWER(value) || ' but  was found.'
           ELSE 'Expected and actual names match for ' || variable || ': ' || a.m || '.' END AS results
      FROM ({EXPECTED}) AS e LEFT JOIN (SELECT DISTINCT LOWER(REGEXP_REPLACE(memname, '[0-9]+$', '')) AS m FROM ({ACTUAL}) AS t) AS a ON a.m = LOWER(value)""",
)
def _(d: Data) -> DataFrame:
    return compare.table_names(d.sql(EXPECTED), d.sql(ACTUAL))


# --- header and detail attributes -----------------------------------------------------------

# one "table" per event type and user group, as two catalogs describe it: the second one lacks some,
# has others, and differs in type or by half an hour; a full hour does not count
_HEAD = "SELECT event_type || CAST(user_id % 30 AS STRING) AS memname, {0} AS memtype, COUNT(*) AS nobs, {1} AS crdate, date_trunc('second', MAX(ts)) AS modate FROM events WHERE {2} GROUP BY event_type, user_id % 30"
_FIRST = "date_trunc('second', MIN(ts))"
HEAD_A = _HEAD.format("'data'", _FIRST, "user_id % 30 > 2")
HEAD_B = _HEAD.format(
    "CASE WHEN event_type = 'click' THEN 'view' ELSE 'data' END",
    f"{_FIRST} + CASE event_type WHEN 'view' THEN INTERVAL '1' HOUR WHEN 'error' THEN INTERVAL '30' MINUTE ELSE INTERVAL '0' MINUTE END",
    "user_id % 30 < 25",
)


def _head_sql() -> str:
    src = "CASE WHEN a.memname IS NOT NULL AND b.memname IS NOT NULL THEN 'SCDM and QA' WHEN a.memname IS NOT NULL THEN 'SCDM Only' ELSE 'QA Only' END"
    parts = []
    for c, cond in {
        "memtype": "a.memtype <> b.memtype",
        "nobs": "FALSE",
        "crdate": "a.crdate <> b.crdate AND ABS(EPOCH(a.crdate) - EPOCH(b.crdate)) <> 3600",
        "modate": "a.modate <> b.modate AND ABS(EPOCH(a.modate) - EPOCH(b.modate)) <> 3600",
    }.items():
        parts.append(
            f"SELECT {src} AS sources, COALESCE(a.memname, b.memname) AS memname, '{c}' AS variable, CAST(a.{c} AS VARCHAR) AS scdm_value,"
            f" CAST(b.{c} AS VARCHAR) AS qa_value FROM a FULL OUTER JOIN b ON a.memname = b.memname WHERE a.memname IS NULL OR b.memname IS NULL OR ({cond})"
        )
    return f"a AS ({HEAD_A}), b AS ({HEAD_B}), header AS ({' UNION ALL '.join(parts)})"


def _header(d: Data) -> DataFrame:
    return compare.header_differences(d.sql(HEAD_A), d.sql(HEAD_B))


@query("t2_header_differences", f"WITH {_head_sql()} SELECT * FROM header")
def _(d: Data) -> DataFrame:
    return _header(d)


# column contents of three tables against contents of altered copies; one table is on one side only
_ALTERED = {
    "mil": ("sex", "mpatid", "REPLACE(mpatid, 'M', 'MM')"),
    "dem": ("race", "postalcode", "SUBSTRING(postalcode, 2, 4)"),
}


def _altered(d: Data, view: str) -> DataFrame:
    drop, column, expr = _ALTERED[view]
    return d(view).withColumn(column, F.expr(expr)).drop(drop)


def _details_sql() -> str:
    cols = "LOWER(tabid) AS memname, name, type, length"
    a = " UNION ALL ".join(f"SELECT {cols} FROM ({contents_sql(t)}) AS a_{t}" for t in ("mil", "dem", "enr"))
    b = []
    for view, (drop, column, expr) in _ALTERED.items():
        changed = contents_sql(view, drop=(drop,)).replace(f"CAST({column} AS VARCHAR)", expr)
        b.append(f"SELECT {cols} FROM ({changed}) AS b_{view}")
    src = "CASE WHEN a.name IS NOT NULL AND b.name IS NOT NULL THEN 'SCDM and QA' WHEN a.name IS NOT NULL THEN 'SCDM Only' ELSE 'QA Only' END"
    parts = [
        f"SELECT {src} AS sources, memname, name, '{c}' AS variable, CAST(a.{c} AS VARCHAR) AS scdm_value, CAST(b.{c} AS VARCHAR) AS qa_value"
        f" FROM da a FULL OUTER JOIN db b USING (memname, name) WHERE memname <> 'enr' AND a.{c} IS DISTINCT FROM b.{c}"
        for c in ("type", "length")
    ]
    return f"""da AS ({a}), db AS ({" UNION ALL ".join(b)}), detail AS ({" UNION ALL ".join(parts).replace("a.name", "a.type").replace("b.name", "b.type")})"""


def _detail(d: Data) -> tuple[DataFrame, DataFrame]:
    def both(frames: dict[str, DataFrame]) -> DataFrame:
        found = tables.union_all([profile.contents(t, n) for n, t in frames.items()])
        return found.select(F.lower("tabid").alias("memname"), "name", "type", "length", "nobs")

    def head(c: DataFrame) -> DataFrame:
        day = F.lit("2024-01-01").cast("timestamp")
        return c.groupBy("memname").agg(F.max("nobs").alias("nobs")).select(
            "memname", F.lit("data").alias("memtype"), "nobs", day.alias("crdate"), day.alias("modate")
        )

    a, b = both(d.many("mil", "dem", "enr")), both({v: _altered(d, v) for v in _ALTERED})
    header = compare.header_differences(head(a), head(b))
    return header, compare.detail_differences(a, b, header, ["type", "length"])


@query("t3_detail_differences", f"WITH {_details_sql()} SELECT * FROM detail /* FROM mil FROM dem FROM enr */")
def _(d: Data) -> DataFrame:
    return _detail(d)[1]


@query(
    "t4_overall_grade",
    f"""WITH {_details_sql()}, names AS (SELECT memname FROM detail UNION SELECT 'enr') SELECT 'FAIL' AS grade,
      'Data dictionary tables between SCDM and QA do NOT match for these tables: ' || STRING_AGG(memname, ' ' ORDER BY memname) AS results FROM names""",
)
def _(d: Data) -> DataFrame:
    return compare.overall_grade(*_detail(d))


LABEL_A = "SELECT upper(event_type) || CAST(user_id % 3 AS STRING) AS memname, 'ETL' || CAST(length(event_type) AS STRING) AS memlabel FROM events"
LABEL_B = "SELECT event_type AS memname, CASE WHEN event_type = 'error' THEN 'etl9' ELSE 'etl' || CAST(length(event_type) AS STRING) END AS memlabel FROM events WHERE event_type <> 'view'"


@query(
    "t5_label_check",
    f"""WITH a AS (SELECT DISTINCT LOWER(REGEXP_REPLACE(memname, '[0-9]+$', '')) AS memname, LOWER(memlabel) AS x FROM ({LABEL_A}) AS p),
      e AS (SELECT DISTINCT LOWER(REGEXP_REPLACE(memname, '[0-9]+$', '')) AS memname, LOWER(memlabel) AS y FROM ({LABEL_B}) AS q)
      SELECT memname, CASE WHEN x IS NOT DISTINCT FROM y THEN 'PASS' ELSE 'FAIL' END AS grade,
        CASE WHEN x IS NOT DISTINCT FROM y THEN 'Expected and actual labels match: ' || x
             ELSE 'Expected label is ' || COALESCE(y, '') || ' but ' || COALESCE(x, '') || ' was found.' END AS results FROM e FULL OUTER JOIN a USING (memname)""",
)
def _(d: Data) -> DataFrame:
    return compare.label_check(d.sql(LABEL_A), d.sql(LABEL_B))


# --- result tables --------------------------------------------------------------------------

_KEYS = ["flagid", *_IDS]


def _results(d: Data) -> tuple[DataFrame, DataFrame]:
    """The linkage flags, and a second run that lost, gained, changed and repeated some; and took no id for an empty one."""
    mil = d("mil")
    expected = linkage.linkage_gaps(mil, [*_IDS, "age", "sex", "birth_type"])
    expected = _twice(expected, "age = 21")
    lost = expected.where("age <> 15 and flagid <> 'MIL_3_00_00-0_397'")
    changed = lost.withColumns(
        {
            "abort_yn": F.when(F.col("birth_type") == 4, "Y").otherwise(F.col("abort_yn")),
            "message": F.when(F.col("sex") == "F", "reworded").otherwise(F.col("message")),
            "cpatid": F.when(F.col("age") == 30, F.coalesce("cpatid", F.lit(""))).otherwise(F.col("cpatid")),
        }
    )
    gained = fl.with_flag(mil.where("birth_type = 9"), _GAINED).select(*changed.columns)
    changed = _twice(changed, "age = 22").unionByName(gained)
    return expected.drop("age", "sex", "birth_type"), changed.drop("age", "sex", "birth_type")


def _twice(df: DataFrame, where: str) -> DataFrame:
    """df with some rows repeated, made from one reading of it."""
    copies = F.when(F.expr(where), F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))
    return df.select("*", F.explode(copies).alias("_copy")).drop("_copy")


_GAINED = fl.Flag("121", 1, "05", "Invalid data value")


def _results_sql() -> str:
    more = ", age, sex, birth_type FROM mil WHERE"
    gaps = " UNION ALL ".join(_gap_sql(c).replace(" FROM mil WHERE", more) for c in _GAPS)
    fields = {"flag_descr": "strict", "flag_type": "strict", "abort_yn": "strict", "message": "message"}
    cols = ", ".join(["flagid", "flag_descr", "message", "flag_type", "abort_yn", *_IDS])
    ids = ", ".join("CASE WHEN age = 30 THEN COALESCE(cpatid, '') ELSE cpatid END AS cpatid" if c == "cpatid" else c for c in _IDS)
    keys = ", ".join(_KEYS)
    key = " || '|' || ".join(f"COALESCE(CAST({k} AS VARCHAR), '(null)')" for k in _KEYS)
    same = " AND ".join(f"d.{k} IS NOT DISTINCT FROM k.{k}" for k in _KEYS)
    values = " UNION ALL ".join(f"SELECT {keys}, '{kind}' AS kind, '{f}' AS field, {f} AS value, e, a FROM t WHERE e <> a" for f, kind in fields.items())
    return f"""WITH g AS ({gaps}), e0 AS (SELECT * FROM g UNION ALL SELECT * FROM g WHERE age = 21),
      c0 AS (SELECT flagid, flag_descr, CASE WHEN sex = 'F' THEN 'reworded' ELSE message END AS message, flag_type,
        CASE WHEN birth_type = 4 THEN 'Y' ELSE abort_yn END AS abort_yn, {ids}, age FROM e0 WHERE age <> 15 AND flagid <> 'MIL_3_00_00-0_397'),
      b0 AS (SELECT {cols} FROM c0 UNION ALL SELECT {cols} FROM c0 WHERE age = 22
        UNION ALL SELECT 'MIL_1_05_00-0_121', 'Invalid data value', '', 'Warn', 'N', {", ".join(_IDS)} FROM mil WHERE birth_type = 9),
      t AS (SELECT {cols}, CAST(SUM(x) AS BIGINT) AS e, CAST(SUM(y) AS BIGINT) AS a
        FROM (SELECT {cols}, 1 AS x, 0 AS y FROM e0 UNION ALL SELECT {cols}, 0, 1 FROM b0) GROUP BY {cols}),
      k AS (SELECT {keys}, CAST(SUM(e) AS BIGINT) AS e, CAST(SUM(a) AS BIGINT) AS a FROM t GROUP BY {keys}),
      d AS (SELECT {keys}, kind, field, value, CAST(SUM(e) AS BIGINT) AS e, CAST(SUM(a) AS BIGINT) AS a FROM ({values}) GROUP BY ALL HAVING SUM(e) <> SUM(a)),
      f AS (SELECT flagid, CAST(SUM(e) AS BIGINT) AS e, CAST(SUM(a) AS BIGINT) AS a FROM k GROUP BY flagid),
      diffs AS (
        SELECT CASE WHEN a = 0 THEN 'missing' WHEN e = 0 THEN 'unexpected' ELSE 'rows' END AS kind, {key} AS key, '' AS field, CAST(NULL AS VARCHAR) AS value, e AS n_expected, a AS n_actual FROM k WHERE e <> a
        UNION ALL SELECT d.kind, {key.replace("CAST(", "CAST(d.")}, field, value, d.e, d.a FROM d JOIN k ON {same} WHERE k.e > 0 AND k.a > 0
        UNION ALL SELECT CASE WHEN a = 0 THEN 'flagid_expected_only' ELSE 'flagid_actual_only' END, flagid, 'flagid', flagid, e, a FROM f WHERE e = 0 OR a = 0) """


@query("t6_result_differences", _results_sql() + "SELECT * FROM diffs")
def _(d: Data) -> DataFrame:
    return compare.result_differences(*_results(d), _KEYS)


@query(
    "t6_is_match",
    _results_sql()
    + """SELECT COUNT(*) FILTER (WHERE kind <> 'message') = 0 AS is_match, COUNT(*) FILTER (WHERE kind = 'missing') AS missing,
      COUNT(*) FILTER (WHERE kind = 'unexpected') AS unexpected,
      COUNT(*) FILTER (WHERE kind = 'rows') AS rows, COUNT(*) FILTER (WHERE kind = 'strict') AS strict,
      COUNT(*) FILTER (WHERE kind = 'message') AS message, COUNT(*) FILTER (WHERE kind LIKE 'flagid%') AS flagid FROM diffs""",
)
def _(d: Data) -> DataFrame:
    return compare.is_match(compare.result_differences(*_results(d), _KEYS))


@query(
    "t7_canonical",
    "SELECT o_orderkey AS order_key, o_custkey AS cust_id, CAST(CAST(o_orderdate AS DATE) AS VARCHAR) AS order_date, o_orderstatus AS abort_yn FROM orders",
)
def _(d: Data) -> DataFrame:
    raw = d("orders").select(
        F.col("o_orderkey").alias("OrderKey"), F.col("o_custkey").alias("CustID"),
        F.col("o_orderdate").alias("OrderDate"), F.col("o_orderstatus").alias("AbortYN"),
    )
    return compare.canonical(raw)


# --- logs -----------------------------------------------------------------------------------

# the event stream written as program logs: one log per user group, the event id as line number
LOG_LINES = """SELECT 'log' || CAST(user_id % 7 AS STRING) AS logname, event_id + 1 AS logline_number,
  CASE event_type
    WHEN 'click' THEN CASE event_id % 3 WHEN 0 THEN 'MPRINT(MAC' || CAST(user_id % 5 AS STRING) || '):   data x; set y;'
                                        WHEN 1 THEN 'mprint(load' || CAST(user_id % 11 AS STRING) || '): * missing values;' ELSE '   plain text' END
    WHEN 'error' THEN CASE event_id % 3 WHEN 0 THEN 'ERROR: File not found' WHEN 1 THEN 'ERROR: (Package) bad input' ELSE 'Errors were found' END
    WHEN 'view' THEN CASE event_id % 5 WHEN 0 THEN 'NOTE: Invalid data in line 3' WHEN 1 THEN 'NOTE: 12 observations read'
                                       WHEN 2 THEN 'NOTE: Missing values were generated' WHEN 3 THEN 'NOTE: the value "invalid" was read'
                                       ELSE 'Note: data step stopped due to looping' END
    WHEN 'signup' THEN CASE event_id % 2 WHEN 0 THEN 'WARNING: Variable not found' ELSE 'WARNING: (package) check input' END
    ELSE 'x note' END AS logline
FROM events"""
_NOTE = " OR ".join(
    f"(t LIKE '%{n}%'" + (""" AND t NOT LIKE '%"invalid"%' AND t NOT LIKE '%''invalid''%' AND t NOT LIKE '%(invalid)%'""" if n == "invalid" else "") + ")"
    for n in logs.NOTES
)


def _classified_sql(lines: str) -> str:
    return f"""WITH w AS (SELECT *, LOWER(logline) AS t, LOWER(SPLIT_PART(TRIM(logline), ' ', 1)) AS w1, LOWER(SPLIT_PART(TRIM(logline), ' ', 2)) AS w2 FROM ({lines}) AS s),
      m AS (SELECT *, CASE WHEN w1 LIKE 'mprint%' THEN SUBSTRING(w1, 8, LENGTH(w1) - 9) END AS mac,
        CASE WHEN w1 LIKE '%warning%' AND w2 LIKE '%package%' THEN 'Package Warning' WHEN w1 LIKE '%error%' AND w2 LIKE '%package%' THEN 'Package Error'
             WHEN REGEXP_MATCHES(w1, '\\berror\\b') THEN 'SAS Error' WHEN REGEXP_MATCHES(w1, '\\bwarning\\b') THEN 'SAS Warning'
             WHEN REGEXP_MATCHES(w1, '\\bnote\\b') THEN 'SAS Note' END AS des FROM w WHERE LEFT(w1, 4) IN ('note', 'erro', 'warn', 'mpri')),
      f AS (SELECT *, LAST_VALUE(mac IGNORE NULLS) OVER o AS macro, LAST_VALUE(des IGNORE NULLS) OVER o AS description FROM m
        WINDOW o AS (PARTITION BY logname ORDER BY logline_number ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)),
      l AS (SELECT CASE WHEN description = 'SAS Note' AND t NOT LIKE '%data step stopped due to looping%' AND ({_NOTE}) THEN 5
        WHEN des = 'Package Warning' THEN 4 WHEN des = 'Package Error' THEN 2 WHEN des = 'SAS Error' THEN 1 WHEN des = 'SAS Warning' THEN 3 END AS level, * FROM f)
      SELECT level, description, logname, logline_number, logline, macro FROM l WHERE level IS NOT NULL"""


@query("t8_log_lines", _classified_sql(LOG_LINES))
def _(d: Data) -> DataFrame:
    return logs.classify_lines(d.sql(LOG_LINES))


# the documents as logs, each line behind a word that its number and its document decide
_SPOKEN = """CASE (doc_id + n) % 6 WHEN 0 THEN 'NOTE: ' WHEN 1 THEN 'ERROR: (Package) ' WHEN 2 THEN 'MPRINT(M' || CAST(doc_id % 9 AS STRING) || '):  '
  WHEN 3 THEN 'WARNING: ' WHEN 4 THEN 'NOTE: converted ' ELSE '' END || line AS logline"""
_DOC_LINES = f"""SELECT 'doc' || CAST(doc_id AS VARCHAR) AS logname, CAST(n AS BIGINT) AS logline_number, {_SPOKEN.replace("STRING", "VARCHAR")}
  FROM (SELECT doc_id, unnest(ls) AS line, generate_subscripts(ls, 1) AS n FROM (SELECT doc_id, string_split(text, chr(10)) AS ls FROM documents) AS a) AS b"""


@query("t8_document_lines", _classified_sql(_DOC_LINES))
def _(d: Data) -> DataFrame:
    split = d("documents").select("doc_id", F.posexplode(F.split("text", "\n", -1)).alias("i", "line"))
    numbered = split.withColumn("n", F.col("i") + 1)
    named = [F.concat(F.lit("doc"), F.col("doc_id").cast("string")).alias("logname"), F.col("n").cast("long").alias("logline_number")]
    return logs.classify_lines(numbered.select(*named, F.expr(_SPOKEN)))
