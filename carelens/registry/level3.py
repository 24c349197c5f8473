"""Level 3: linkage checks, cross tabs, completeness window, percentiles."""

from __future__ import annotations

from itertools import combinations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from carelens.functions import formats
from carelens.functions.rulesets import flag
from carelens.operators import compare, linkage, summary
from carelens.operators import flags as fl
from carelens.registry.catalog import query
from carelens.registry.views import Data
from carelens.sources import tables

_LINKED = "mpatid IS NOT NULL AND cpatid IS NOT NULL"
_US = "COALESCE(strftime({}, '%m/%d/%Y'), '.')"


# --- linkage checks -------------------------------------------------------------------------

_TAIL = "not consistent with number of linkages; confirmation required"
_C1 = f"""SELECT 'MIL_3_00_00-0_37' || birth_type AS flagid, 'Birth_Type (' || birth_type || ') {_TAIL}' AS flag_descr,
  'MPatID (' || mpatid || '), EncounterID (' || encounterid || '), Adate (' || {_US.format('adate')} || '), Birth_type (' || birth_type
    || '):Birth_Type value {_TAIL}' AS message, 'Warn' AS flag_type, 'N' AS abort_yn, mpatid, adate, encounterid, birth_type, crows
  FROM (SELECT mpatid, adate, encounterid, birth_type, COUNT(DISTINCT cpatid) AS crows FROM mil
        WHERE {_LINKED} AND birth_type BETWEEN 1 AND 5 GROUP BY ALL) AS g WHERE crows <> birth_type"""


@query("c1_birth_type_linkage", _C1)
def _(d: Data) -> DataFrame:
    return linkage.birth_type_linkage(d("mil"))


_IDS = ["mpatid", "cpatid", "encounterid", "adate"]
_MOTHER = f"'MPatid (' || COALESCE(mpatid, '') || '), EncounterID (' || encounterid || '), Adate (' || {_US.format('adate')}"
_GAPS = {
    "394": (
        "birth_type BETWEEN 2 AND 8 AND cpatid IS NULL",
        _MOTHER + " || '), Birth_Type (' || birth_type || '): No linkages were found; confirmation required'",
    ),
    "396": (
        "cpatid IS NULL AND mpatid IS NOT NULL",
        _MOTHER + " || '): No linkage to infant was found; confirmation required'",
    ),
    "397": (
        "cpatid IS NOT NULL AND mpatid IS NULL",
        f"'CPatid (' || cpatid || '), CBirth_Date (' || {_US.format('cbirth_date')}"
        " || '): No linkage to mother/delivery was found; confirmation required'",
    ),
}


def _gap_sql(check: str) -> str:
    cond, message = _GAPS[check]
    return f"""SELECT 'MIL_3_00_00-0_{check}' AS flagid, '{flag(check).descr}' AS flag_descr, {message} AS message,
      'Warn' AS flag_type, 'N' AS abort_yn, {", ".join(_IDS)} FROM mil WHERE {cond}"""


def _register_gap(name: str, check: str) -> None:
    @query(name, _gap_sql(check))
    def _(d: Data) -> DataFrame:
        rows = d("mil").where(linkage.linkage_predicates()[check])
        return rows.select(*fl.flag_struct(flag(check), linkage.linkage_message(check)), *_IDS)


_register_gap("c2_multiple_birth_unlinked", "394")
_register_gap("c3_mother_unlinked", "396")
_register_gap("c4_infant_unlinked", "397")


@query("c2_c4_one_pass", " UNION ALL ".join(_gap_sql(c) for c in _GAPS))
def _(d: Data) -> DataFrame:
    return linkage.linkage_gaps(d("mil"), _IDS)


_MSG = " UNION ALL ".join(
    f"SELECT flagid, message, flag_descr, flag_type, abort_yn FROM ({q}) AS q{i}"
    for i, q in enumerate([_C1, *[_gap_sql(c) for c in _GAPS]])
)


def _l3_flags(d: Data) -> DataFrame:
    keep = ["flagid", "message", "flag_descr", "flag_type", "abort_yn"]
    mil = d("mil")
    return linkage.birth_type_linkage(mil).select(*keep).unionByName(linkage.linkage_gaps(mil, []).select(*keep))


@query("c5_message_counts", f"SELECT *, COUNT(*) AS count FROM ({_MSG}) AS m GROUP BY ALL")
def _(d: Data) -> DataFrame:
    return fl.count_messages(_l3_flags(d))


_L3 = f"SELECT flagid, abort_yn, flag_type, flag_descr, COUNT(*) AS count FROM ({_MSG}) AS m GROUP BY ALL"


# A count that equals the mark, beside another; and an empty table's mark beside a larger count.
_MARKS = """SELECT 'MIL_1_05_00-0_121' AS flagid, 'N' AS abort_yn, 'Warn' AS flag_type, 'Invalid data value' AS flag_descr, CAST(99999 + 0 * COUNT(*) AS BIGINT) AS count, FALSE AS whole FROM mil
  UNION ALL SELECT 'MIL_1_05_00-0_121', 'N', 'Warn', 'Invalid data value', CAST(5 + 0 * COUNT(*) AS BIGINT), FALSE FROM mil
  UNION ALL SELECT 'MIL_1_00_00-0_101', 'Y', 'Abort', 'Table is not populated', CAST(99999 + 0 * COUNT(*) AS BIGINT), TRUE FROM mil
  UNION ALL SELECT 'MIL_1_00_00-0_101', 'Y', 'Abort', 'Table is not populated', CAST(150000 + COUNT(*) AS BIGINT), FALSE FROM mil"""


@query("c6_roll_up", f"""SELECT flagid, abort_yn, flag_type, flag_descr, CAST(CASE WHEN BOOL_OR(whole) THEN 99999 ELSE SUM(count) END AS BIGINT) AS count, BOOL_OR(whole) AS whole FROM (
  SELECT *, FALSE AS whole FROM ({_L3}) AS l
  UNION ALL SELECT 'MIL_1_06_00-0_126', 'N', 'Warn', 'Age value outside range 10-54', COUNT(*), FALSE FROM mil WHERE age < 10 OR age > 54 HAVING COUNT(*) > 0
  UNION ALL SELECT 'MIL_1_06_00-0_126', 'N', 'Warn', 'Age value outside range 10-54', COUNT(*), FALSE FROM mil WHERE age > 54 HAVING COUNT(*) > 0
  UNION ALL SELECT * FROM ({_MARKS}) AS m) AS u GROUP BY 1, 2, 3, 4""")
def _(d: Data) -> DataFrame:
    mil, f = d("mil"), flag("126")
    ages = [fl.with_flag(mil.where(c).select(), f) for c in ("age < 10 or age > 54", "age > 54")]
    return fl.roll_up([*[fl.count_rows(x) for x in (_l3_flags(d), *ages)], d.sql(_MARKS)])


# --- derived columns and cross tabs ---------------------------------------------------------

_AGE = """CASE WHEN mpatid IS NULL THEN 'Infants' WHEN age BETWEEN 10 AND 19 THEN '10-19' WHEN age BETWEEN 20 AND 44 THEN '20-44'
  WHEN age BETWEEN 45 AND 54 THEN '45-54' ELSE 'Other' END AS agegroup"""
_DIFF = """CASE WHEN cbirth_date - adate IS NULL THEN '09:NA' WHEN cbirth_date - adate <= -31 THEN '00:< -30 days'
  WHEN cbirth_date - adate <= -11 THEN '01:-11 through -30 days' WHEN cbirth_date - adate <= -4 THEN '02:-4 through -10 days'
  WHEN cbirth_date - adate <= -1 THEN '03:-1 through -3 days' WHEN cbirth_date - adate = 0 THEN '04:0 days'
  WHEN cbirth_date - adate <= 3 THEN '05:1 through 3 days' WHEN cbirth_date - adate <= 10 THEN '06:4 through 10 days'
  WHEN cbirth_date - adate <= 30 THEN '07:11 through 30 days' ELSE '08:> 30 days' END AS daysdiff"""
# dates moved by 17 years, so that both ICD versions occur
_MOVED = "SELECT * REPLACE (CAST(adate + INTERVAL 17 YEAR AS DATE) AS adate, CAST(ddate + INTERVAL 17 YEAR AS DATE) AS ddate, CAST(cbirth_date + INTERVAL 17 YEAR AS DATE) AS cbirth_date) FROM mil"
_C7 = f"""SELECT mpatid, cpatid, encounterid, CASE WHEN {_LINKED} THEN 'L' WHEN mpatid IS NOT NULL THEN 'M' WHEN cpatid IS NOT NULL THEN 'C' END AS linkagestatus,
  birth_type, strftime(COALESCE(adate, cbirth_date), '%Y') AS year, strftime(COALESCE(adate, cbirth_date), '%Y-%m') AS yearmonth,
  CASE WHEN COALESCE(ddate, adate, cbirth_date) > DATE '2015-09-30' THEN '0' ELSE '9' END AS icd_ver, {_AGE}, enctype, sex, {_DIFF}, matchmethod FROM ({_MOVED})"""


def moved(d: Data) -> DataFrame:
    dates = ("adate", "ddate", "cbirth_date")
    return d("mil").withColumns({c: F.add_months(c, 17 * 12) for c in dates})


@query("c7_linkage_columns", _C7)
def _(d: Data) -> DataFrame:
    return linkage.linkage_columns(moved(d))


_C8 = f"""SELECT r.mpatid, r.encounterid, CASE WHEN COALESCE(n, 0) >= 1 THEN 'L' ELSE 'M' END AS linkagestatus, birth_type,
  strftime(adate, '%Y') AS year, strftime(adate, '%Y-%m') AS yearmonth, CASE WHEN adate > DATE '2015-09-30' THEN '0' ELSE '9' END AS icd_ver,
  {_AGE.replace("mpatid", "r.mpatid")}, enctype, COALESCE(n, 0) AS infantslinked
  FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY mpatid, encounterid ORDER BY adate NULLS FIRST, birth_type NULLS FIRST, age NULLS FIRST, enctype NULLS FIRST) AS nth
        FROM ({_MOVED}) WHERE mpatid IS NOT NULL) AS r
  LEFT JOIN (SELECT mpatid, encounterid, COUNT(DISTINCT cpatid) AS n FROM mil WHERE mpatid IS NOT NULL GROUP BY ALL) AS l
    ON l.mpatid = r.mpatid AND l.encounterid IS NOT DISTINCT FROM r.encounterid
  WHERE nth = 1"""


@query("c8_delivery_columns", _C8)
def _(d: Data) -> DataFrame:
    return linkage.delivery_columns(moved(d))


def cross_tab_sql(source: str, classes: list[str], depth: int = 3) -> str:
    """GROUPING SETS over every choice of at most `depth` columns, with level and names."""
    sets = [c for k in range(depth + 1) for c in combinations(classes, k)]
    grouped = ", ".join(f"({', '.join(s)})" for s in sets)
    bits = " + ".join(f"(1 - GROUPING({c})) * {1 << (len(classes) - 1 - i)}" for i, c in enumerate(classes))
    names = ", ".join(f"CASE WHEN GROUPING({c}) = 0 THEN '{c}' END" for c in classes)
    return f"""SELECT CASE WHEN t < 100 THEN LPAD(CAST(t AS VARCHAR), 3, '0') ELSE CAST(t AS VARCHAR) END AS level,
      CASE WHEN t = 0 THEN 'Overall' ELSE n END AS level_desc, {", ".join(classes)}, count
      FROM (SELECT {bits} AS t, CONCAT_WS('    ', {names}) AS n, {", ".join(classes)}, COUNT(*) AS count FROM ({source})
            GROUP BY GROUPING SETS ({grouped})) AS g"""


@query("c9_cross_tab_all", cross_tab_sql(_C7, linkage.ALL_CLASSES))
def _(d: Data) -> DataFrame:
    return linkage.cross_tab(linkage.linkage_columns(moved(d)), linkage.ALL_CLASSES)


@query("c9_cross_tab_deliveries", cross_tab_sql(_C8, linkage.DELIVERY_CLASSES))
def _(d: Data) -> DataFrame:
    return linkage.cross_tab(linkage.delivery_columns(moved(d)), linkage.DELIVERY_CLASSES)


_FLAGS3 = ["l_returnflag", "l_linestatus", "l_linenumber"]


@query(
    "c10_levels",
    f"""SELECT level, level_desc, CAST(SUM(count) AS BIGINT) AS n_rows, COUNT(*) AS n_cells
      FROM ({cross_tab_sql('lineitem', _FLAGS3, 2)}) AS x GROUP BY ALL""",
)
def _(d: Data) -> DataFrame:
    tab = linkage.cross_tab(d("lineitem"), _FLAGS3, 2)
    return tab.groupBy("level", "level_desc").agg(F.sum("count").alias("n_rows"), F.count("*").alias("n_cells"))


@query(
    "c11_load_comparison",
    f"""WITH new AS ({_L3}), old AS (SELECT flagid, 'N' AS abort_yn, flagtype AS flag_type, 'prior' AS flag_descr, count FROM prior_flags
        UNION ALL SELECT flagid, abort_yn, flag_type, flag_descr, CAST(count / 3 AS BIGINT) FROM new WHERE flagid < 'MIL_3_00_00-0_375')
      SELECT COALESCE(n.flagid, o.flagid) AS flagid, CASE WHEN n.flagid IS NULL THEN o.abort_yn ELSE n.abort_yn END AS abort_yn,
        CASE WHEN n.flagid IS NULL THEN o.flag_type ELSE n.flag_type END AS flag_type, CASE WHEN n.flagid IS NULL THEN o.flag_descr ELSE n.flag_descr END AS flag_descr,
        o.count AS count_old, n.count AS count_new, n.count - o.count AS diff_count,
        (n.count - o.count) / NULLIF(CAST(o.count AS DOUBLE), 0) * 100 AS pctchg_count, CAST(NULL AS VARCHAR) AS sign_off, CAST(NULL AS VARCHAR) AS comment
      FROM new n FULL OUTER JOIN old o ON n.flagid = o.flagid""",
)
def _(d: Data) -> DataFrame:
    new = fl.count_rows(_l3_flags(d))
    prior = d("prior_flags").select(
        "flagid", F.lit("N").alias("abort_yn"), F.col("flagtype").alias("flag_type"), F.lit("prior").alias("flag_descr"), "count"
    )
    older = new.where("flagid < 'MIL_3_00_00-0_375'").withColumn("count", F.round(F.col("count") / 3).cast("long"))
    return compare.load_comparison(new, prior.unionByName(older))


# --- completeness window --------------------------------------------------------------------

_MONTHS = {"enc": "adate", "dis": "rxdate", "vit": "measure_date", "enr": "enr_start"}


def _window_sql() -> str:
    monthly = " UNION ALL ".join(
        f"SELECT '{t.upper()}' AS tabid, CAST(date_trunc('month', {c}) AS DATE) AS month, COUNT(*) AS n FROM {t} WHERE {c} IS NOT NULL GROUP BY ALL"
        for t, c in _MONTHS.items()
    )
    return f"""WITH m AS ({monthly}), q AS (SELECT *, ROW_NUMBER() OVER w AS nth, n / LEAD(n) OVER w >= 0.8 AS lo, n / LAG(n) OVER w >= 0.8 AS hi
        FROM m WINDOW w AS (PARTITION BY tabid ORDER BY month)),
      windows AS (SELECT tabid, MIN(month) FILTER (WHERE lo) AS mindate, last_day(MAX(month) FILTER (WHERE hi)) AS maxdate,
        CAST(MAX(nth) FILTER (WHERE hi) - MAX(nth) AS INTEGER) AS months_from_last FROM q GROUP BY tabid)
    """


def _windows(d: Data) -> DataFrame:
    return summary.completeness({t: (d(t), c) for t, c in _MONTHS.items()})


@query("s1_completeness", _window_sql() + "SELECT * FROM windows")
def _(d: Data) -> DataFrame:
    return _windows(d)


@query(
    "s2_overall_window",
    _window_sql()
    + "SELECT MAX(mindate) AS dp_mindate, MIN(maxdate) AS dp_maxdate, "
    + ", ".join(f"MAX({c}) FILTER (WHERE tabid = '{t.upper()}') AS {t}_{c}" for t in ("enc", "dis", "vit") for c in ("mindate", "maxdate"))
    + " FROM windows WHERE tabid IN ('ENC', 'DIS', 'VIT')",
)
def _(d: Data) -> DataFrame:
    return summary.overall_window(_windows(d), ["enc", "dis", "vit"])


# --- percentiles, sums, formats -------------------------------------------------------------


def _percentile_sql(view: str, column: str) -> str:
    return f"""SELECT '{column}' AS variable, COUNT({column}) AS n, MIN({column}) AS min, """ + ", ".join(
        f"DATE '1970-01-01' + CAST(FLOOR(QUANTILE_CONT({column} - DATE '1970-01-01', {p})) AS INTEGER) AS {name}"
        for name, p in summary.PERCENTILES.items()
    ) + f", MAX({column}) AS max FROM {view}"


@query("s3_date_percentiles", _percentile_sql("dis", "rxdate"))
def _(d: Data) -> DataFrame:
    counts = d("dis").groupBy("rxdate").agg(F.count("*").alias("n"))
    return summary.date_percentiles(counts, ["rxdate"])


def _rank_sql(column: str, view: str) -> str:
    """Percentile by position: the mean of the two middle rows where the share falls between rows."""
    parts = []
    for name, p in summary.PERCENTILES.items():
        k = f"(n * {round(p * 100)})"
        low = f"CAST(CASE WHEN {k} % 100 = 0 THEN {k} / 100 ELSE FLOOR({k} / 100) + 1 END AS BIGINT)"
        high = f"CAST(FLOOR({k} / 100) + 1 AS BIGINT)"
        parts.append(f"DATE '1970-01-01' + CAST(FLOOR((v[{low}] + v[LEAST({high}, n)]) / 2) AS INTEGER) AS {name}")
    return f"""WITH s AS (SELECT LIST({column} - DATE '1970-01-01' ORDER BY {column}) FILTER (WHERE {column} IS NOT NULL) AS v, COUNT({column}) AS n,
      MIN({column}) AS lo, MAX({column}) AS hi FROM {view})
      SELECT '{column}' AS variable, n, lo AS min, {", ".join(parts)}, hi AS max FROM s"""


@query("s3_date_percentiles_by_rank", _rank_sql("adate", "enc"))
def _(d: Data) -> DataFrame:
    counts = d("enc").groupBy("adate").agg(F.count("*").alias("n"))
    return summary.date_percentiles_by_rank(counts, "adate")


@query(
    "s4_class_sums",
    """SELECT enctype, sex, CAST(SUM(birth_type) AS BIGINT) AS birth_type, CAST(SUM(age) AS BIGINT) AS age FROM mil GROUP BY enctype, sex""",
)
def _(d: Data) -> DataFrame:
    return summary.class_sums(d("mil"), ["enctype", "sex"], ["birth_type", "age"])


_YEARS = """CASE WHEN {0} IS NULL THEN '00. Missing' WHEN {0} < 0 THEN '00. Negative' WHEN {0} < 2 THEN '01. 0-1 yrs' WHEN {0} < 5 THEN '02. 2-4 yrs'
  WHEN {0} < 10 THEN '03. 5-9 yrs' WHEN {0} < 15 THEN '04. 10-14 yrs' WHEN {0} < 19 THEN '05. 15-18 yrs' WHEN {0} < 22 THEN '06. 19-21 yrs'
  WHEN {0} < 45 THEN '07. 22-44 yrs' WHEN {0} < 65 THEN '08. 45-64 yrs' WHEN {0} < 75 THEN '09. 65-74 yrs' ELSE '10. 75+ yrs' END"""


@query("s5_bucketed_sums", f"SELECT {_YEARS.format('age')} AS age, CAST(SUM(birth_type) AS BIGINT) AS birth_type FROM mil GROUP BY 1")
def _(d: Data) -> DataFrame:
    return summary.bucketed_sums(d("mil"), "age", formats.AGE_YEARS, ["birth_type"])


# The labels of the published formats.
_BIRTH = """CASE WHEN {0} IS NULL THEN '.' WHEN {0} = 0 THEN '0= Unspecified number of live births' WHEN {0} = 1 THEN '1= 1 live birth'
  WHEN {0} = 2 THEN '2= 2 live births' WHEN {0} = 3 THEN '3= 3 live births' WHEN {0} = 4 THEN '4= 4 live births'
  WHEN {0} BETWEEN 5 AND 8 THEN '5-8= Multiple live births, unspecified number'
  WHEN {0} = 9 THEN '9= Conflicting code(s) for number of live births' ELSE CAST({0} AS VARCHAR) END"""
_MAGE = """CASE WHEN {0} IS NULL THEN '.' WHEN {0} BETWEEN 10 AND 19 THEN '10-19' WHEN {0} BETWEEN 20 AND 44 THEN '20-44'
  WHEN {0} BETWEEN 45 AND 54 THEN '45-54' ELSE CAST({0} AS VARCHAR) END"""
_FIVE = """CASE WHEN {0} IS NULL THEN NULL WHEN {0} < 0 THEN '<0' WHEN {0} <= 1 THEN '00-01' WHEN {0} <= 4 THEN '02-04'
  WHEN {0} <= 9 THEN '05-09'
  WHEN {0} <= 14 THEN '10-14'
  WHEN {0} <= 19 THEN '15-19'
  WHEN {0} <= 24 THEN '20-24'
  WHEN {0} <= 29 THEN '25-29'
  WHEN {0} <= 34 THEN '30-34'
  WHEN {0} <= 39 THEN '35-39'
  WHEN {0} <= 44 THEN '40-44'
  WHEN {0} <= 49 THEN '45-49'
  WHEN {0} <= 54 THEN '50-54'
  WHEN {0} <= 59 THEN '55-59'
  WHEN {0} <= 64 THEN '60-64'
  WHEN {0} <= 69 THEN '65-69'
  WHEN {0} <= 74 THEN '70-74'
  WHEN {0} <= 79 THEN '75-79'
  ELSE '80+' END"""
# numbers from -40 up, with gaps that are missing
_NUMBERS = """SELECT CASE WHEN l_partkey % 31 = 0 THEN NULL ELSE CAST(l_partkey % 500 - 40 AS INTEGER) END AS x FROM lineitem"""


@query(
    "s6_formats",
    f"""SELECT x, {_YEARS.format('x')} AS age_years, {_FIVE.format('x')} AS five_year_age, {_MAGE.format('x')} AS mother_age,
      {_BIRTH.format('x')} AS birth_type, CASE WHEN x IS NULL THEN NULL WHEN x <= 1 THEN '1' WHEN x <= 4 THEN CAST(x AS VARCHAR) ELSE '>4' END AS record_count,
      CASE WHEN x IS NULL THEN '00. Missing' WHEN x < 0 THEN '01. < 0 days' WHEN x <= 30 THEN '02. 0-30 days' WHEN x <= 60 THEN '03. 31-60 days'
        WHEN x <= 120 THEN '04. 61-120 days' WHEN x <= 180 THEN '05. 121-180 days' WHEN x <= 270 THEN '06. 181-270 days'
        WHEN x <= 365 THEN '07. 271-365 days' ELSE '08. >= 366 days' END AS age_days,
      {_DIFF.replace('cbirth_date - adate', 'x')}, COUNT(*) AS count FROM ({_NUMBERS}) AS n GROUP BY ALL""",
)
def _(d: Data) -> DataFrame:
    x = F.when(F.col("l_partkey") % 31 != 0, (F.col("l_partkey") % 500 - 40).cast("int"))
    counted = d("lineitem").select(x.alias("x")).groupBy("x").agg(F.count("*").alias("count"))
    c = F.col("x")
    return counted.select(
        "x", "count",
        formats.age_years(c).alias("age_years"), formats.five_year_age(c).alias("five_year_age"),
        formats.mother_age(c).alias("mother_age"), formats.birth_type(c).alias("birth_type"),
        formats.record_count(c).alias("record_count"), formats.age_days(c).alias("age_days"),
        formats.days_diff(c).alias("daysdiff"),
    )


# --- linkage rates --------------------------------------------------------------------------

# ids to leave out: every mother and infant of the first customers
_EXCLUDED = "SELECT 'M' || CAST(s_suppkey AS STRING) AS patid FROM supplier UNION ALL SELECT 'C' || CAST(s_suppkey AS STRING) || '-1' FROM supplier"
_M1 = f"""SELECT mpatid, encounterid, enctype, {_BIRTH.format('birth_type')} AS birth_type, {_MAGE.format('age')} AS agegroup,
  COALESCE(strftime(adate, '%Y'), '.') AS year, COUNT(DISTINCT cpatid) AS infantslinked FROM mil
  WHERE mpatid IS NOT NULL AND COALESCE(mpatid, '') NOT IN (SELECT patid FROM ({_EXCLUDED}) AS x)
    AND COALESCE(cpatid, '') NOT IN (SELECT patid FROM ({_EXCLUDED}) AS x) GROUP BY 1, 2, 3, 4, 5, 6"""


def _deliveries(d: Data) -> DataFrame:
    from carelens.operators.spans import exclude

    out = d.sql(_EXCLUDED)
    kept = exclude(exclude(d("mil"), out, {"mpatid": "patid"}), out, {"cpatid": "patid"})
    return linkage.deliveries(kept)


@query("m1_deliveries", _M1)
def _(d: Data) -> DataFrame:
    return _deliveries(d)


def _rate_sql(sort: int, variable: str) -> str:
    value = "'overall'" if variable == "overall" else variable
    return f"""SELECT {sort} AS tablesort, '{variable}' AS variable, {value} AS value, COUNT(*) AS deliveries,
      COUNT(*) FILTER (WHERE infantslinked > 0) AS infantslinked, COUNT(*) FILTER (WHERE infantslinked > 0) / COUNT(*) AS linkagerate FROM m1 GROUP BY 3"""


@query(
    "m2_linkage_rates",
    f"WITH m1 AS ({_M1}) "
    + " UNION ALL ".join(_rate_sql(i, v) for i, v in enumerate(["overall", "agegroup", "enctype", "year", "birth_type"], 1)),
)
def _(d: Data) -> DataFrame:
    return linkage.linkage_rates(_deliveries(d))


# --- attrition and small helpers ------------------------------------------------------------


@query(
    "a1_attrition_rows",
    """WITH s AS (SELECT COALESCE(mpatid IS NULL, FALSE) AS x1, COALESCE(cpatid IS NULL, FALSE) AS x2, COALESCE(cbirth_date < adate, FALSE) AS x3 FROM mil),
       n AS (SELECT COUNT(*) AS n0, COUNT(*) FILTER (WHERE NOT x1) AS n1, COUNT(*) FILTER (WHERE NOT x1 AND NOT x2) AS n2,
             COUNT(*) FILTER (WHERE NOT x1 AND NOT x2 AND NOT x3) AS n3 FROM s)
       SELECT 'linked' AS analysisgrp, '1' AS level, n1 AS num, n0 - n1 AS removed FROM n UNION ALL SELECT 'linked', '2', n2, n1 - n2 FROM n
       UNION ALL SELECT 'linked', '3', n3, n2 - n3 FROM n""",
)
def _(d: Data) -> DataFrame:
    steps = [F.col("mpatid").isNull(), F.col("cpatid").isNull(), F.col("cbirth_date") < F.col("adate")]
    return summary.attrition(d("mil"), steps, "linked")


@query(
    "a1_attrition_distinct",
    """WITH n AS (SELECT (SELECT COUNT(*) FROM (SELECT DISTINCT mpatid, adate FROM mil)) AS n0,
         (SELECT COUNT(*) FROM (SELECT DISTINCT mpatid, adate FROM mil WHERE mpatid IS NOT NULL)) AS n1,
         (SELECT COUNT(*) FROM (SELECT DISTINCT mpatid, adate FROM mil WHERE mpatid IS NOT NULL AND age >= 12)) AS n2)
       SELECT 'pregnancy' AS analysisgrp, '1' AS level, n1 AS num, n0 - n1 AS removed FROM n UNION ALL SELECT 'pregnancy', '2', n2, n1 - n2 FROM n""",
)
def _(d: Data) -> DataFrame:
    steps = [F.col("mpatid").isNull(), F.col("age") < 12]
    return summary.attrition(d("mil"), steps, "pregnancy", ["mpatid", "adate"])


@query("a2_lower_columns", "SELECT c_custkey, lower(c_name) AS c_name, lower(c_mktsegment) AS c_mktsegment FROM customer")
def _(d: Data) -> DataFrame:
    named = d("customer").select("c_custkey", "c_name", "c_mktsegment")
    return tables.lower_columns(named, "c_name", "c_mktsegment")
