"""Enrollment spans, demographics and use of care."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from carelens.functions import formats
from carelens.operators import spans, summary
from carelens.registry.catalog import query
from carelens.registry.level2 import MESSY, messy
from carelens.registry.level3 import _FIVE
from carelens.registry.views import Data

MAXDATE = "2000-06-30"
_COVERS = {"m": "LOWER(medcov) = 'y'", "d": "LOWER(drugcov) = 'y'", "md": "LOWER(medcov) = 'y' AND LOWER(drugcov) = 'y'"}


# --- exclusions and periods -----------------------------------------------------------------


@query(
    "e1_exclude_patients",
    "SELECT patid, enr_start, enr_end FROM enr WHERE patid NOT IN (SELECT patid FROM dth)",
)
def _(d: Data) -> DataFrame:
    return spans.exclude(d("enr"), d("dth"), {"patid": "patid"}).select("patid", "enr_start", "enr_end")


@query(
    "e2_exclude_encounters",
    "SELECT patid, encounterid, adate FROM enc WHERE NOT EXISTS (SELECT 1 FROM del WHERE del.mpatid = enc.patid AND del.encounterid = enc.encounterid)",
)
def _(d: Data) -> DataFrame:
    on = {"patid": "mpatid", "encounterid": "encounterid"}
    return spans.exclude(d("enc"), d("del"), on).select("patid", "encounterid", "adate")


@query("e3_restrict_patients", "SELECT patid, enr_start, enr_end FROM enr WHERE patid IN (SELECT patid FROM dth)")
def _(d: Data) -> DataFrame:
    return spans.restrict(d("enr"), d("dth"), {"patid": "patid"}).select("patid", "enr_start", "enr_end")


_E4 = " UNION ALL ".join(
    f"SELECT '{k}' AS cov, patid, enr_start, enr_end FROM ({MESSY}) AS m_{k} WHERE {c}" for k, c in _COVERS.items()
)


@query("e4_by_coverage", _E4)
def _(d: Data) -> DataFrame:
    return spans.by_coverage(messy(d))


_LOW = "DATE '0001-01-01'"
_PERIODS = f"""WITH src AS (SELECT DISTINCT cov, patid, enr_start, enr_end FROM ({_E4}) AS e4),
  l AS (SELECT *, LAG(enr_end) OVER w AS le, ROW_NUMBER() OVER w AS rn FROM src
        WINDOW w AS (PARTITION BY cov, patid ORDER BY enr_start NULLS FIRST, enr_end NULLS FIRST)),
  f AS (SELECT *, SUM(CASE WHEN rn > 1 AND COALESCE(enr_start, {_LOW}) > COALESCE(le + 46, {_LOW}) THEN 1 ELSE 0 END)
          OVER (PARTITION BY cov, patid ORDER BY rn) AS period FROM l),
  periods AS (SELECT cov, patid, MIN(enr_start) AS enr_start, MAX(enr_end) AS enr_end FROM f GROUP BY cov, patid, period),
  md AS (SELECT patid, enr_start, enr_end FROM periods WHERE cov = 'md')
"""


def periods(d: Data, *kinds: str) -> DataFrame:
    return spans.bridge(spans.by_coverage(messy(d), kinds or ("m", "d", "md")), ["cov", "patid"])


def md(d: Data) -> DataFrame:
    return periods(d, "md").drop("cov")


@query("e5_bridge", _PERIODS + "SELECT * FROM periods")
def _(d: Data) -> DataFrame:
    return periods(d)


@query(
    "e6_merge_periods",
    f"""WITH src AS (SELECT DISTINCT patid, COALESCE(enr_start, enr_end) AS enr_start, COALESCE(enr_end, enr_start) AS enr_end FROM ({MESSY}) AS m
        WHERE enr_start IS NOT NULL OR enr_end IS NOT NULL),
      r AS (SELECT *, MAX(enr_end) OVER (PARTITION BY patid ORDER BY enr_start, enr_end ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS reach FROM src),
      f AS (SELECT *, SUM(CASE WHEN enr_start > reach + 1 THEN 1 ELSE 0 END) OVER (PARTITION BY patid ORDER BY enr_start, enr_end) AS period FROM r)
      SELECT patid, MIN(enr_start) AS enr_start, MAX(enr_end) AS enr_end FROM f GROUP BY patid, period""",
)
def _(d: Data) -> DataFrame:
    return spans.merge_periods(messy(d), ["patid"], "enr_start", "enr_end")


@query("e7_enrolled", _PERIODS + "SELECT DISTINCT cov, patid FROM periods")
def _(d: Data) -> DataFrame:
    return spans.enrolled(periods(d), ["cov", "patid"])


# --- enrollment summaries -------------------------------------------------------------------


@query("e8_length_by_record", _PERIODS + "SELECT CAST(enr_end - enr_start + 1 AS INTEGER) AS loe, COUNT(*) AS count FROM md GROUP BY 1")
def _(d: Data) -> DataFrame:
    return summary.length_by_record(md(d))


@query(
    "e8_length_by_patient",
    _PERIODS
    + """SELECT tloe, COUNT(*) AS count FROM (SELECT patid, CAST(SUM(enr_end - enr_start + 1) AS BIGINT) AS tloe FROM md GROUP BY patid) AS t GROUP BY 1""",
)
def _(d: Data) -> DataFrame:
    return summary.length_by_patient(md(d))


@query(
    "e9_periods_by_year",
    _PERIODS
    + """SELECT CAST(year AS INTEGER) AS year, COUNT(*) AS count FROM (SELECT UNNEST(RANGE(YEAR(enr_start), YEAR(enr_end) + 1)) AS year
      FROM md WHERE YEAR(enr_start) <= YEAR(enr_end)) AS y GROUP BY 1""",
)
def _(d: Data) -> DataFrame:
    return summary.periods_by_year(md(d))


def _maxdate():
    return F.lit(MAXDATE).cast("date")


@query(
    "e10_patient_totals",
    _PERIODS
    + f"""SELECT (SELECT COUNT(DISTINCT patid) FROM md) AS patients, (SELECT COUNT(*) FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY patid
      ORDER BY enr_start DESC NULLS LAST, enr_end DESC NULLS LAST) AS n FROM md) AS l WHERE n = 1 AND enr_end >= DATE '{MAXDATE}') AS active_patients""",
)
def _(d: Data) -> DataFrame:
    return summary.patient_totals(md(d), _maxdate())


@query(
    "e11_periods_per_patient",
    _PERIODS + "SELECT enr_count, COUNT(*) AS count FROM (SELECT patid, COUNT(*) AS enr_count FROM md GROUP BY patid) AS p GROUP BY 1",
)
def _(d: Data) -> DataFrame:
    return summary.periods_per_patient(md(d))


# --- demographics ---------------------------------------------------------------------------

_LAST = """last_md AS (SELECT * FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY patid ORDER BY enr_start DESC NULLS LAST, enr_end DESC NULLS LAST) AS n FROM md) AS q WHERE n = 1)"""
_PROFILE = (
    _PERIODS
    + f""", {_LAST}, profile AS (SELECT l.patid,
      CAST(FLOOR(((YEAR(enr_start) - YEAR(birth_date)) * 12 + MONTH(enr_start) - MONTH(birth_date) - CASE WHEN DAY(enr_start) < DAY(birth_date) THEN 1 ELSE 0 END) / 12) AS INTEGER) AS age,
      UPPER(sex) AS sex, enr_end >= DATE '{MAXDATE}' AS active, COUNT(*) AS n FROM last_md l JOIN dem ON dem.patid = l.patid WHERE birth_date IS NOT NULL GROUP BY ALL)
    """
)


def profile(d: Data) -> DataFrame:
    return summary.age_profile(md(d), d("dem"), _maxdate())


@query("d1_age_profile", _PROFILE + "SELECT * FROM profile")
def _(d: Data) -> DataFrame:
    return profile(d)


_EXTRA = [
    (formats.PEDIATRIC_1, "age >= 0 AND age < 19"),
    (formats.PEDIATRIC_2, "age >= 0 AND age < 22"),
    (formats.YOUNG_ADULT, "age >= 0 AND age < 26"),
    (formats.CHILDBEARING, "age BETWEEN 10 AND 54 AND sex = 'F'"),
]


@query(
    "d2_age_categories",
    _PROFILE
    + f""", cat AS (SELECT {_FIVE.format('age')} AS agecategory, active FROM profile WHERE age IS NOT NULL
      {" ".join(f"UNION ALL SELECT '{label}', active FROM profile WHERE {cond}" for label, cond in _EXTRA)}),
      sorted AS (SELECT * FROM (VALUES {", ".join(f"('{label}', {n})" for label, n in formats.AGE_SORT.items())}) v(label, sortorder))
      SELECT sortorder, agecategory, COUNT(*) AS count, COUNT(*) FILTER (WHERE active) AS active_count FROM cat JOIN sorted ON label = agecategory GROUP BY 1, 2""",
)
def _(d: Data) -> DataFrame:
    return summary.age_categories(profile(d))


_DEM = _PERIODS + ", pats AS (SELECT DISTINCT patid FROM md), e AS (SELECT dem.* FROM dem JOIN pats ON pats.patid = dem.patid) "


_DEM_COLUMNS = ["hispanic", "race", "sex", "postalcode"]


def enrolled_dem(d: Data) -> DataFrame:
    return summary.enrolled_rows(d("dem"), spans.enrolled(md(d), ["patid"]), _DEM_COLUMNS)


@query(
    "d3_category_counts",
    _DEM
    + """SELECT 'hispanic' AS variable, hispanic AS value, COUNT(*) AS count FROM e GROUP BY 2 UNION ALL SELECT 'race', race, COUNT(*) FROM e GROUP BY 2
      UNION ALL SELECT 'sex', sex, COUNT(*) FROM e GROUP BY 2""",
)
def _(d: Data) -> DataFrame:
    return summary.category_counts(enrolled_dem(d), ["hispanic", "race", "sex"])


# half of the nations have a known state
ZIPS = "SELECT CAST(10000 + n_nationkey AS STRING) AS postalcode, 'S' || CAST(n_regionkey AS STRING) AS statecode FROM nation WHERE n_regionkey <> 2"


@query(
    "d4_geography",
    _DEM
    + f""", z AS ({ZIPS}) SELECT CASE WHEN z.statecode IS NOT NULL THEN z.statecode WHEN e.postalcode IS NULL THEN '00' ELSE '99' END AS statecode,
      COUNT(*) AS count FROM e LEFT JOIN z ON z.postalcode = e.postalcode GROUP BY 1""",
)
def _(d: Data) -> DataFrame:
    return summary.geography(enrolled_dem(d), d.sql(ZIPS))


# --- use of care ----------------------------------------------------------------------------


def _inside_sql(cov: str, records: str, date: str) -> str:
    return f"""SELECT '{cov}' AS cov, n_records, COUNT(*) AS count FROM (SELECT r.patid, COUNT(*) AS n_records FROM ({records}) AS r
      JOIN periods p ON p.cov = '{cov}' AND p.patid = r.patid AND r.{date} BETWEEN p.enr_start AND p.enr_end GROUP BY r.patid) AS i GROUP BY ALL"""


@query("v1_dispensing", _PERIODS + " UNION ALL ".join(_inside_sql(c, "SELECT * FROM dis", "rxdate") for c in ("d", "md")))
def _(d: Data) -> DataFrame:
    return summary.records_in_enrollment(d("dis"), periods(d, "d", "md"), "rxdate", ["d", "md"])


@query(
    "v2_encounters",
    _PERIODS
    + _inside_sql(
        "md", "SELECT * FROM enc WHERE NOT EXISTS (SELECT 1 FROM del WHERE del.mpatid = enc.patid AND del.encounterid = enc.encounterid)", "adate"
    ),
)
def _(d: Data) -> DataFrame:
    kept = spans.exclude(d("enc"), d("del"), {"patid": "mpatid", "encounterid": "encounterid"})
    return summary.records_in_enrollment(kept, periods(d, "md"), "adate", ["md"])


@query("v3_labs", _PERIODS + _inside_sql("md", "SELECT patid, COALESCE(lab_dt, result_dt, order_dt) AS testdate FROM lab", "testdate"))
def _(d: Data) -> DataFrame:
    labs = summary.lab_dates(d("lab"))
    return summary.records_in_enrollment(labs, periods(d, "md"), "testdate", ["md"])


def _vitals_sql(prefix: bool) -> str:
    columns, parts, before = {"HGT": "ht", "WGT": "wt", "DIA": "diastolic", "SYS": "systolic"}, [], "TRUE"
    for name, c in columns.items():
        before = f"{before} AND {c} IS NOT NULL" if prefix else f"{c} IS NOT NULL"
        parts.append(f"SELECT '{name}' AS vs_type, patid, measure_date FROM vit WHERE {before}")
    return f"""{_PERIODS} SELECT vs_type, COUNT(DISTINCT v.patid) AS count FROM ({" UNION ALL ".join(parts)}) AS v
      JOIN md ON md.patid = v.patid AND v.measure_date BETWEEN md.enr_start AND md.enr_end GROUP BY 1"""


@query("v4_vitals_prefix", _vitals_sql(True))
def _(d: Data) -> DataFrame:
    return summary.vitals_in_enrollment(d("vit"), md(d), "prefix")


@query("v4_vitals_all", _vitals_sql(False))
def _(d: Data) -> DataFrame:
    return summary.vitals_in_enrollment(d("vit"), md(d), "all")


@query(
    "v5_deaths",
    _PERIODS
    + " UNION ALL ".join(
        f"SELECT '{c}' AS cov, COUNT(*) AS count FROM dth WHERE patid IN (SELECT patid FROM periods WHERE cov = '{c}')" for c in ("m", "md")
    ),
)
def _(d: Data) -> DataFrame:
    kinds = ["m", "md"]
    return summary.records_of_enrolled(d("dth"), spans.enrolled(periods(d, *kinds), ["cov", "patid"]), kinds)


@query(
    "v6_causes",
    _PERIODS
    + " UNION ALL ".join(
        f"""SELECT '{c}' AS cov, CASE WHEN n <= 4 THEN CAST(n AS VARCHAR) ELSE '>4' END AS cod_count, COUNT(*) AS count FROM
        (SELECT patid, COUNT(*) AS n FROM cod WHERE patid IN (SELECT patid FROM periods WHERE cov = '{c}') GROUP BY 1) AS x{c} GROUP BY ALL"""
        for c in ("m", "md")
    ),
)
def _(d: Data) -> DataFrame:
    return summary.causes_per_patient(d("cod"), spans.enrolled(periods(d, "m", "md"), ["cov", "patid"]))


@query("v7_count_by", "SELECT CAST(YEAR(rxdate) AS INTEGER) AS year, COUNT(*) AS count FROM dis GROUP BY 1")
def _(d: Data) -> DataFrame:
    return summary.count_by(d("dis"), F.year("rxdate").alias("year"))
