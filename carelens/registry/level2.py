"""Level 2: keys, row rules, spans, cross-table checks."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from carelens.functions.rulesets import (
    BIRTH_TYPES,
    LINKED_METHODS,
    UNLINKED_METHODS,
    VARIABLE_RULES,
    Flag,
    VariableRule,
    flag,
    flags_frame,
    rules_frame,
)
from carelens.operators import cross, keys, linkage, profile, rules, spans
from carelens.operators import flags as fl
from carelens.registry.catalog import query
from carelens.registry.level1 import _compliance_sql, contents_sql
from carelens.registry.views import Data
from carelens.sources import tables

IDS = ["mpatid", "cpatid", "adate", "encounterid"]
_IDS = ", ".join(IDS)
_LINKED = "mpatid IS NOT NULL AND cpatid IS NOT NULL"


# --- keys -----------------------------------------------------------------------------------


def _surplus_sql(table: str, tabid: str, cols: str) -> str:
    return f"""SELECT '{tabid}' AS tabid, CAST(COUNT(*) - (SELECT COUNT(*) FROM (SELECT DISTINCT {cols} FROM {table})) AS BIGINT)
      AS count_dup FROM {table}"""


@query(
    "k1_surplus_duplicates",
    " UNION ALL ".join(
        [
            _surplus_sql("mil", "MIL", "mpatid, cpatid, adate"),
            _surplus_sql("enr", "ENR", "patid, enr_start, enr_end, medcov, drugcov, chart"),
            _surplus_sql("dis", "DIS", "patid, rxdate"),
            _surplus_sql("cod", "COD", "patid"),
        ]
    ),
)
def _(d: Data) -> DataFrame:
    on = {"mil": IDS[:3], "enr": spans.SPAN_KEYS, "dis": ["patid", "rxdate"], "cod": ["patid"]}
    return tables.union_all([keys.surplus_duplicates(d(t), k, t) for t, k in on.items()])


_K2 = {
    "211": ["mpatid", "cpatid", "adate"],
    "217": ["mpatid", "adate", "encounterid"],
    "218": ["mpatid", "adate"],
    "219": ["cpatid"],
}


def _dup_sql(cols: list[str], where: str = "TRUE", out: str = _IDS) -> str:
    by = ", ".join(cols)
    extra = "".join(f", {c}" for c in cols if c not in IDS)
    return f"""SELECT {out}{extra} FROM (SELECT *, COUNT(*) OVER (PARTITION BY {by}) AS n_dup FROM mil WHERE {where}) WHERE n_dup > 1"""


def _dup_rows(df: DataFrame, cols: list[str]) -> DataFrame:
    return df.select(*IDS, *[c for c in cols if c not in IDS])


def _register_k2(check: str, cols: list[str]) -> None:
    where = " AND ".join(f"{c} IS NOT NULL" for c in cols)

    @query(f"k2_duplicate_rows_{check}", _dup_sql(cols, where))
    def _(d: Data) -> DataFrame:
        return _dup_rows(keys.duplicate_rows(d("mil"), cols, nulls_equal=False), cols)


for _check, _cols in _K2.items():
    _register_k2(_check, _cols)


@query("k2_duplicate_rows_nulls_equal", _dup_sql(["mpatid", "cpatid", "adate"]))
def _(d: Data) -> DataFrame:
    return keys.duplicate_rows(d("mil"), ["mpatid", "cpatid", "adate"]).select(*IDS)


@query("k3_distinct_keys", "SELECT DISTINCT patid, enr_start, enr_end, medcov, drugcov, chart FROM enr")
def _(d: Data) -> DataFrame:
    return keys.distinct_keys(d("enr"), spans.SPAN_KEYS)


_K4 = ["mpatid", "encounterid", "adate", "mbirth_date"]
_K5 = ["mpatid", "cpatid", "encounterid", "enctype"]
_K7A = ["cpatid", "cbirth_date", "sex"]
_K7B = ["cpatid", "sex", "enctype", "cbirth_date"]


@query("k4_unlinked_duplicates", _dup_sql(_K4, "mpatid IS NOT NULL AND cpatid IS NULL"))
def _(d: Data) -> DataFrame:
    return _dup_rows(keys.unlinked_duplicates(d("mil"), _K4), _K4)


@query("k5_linked_duplicates", _dup_sql(_K5, _LINKED))
def _(d: Data) -> DataFrame:
    return _dup_rows(keys.linked_duplicates(d("mil"), _K5), _K5)


def _conflict_sql(variables: list[str]) -> str:
    dup, within, last = ", ".join(variables[:3]), variables[:-1], variables[-1]
    join = " AND ".join(f"a.{c} IS NOT DISTINCT FROM b.{c}" for c in within)
    extra = "".join(f", a.{c}" for c in variables if c not in IDS)
    return f"""WITH dupout AS (SELECT * FROM (SELECT *, COUNT(*) OVER (PARTITION BY {dup}) AS n_dup FROM mil WHERE {_LINKED}) WHERE n_dup > 1),
      t AS (SELECT {", ".join(within)}, COUNT(DISTINCT {last}) AS v FROM dupout GROUP BY ALL HAVING COUNT(DISTINCT {last}) > 1)
      SELECT {", ".join(f"a.{c}" for c in IDS)}{extra} FROM dupout a JOIN t b ON {join}"""


_K6 = {"4": ["mpatid", "adate", "encounterid", "sex"], "3": ["mpatid", "enctype", "sex"], "2": ["cpatid", "sex"]}


def _register_k6(n: str, variables: list[str]) -> None:
    @query(f"k6_linked_value_conflict_{n}", _conflict_sql(variables))
    def _(d: Data) -> DataFrame:
        return _dup_rows(keys.linked_value_conflict(d("mil"), variables), variables)


for _n, _vars in _K6.items():
    _register_k6(_n, _vars)


@query("k7_infant_duplicates_272", _dup_sql(_K7A, "cpatid IS NOT NULL"))
def _(d: Data) -> DataFrame:
    return _dup_rows(keys.infant_duplicates(d("mil"), _K7A), _K7A)


@query("k7_infant_duplicates_273", _dup_sql(_K7B, "cpatid IS NOT NULL"))
def _(d: Data) -> DataFrame:
    return _dup_rows(keys.infant_duplicates(d("mil"), _K7B), _K7B)


# --- row rules ------------------------------------------------------------------------------


def _register_rule(name: str, predicate, sql: str, *more: str) -> None:
    out = [*IDS, *more]

    @query(name, f"SELECT {', '.join(out)} FROM mil WHERE {sql}")
    def _(d: Data) -> DataFrame:
        return rules.hits(d("mil"), predicate()).select(*out)


_METHOD = "COALESCE(UPPER(TRIM(matchmethod)), '') NOT IN ({})"
_ROW_RULES = {
    "k8_linked_method": (
        lambda: rules.linked() & rules.code_outside("matchmethod", LINKED_METHODS),
        f"{_LINKED} AND " + _METHOD.format("'RE', 'SI', 'LA', 'BC', 'OT'"), "matchmethod"),
    "k9_unlinked_method": (
        lambda: rules.not_linked() & rules.code_outside("matchmethod", UNLINKED_METHODS),
        "(mpatid IS NULL OR cpatid IS NULL) AND " + _METHOD.format("'N1', 'N2', 'N3', 'NA'"), "matchmethod"),
    "k10_date_bounds": (
        lambda: rules.out_of_range("adate", "1996-01-01", "2000-12-31"),
        "adate < DATE '1996-01-01' OR adate > DATE '2000-12-31'"),
    "k11_value_domain": (
        lambda: rules.outside_domain("birth_type", BIRTH_TYPES),
        "birth_type IS NOT NULL AND birth_type NOT BETWEEN 1 AND 8", "birth_type"),
    "k12_requires": (
        lambda: rules.requires("cpatid", "ddate"), "cpatid IS NOT NULL AND ddate IS NULL"),
    "k13_min_gap_years": (
        lambda: rules.min_gap_years("mbirth_date", "cbirth_date"),
        "mbirth_date > cbirth_date OR (cbirth_date - mbirth_date) / 365.25 < 10", "mbirth_date", "cbirth_date"),
    "k14_birth_window": (
        lambda: rules.birth_window("adate", "cbirth_date", "ddate"),
        """(ddate IS NOT NULL AND (cbirth_date < adate - 3 OR cbirth_date > ddate))
           OR (ddate IS NULL AND (cbirth_date < adate - 3 OR cbirth_date > adate + 1))""", "ddate", "cbirth_date"),
    "k15_linked_requires": (
        lambda: rules.linked_requires("cbirth_date", "matchmethod"),
        f"{_LINKED} AND (cbirth_date IS NULL OR matchmethod IS NULL)", "cbirth_date", "matchmethod"),
    "k16_max_gap_days": (
        lambda: rules.max_gap_days("cenr_start", "adate"), "cenr_start - adate > 180", "cenr_start"),
    "k19_later_226": (lambda: rules.after("ddate", "cbirth_date"), "ddate > cbirth_date", "ddate", "cbirth_date"),
    "k19_earlier_227": (lambda: rules.before("ddate", "cbirth_date"), "ddate < cbirth_date", "ddate", "cbirth_date"),
    "k20_condition": (
        lambda: rules.condition("enctype = 'IP' and ddate is null and age between 12 and 20"),
        "enctype = 'IP' AND ddate IS NULL AND age BETWEEN 12 AND 20", "enctype", "age"),
}
for _name, (_p, _sql, *_more) in _ROW_RULES.items():
    _register_rule(_name, _p, _sql, *_more)


_ONE_PASS = {
    "274": ("k8_linked_method", "Linked row with invalid MatchMethod"),
    "275": ("k9_unlinked_method", "Unlinked row with invalid MatchMethod"),
    "254": ("k13_min_gap_years", "Mother must be born at least 10 years before the child"),
    "255": ("k14_birth_window", "Birth outside the delivery stay"),
    "257": ("k15_linked_requires", "Linked row lacks a value"),
    "280": ("k16_max_gap_days", "First enrollment more than 180 days after delivery"),
}


@query(
    "k8_k16_one_pass",
    " UNION ALL ".join(
        f"SELECT 'MIL_2_00_00-0_{c}' AS flagid, '{text}' AS flag_descr, '' AS message, 'Warn' AS flag_type, 'N' AS abort_yn,"
        f" {_IDS} FROM mil WHERE {_ROW_RULES[rule][1]}"
        for c, (rule, text) in _ONE_PASS.items()
    ),
)
def _(d: Data) -> DataFrame:
    checks = [(Flag(c, 2, "00", text), _ROW_RULES[rule][0]()) for c, (rule, text) in _ONE_PASS.items()]
    return fl.row_checks(d("mil"), checks, IDS)


_PER_ENC = "SELECT encounterid, birth_type, COUNT(*) AS n_deliveries FROM mil WHERE mpatid IS NOT NULL GROUP BY ALL"


@query(
    "k17_over_birth_type",
    f"""SELECT * FROM ({_PER_ENC}) AS p WHERE birth_type IS NULL OR (birth_type NOT IN (0, 8, 9) AND n_deliveries > birth_type)""",
)
def _(d: Data) -> DataFrame:
    return linkage.over_birth_type(linkage.deliveries_per_encounter(d("mil")))


@query(
    "k18_encounters_by_deliveries",
    f"""SELECT birth_type, n_deliveries, COUNT(DISTINCT encounterid) AS n_encounterid FROM ({_PER_ENC}) AS p GROUP BY ALL""",
)
def _(d: Data) -> DataFrame:
    return linkage.encounters_by_deliveries(linkage.deliveries_per_encounter(d("mil")))


# --- span classification --------------------------------------------------------------------

# enrollment with repeats: half the spans again with other coverage, some shortened or cut off
MESSY = """
SELECT patid, enr_start, enr_end, medcov, drugcov, chart FROM enr
UNION ALL SELECT patid, enr_start, enr_end, medcov, 'X', chart FROM enr WHERE chart = 'Y'
UNION ALL SELECT patid, enr_start, enr_end - 12, medcov, drugcov, 'Z' FROM enr WHERE drugcov = 'N'
UNION ALL SELECT patid, enr_end + 1, enr_end + 30, medcov, drugcov, chart FROM enr WHERE medcov = 'N'
UNION ALL SELECT patid, enr_start + 400, CAST(NULL AS DATE), medcov, drugcov, chart FROM enr WHERE medcov = 'N'
"""
_KEYS = "patid, enr_start, enr_end, medcov, drugcov, chart"
_ORDER = "enr_start NULLS FIRST, enr_end NULLS FIRST, medcov NULLS FIRST, drugcov NULLS FIRST, chart NULLS FIRST"
_LOW = "DATE '0001-01-01'"
_PASSES = f"""WITH src AS (SELECT DISTINCT {_KEYS} FROM ({MESSY})),
  l1 AS (SELECT *, LAG(enr_start) OVER w AS ls, LAG(enr_end) OVER w AS le, ROW_NUMBER() OVER w AS rn FROM src
         WINDOW w AS (PARTITION BY patid ORDER BY {_ORDER})),
  c1 AS (SELECT *, COALESCE(enr_start, {_LOW}) AS s, COALESCE(enr_end, {_LOW}) AS e, COALESCE(ls, {_LOW}) AS a, COALESCE(le, {_LOW}) AS b FROM l1),
  s1 AS (SELECT *, CASE WHEN e < s THEN 'invalid' WHEN rn = 1 THEN 'keep'
           WHEN s <= a AND e >= b THEN CASE WHEN s = a AND e = b THEN 'Duplicate' WHEN s <= b AND e <= b THEN 'Subset' ELSE 'drop' END
           ELSE 'keep' END AS st FROM c1),
  l2 AS (SELECT {_KEYS}, s, e, COALESCE(LAG(enr_end) OVER w, {_LOW}) AS b2, ROW_NUMBER() OVER w AS rn2 FROM s1 WHERE st = 'keep'
         WINDOW w AS (PARTITION BY patid ORDER BY {_ORDER})),
  s2 AS (SELECT *, CASE WHEN rn2 > 1 AND (s <= b2 OR e <= b2) THEN 'Overlap' ELSE 'keep' END AS st FROM l2),
  found AS (SELECT {_KEYS}, st AS dateconflict FROM s1 WHERE st IN ('Duplicate', 'Subset')
            UNION ALL SELECT {_KEYS}, st FROM s2 WHERE st = 'Overlap'),
  kept AS (SELECT {_KEYS} FROM s2 WHERE st = 'keep' UNION ALL SELECT {_KEYS} FROM s1 WHERE st = 'invalid')
"""


def messy(d: Data) -> DataFrame:
    return d.sql(MESSY)


@query("k21_overlaps", _PASSES + "SELECT * FROM found")
def _(d: Data) -> DataFrame:
    return spans.overlaps(messy(d))


@query("k21_without_overlaps", _PASSES + "SELECT * FROM kept")
def _(d: Data) -> DataFrame:
    return spans.without_overlaps(messy(d))


@query("k22_invalid_spans", f"SELECT {_KEYS} FROM ({MESSY}) AS m WHERE enr_end < enr_start OR (enr_end IS NULL AND enr_start IS NOT NULL)")
def _(d: Data) -> DataFrame:
    return spans.invalid_spans(messy(d))


def _summary_sql(where: str) -> str:
    return f"""{_PASSES}, v AS (SELECT * FROM (VALUES ('Duplicate'), ('Overlap'), ('Subset')) l(dateconflict)),
      f AS (SELECT * FROM found WHERE {where})
      SELECT v.dateconflict, 'Records' AS counttype, COUNT(f.dateconflict) AS count FROM v LEFT JOIN f ON f.dateconflict = v.dateconflict GROUP BY 1
      UNION ALL SELECT v.dateconflict, 'Unique PatID', COUNT(DISTINCT f.patid) FROM v LEFT JOIN f ON f.dateconflict = v.dateconflict GROUP BY 1"""


@query("k23_overlap_summary", _summary_sql("TRUE"))
def _(d: Data) -> DataFrame:
    return spans.overlap_summary(spans.overlaps(messy(d)))


@query("k23_overlap_summary_zero", _summary_sql("medcov = 'none'"))
def _(d: Data) -> DataFrame:
    return spans.overlap_summary(spans.overlaps(messy(d)).where("medcov = 'none'"))


@query(
    "k24_unbridged",
    _PASSES
    + f""", l AS (SELECT {_KEYS}, LAG(enr_end) OVER w AS le, LAG(medcov) OVER w AS lm, LAG(drugcov) OVER w AS ld, LAG(chart) OVER w AS lc
        FROM kept WHERE enr_start <= enr_end WINDOW w AS (PARTITION BY patid ORDER BY {_ORDER}))
      SELECT {_KEYS} FROM l WHERE enr_start = le + 1 AND medcov IS NOT DISTINCT FROM lm AND drugcov IS NOT DISTINCT FROM ld
        AND chart IS NOT DISTINCT FROM lc""",
)
def _(d: Data) -> DataFrame:
    return spans.unbridged(spans.without_overlaps(messy(d)))


@query(
    "k25_count_types",
    _PASSES
    + """SELECT '215' AS checkid, 'Unique PatID' AS count_type, COUNT(DISTINCT patid) AS count FROM found
      UNION ALL SELECT '215', 'Records', COUNT(*) FROM found""",
)
def _(d: Data) -> DataFrame:
    return fl.count_types(spans.overlaps(messy(d)), "215")


@query(
    "k26_count_flags",
    """SELECT flagid, abort_yn, flag_type, flag_descr, COUNT(*) AS count, FALSE AS whole FROM (
       SELECT 'MIL_2_00_00-0_201' AS flagid, 'N' AS abort_yn, 'Warn' AS flag_type, 'Date ADate outside valid range' AS flag_descr
       FROM mil WHERE adate < DATE '1996-01-01' OR adate > DATE '2000-12-31'
       UNION ALL SELECT 'MIL_2_00_00-0_204', 'N', 'Warn', 'Variable Birth_Type has invalid value' FROM mil WHERE birth_type NOT BETWEEN 1 AND 8
       ) GROUP BY ALL""",
)
def _(d: Data) -> DataFrame:
    checks = {
        "201": rules.out_of_range("adate", "1996-01-01", "2000-12-31"),
        "204": rules.outside_domain("birth_type", BIRTH_TYPES),
    }
    found = fl.row_checks(d("mil"), [(flag(c), p) for c, p in checks.items()], [])
    rows = found.select(F.right("flagid", F.lit(3)).alias("checkid"), F.lit("MIL").alias("tableid"))
    return fl.count_flags(rows, flags_frame(d.spark), ["checkid", "tableid"])


@query(
    "k26_sum_counts",
    """WITH t AS (SELECT CAST(SUM(n - 1) AS BIGINT) AS count FROM (SELECT COUNT(*) AS n FROM mil GROUP BY mpatid, cpatid, adate) AS g),
       e AS (SELECT CAST(COALESCE(SUM(n - 1), 0) AS BIGINT) AS count FROM (SELECT COUNT(*) AS n FROM enr GROUP BY patid, enr_start, enr_end, medcov, drugcov, chart) AS g)
       SELECT 'MIL_2_00_00-0_211' AS flagid, 'N' AS abort_yn, 'Warn' AS flag_type,
       'Duplicate records by MPatID, CPatID, ADate' AS flag_descr, count + 99999 AS count, FALSE AS whole FROM t
       UNION ALL SELECT NULL, NULL, NULL, NULL, count, FALSE FROM e
       UNION ALL SELECT 'MIL_1_00_00-0_101', 'Y', 'Abort', 'Table is not populated', 99999, TRUE FROM t""",
)
def _(d: Data) -> DataFrame:
    """Surplus rows of two tables, of which the lookup knows one; a count that equals the mark; a mark beside a larger count."""
    dup = keys.surplus_duplicates(d("mil"), IDS[:3], "mil").unionByName(
        keys.surplus_duplicates(d("enr"), spans.SPAN_KEYS, "enr")
    )
    named = dup.select(F.col("tabid").alias("tableid"), F.lit("211").alias("checkid"), "count_dup", F.lit(False).alias("whole"))
    marks = d("mil").agg(F.count("*").alias("n")).select(F.inline(F.array(*[
        F.struct(F.lit("MIL").alias("tableid"), F.lit(c).alias("checkid"), (F.lit(n) + 0 * F.col("n")).cast("long").alias("count_dup"), F.lit(w).alias("whole"))
        for c, n, w in (("211", 99999, False), ("101", 99999, True), ("101", 150000, False))
    ])))
    return fl.count_flags(named.unionByName(marks), flags_frame(d.spark), ["checkid", "tableid"], "count_dup")


@query(
    "k26_two_tables",
    """WITH r AS (SELECT 'ENR' AS table2, COUNT(DISTINCT mpatid) AS n FROM mil WHERE mpatid NOT IN (SELECT patid FROM enr WHERE patid IS NOT NULL)
       UNION ALL SELECT 'DTH', COUNT(DISTINCT mpatid) FROM mil WHERE mpatid NOT IN (SELECT patid FROM dth WHERE patid IS NOT NULL))
       SELECT 'MIL_2_00_00-0_221' AS flagid, 'N' AS abort_yn, 'Warn' AS flag_type, 'MIL records without matching enr record' AS flag_descr,
              n AS count, FALSE AS whole FROM r WHERE table2 = 'ENR' AND n > 0
       UNION ALL SELECT NULL, NULL, NULL, NULL, n, FALSE FROM r WHERE table2 = 'DTH' AND n > 0""",
)
def _(d: Data) -> DataFrame:
    """Mothers that two other tables lack; the lookup names one of the two pairs of tables."""
    lost = [
        cross.not_in_reference(d("mil"), d(t), {"mpatid": "patid"}).select(
            F.lit("221").alias("checkid"), F.lit("MIL").alias("table1"), F.lit(t.upper()).alias("table2")
        )
        for t in ("enr", "dth")
    ]
    lookup = flags_frame(d.spark).withColumnRenamed("tableid", "table1").withColumn("table2", F.lit("ENR"))
    return fl.count_flags(lost[0].unionByName(lost[1]), lookup, ["checkid", "table1", "table2"])


# --- across tables --------------------------------------------------------------------------


@query(
    "x1_not_in_reference",
    """SELECT 'ENR' AS table2, mpatid, CAST(NULL AS VARCHAR) AS encounterid, CAST(NULL AS VARCHAR) AS cpatid FROM (SELECT DISTINCT mpatid FROM mil m
         WHERE mpatid IS NOT NULL AND NOT EXISTS (SELECT 1 FROM enr WHERE patid = mpatid))
       UNION ALL SELECT 'DEL', mpatid, encounterid, NULL FROM (SELECT DISTINCT mpatid, encounterid FROM mil m WHERE mpatid IS NOT NULL
         AND NOT EXISTS (SELECT 1 FROM del x WHERE x.mpatid = m.mpatid AND x.encounterid = m.encounterid))
       UNION ALL SELECT 'INF', NULL, NULL, cpatid FROM (SELECT DISTINCT cpatid FROM mil m WHERE cpatid IS NOT NULL
         AND NOT EXISTS (SELECT 1 FROM inf x WHERE x.cpatid = m.cpatid))""",
)
def _(d: Data) -> DataFrame:
    mil = d("mil")
    found = [
        cross.not_in_reference(mil, d("enr"), {"mpatid": "patid"}).withColumn("table2", F.lit("ENR")),
        cross.not_in_reference(mil, d("del"), {"mpatid": "mpatid", "encounterid": "encounterid"})
        .withColumn("table2", F.lit("DEL")),
        cross.not_in_reference(mil, d("inf"), {"cpatid": "cpatid"}).withColumn("table2", F.lit("INF")),
    ]
    return tables.union_all(found).select("table2", "mpatid", "encounterid", "cpatid")


_N_DEL = """SELECT DISTINCT mpatid, encounterid FROM del x WHERE mpatid IS NOT NULL
  AND NOT EXISTS (SELECT 1 FROM mil m WHERE x.mpatid = m.mpatid AND x.encounterid = m.encounterid)"""
_E_DEL = """SELECT DISTINCT mpatid, encounterid FROM mil m WHERE mpatid IS NOT NULL
  AND NOT EXISTS (SELECT 1 FROM del x WHERE x.mpatid = m.mpatid AND x.encounterid = m.encounterid)"""


@query("x2_not_in_table", f"{_N_DEL}")
def _(d: Data) -> DataFrame:
    on = {"mpatid": "mpatid", "encounterid": "encounterid"}
    return cross.not_in_reference(d("del"), d("mil"), on)


@query("x3_id_file_status", f"SELECT *, 'E' AS idfilestatus FROM ({_E_DEL}) AS e UNION ALL SELECT *, 'N' FROM ({_N_DEL}) AS n")
def _(d: Data) -> DataFrame:
    return cross.id_file_status(d("mil"), d("del"), ["mpatid", "encounterid"])


@query(
    "x4_declared_length",
    """SELECT 'CPatID' AS variable1, 'PatID' AS variable2, 'MIL' AS table1, 'ENR' AS table2, a AS length1, b AS length2 FROM
       (SELECT CAST(MAX(LENGTH(cpatid)) AS INTEGER) AS a FROM mil) AS x, (SELECT CAST(MAX(LENGTH(patid)) AS INTEGER) AS b FROM enr) AS y WHERE a <> b""",
)
def _(d: Data) -> DataFrame:
    one, two = profile.contents(d("mil"), "mil"), profile.contents(d("enr"), "enr")
    return cross.declared_length_mismatch(one, two, "CPatID", "PatID")


_PAIRS = [("MIL", "ENC", "encounterid"), ("MIL", "ENC", "enctype"), ("ENR", "DEM", "patid"), ("ENR", "ENC", "patid"),
          ("MIL", "ENR", "mpatid")]
_ALL_RULES = [
    VariableRule(c.split()[0], f"{i:02d}", c.split()[1], 20, tabid=t.upper())
    for t, cols in {"mil": "mpatid C,encounterid C,enctype C", "enr": "patid C", "dem": "patid C",
                    "enc": "patid C,encounterid C,enctype C"}.items()
    for i, c in enumerate(cols.split(","), 1)
]


def _lengths(d: Data) -> DataFrame:
    found = tables.union_all([profile.contents(d(t), t) for t in ("mil", "enr", "dem", "enc")])
    comp = profile.compliance(found, rules_frame(d.spark, _ALL_RULES))
    pairs = d.spark.createDataFrame(_PAIRS, "table1 string, table2 string, variable string")
    return cross.compliance_lengths(comp, pairs)


_LENGTHS_SQL = f"""WITH c AS ({" UNION ALL ".join(contents_sql(t) for t in ("mil", "enr", "dem", "enc"))}),
  p AS (SELECT * FROM (VALUES {", ".join(str(p) for p in _PAIRS)}) v(table1, table2, variable)),
  r AS (SELECT p.*, a.length AS varlength1, b.length AS varlength2 FROM p LEFT JOIN c a ON a.tabid = table1 AND a.name = variable
        LEFT JOIN c b ON b.tabid = table2 AND b.name = variable)
"""


@query("x5_compliance_lengths", _LENGTHS_SQL + "SELECT * FROM r")
def _(d: Data) -> DataFrame:
    return _lengths(d)


@query("x5_length_mismatch", _LENGTHS_SQL + "SELECT * FROM r WHERE varlength1 IS DISTINCT FROM varlength2")
def _(d: Data) -> DataFrame:
    return cross.length_mismatch(_lengths(d))


_VLEN = " UNION ALL ".join(
    f"SELECT '{t.upper()}' AS tabid, 'patid' AS variable, CAST(LENGTH(patid) AS INTEGER) AS valuelength, COUNT(*) AS count"
    f" FROM {t} WHERE patid IS NOT NULL GROUP BY ALL"
    for t in ("enr", "dem", "enc")
)


@query("x6_value_lengths", _VLEN)
def _(d: Data) -> DataFrame:
    return cross.value_lengths(d.many("enr", "dem", "enc"), "patid")


@query(
    "x6_value_length_mismatch",
    f"""WITH v AS ({_VLEN}), a AS (SELECT valuelength AS length1 FROM v WHERE tabid = 'ENR'), b AS (SELECT valuelength AS length2 FROM v WHERE tabid = 'DEM')
      SELECT 'ENR' AS table1, 'DEM' AS table2, 'patid' AS variable, length1, length2 FROM a, b WHERE length1 <> length2""",
)
def _(d: Data) -> DataFrame:
    lengths = cross.value_lengths(d.many("enr", "dem", "enc"), "patid")
    return cross.value_length_mismatch(lengths, "enr", "dem", "patid")


_NAMES = {"part": "p_name", "nation": "n_name", "region": "r_name"}


@query(
    "x6_value_length_differences",
    "WITH "
    + ", ".join(f"{t[0]} AS (SELECT CAST(LENGTH({c}) AS INTEGER) AS l, COUNT(*) AS n FROM {t} WHERE {c} IS NOT NULL GROUP BY ALL)" for t, c in _NAMES.items())
    + " UNION ALL ".join(
        f""" SELECT 'PART' AS table1, '{t.upper()}' AS table2, 'name' AS variable, p.l AS length1, {t[0]}.l AS length2, p.n AS count1, {t[0]}.n AS count2
        FROM p FULL OUTER JOIN {t[0]} ON p.l = {t[0]}.l WHERE p.l IS NULL OR {t[0]}.l IS NULL"""
        for t in ("nation", "region")
    ),
)
def _(d: Data) -> DataFrame:
    named = {t: d(t).select(F.col(c).alias("name")) for t, c in _NAMES.items()}
    lengths = cross.value_lengths(named, "name")
    return cross.value_length_differences(lengths, [("part", "nation"), ("part", "region")], "name")


@query(
    "x7_attribute_mismatch",
    """SELECT DISTINCT 'sex' AS variable, m.sex AS value FROM mil m JOIN dem x ON m.mpatid IS NOT DISTINCT FROM x.patid
       WHERE m.sex IS NOT NULL AND m.sex IS DISTINCT FROM CASE WHEN UPPER(x.sex) IN ('A', 'U') THEN 'O' ELSE x.sex END
       UNION ALL SELECT DISTINCT 'adate', CAST(m.adate AS VARCHAR) FROM mil m JOIN enc x ON m.encounterid IS NOT DISTINCT FROM x.encounterid
       WHERE m.adate IS NOT NULL AND m.adate IS DISTINCT FROM x.adate""",
)
def _(d: Data) -> DataFrame:
    recode = F.when(F.upper("sex").isin("A", "U"), "O").otherwise(F.col("sex"))
    sex = cross.attribute_mismatch(d("mil"), d("dem"), ("mpatid", "patid"), ("sex", "sex"), recode)
    day = cross.attribute_mismatch(d("mil"), d("enc"), ("encounterid", "encounterid"), ("adate", "adate"))
    return sex.unionByName(day.withColumn("value", F.col("value").cast("string")))


@query(
    "x8_rows_not_in_reference",
    f"SELECT {_IDS} FROM mil WHERE mpatid IS NOT NULL AND mpatid NOT IN (SELECT patid FROM enr)",
)
def _(d: Data) -> DataFrame:
    return cross.rows_not_in_reference(d("mil"), d("enr"), "mpatid", "patid").select(*IDS)


def _uncovered_sql(records: str, date: str, cov: str) -> str:
    return f"""WITH r AS (SELECT patid, {date} AS d FROM ({records}) AS q WHERE patid IN (SELECT patid FROM enr)),
      k AS (SELECT patid, enr_start, enr_end FROM enr WHERE {cov} = 'Y' AND enr_start <= enr_end)
      SELECT patid, COUNT(*) AS n_records FROM r GROUP BY patid
      HAVING patid NOT IN (SELECT r.patid FROM r JOIN k ON k.patid = r.patid AND r.d BETWEEN k.enr_start AND k.enr_end)"""


@query(
    "x9_uncovered_patients",
    _uncovered_sql("SELECT patid, COALESCE(lab_dt, result_dt, order_dt) AS d0 FROM lab WHERE COALESCE(lab_dt, result_dt, order_dt) IS NOT NULL", "d0", "medcov"),
)
def _(d: Data) -> DataFrame:
    tests = d("lab").select("patid", F.coalesce("lab_dt", "result_dt", "order_dt").alias("testdate"))
    return spans.uncovered_patients(tests.where("testdate IS NOT NULL"), d("enr"), "medcov", "testdate")


_PAIRS_SQL = """SELECT m.mpatid, m.adate, e.enr_start, e.enr_end FROM mil m JOIN enr e ON e.patid = m.mpatid
  WHERE e.enr_start IS NOT NULL AND e.enr_end IS NOT NULL AND (m.adate < e.enr_start OR m.adate > e.enr_end)"""


@query(
    "x10_outside_span_pairs",
    f"""WITH p AS ({_PAIRS_SQL}), n AS (SELECT mpatid, adate, COUNT(*) AS n FROM mil GROUP BY ALL)
      SELECT p.mpatid, p.adate, MAX(n.n) AS n, COUNT(*) AS n_pairs FROM p JOIN n ON n.mpatid = p.mpatid AND n.adate = p.adate GROUP BY ALL""",
)
def _(d: Data) -> DataFrame:
    enr = d("enr").withColumnRenamed("patid", "mpatid")
    return spans.outside_span_pairs(d("mil"), enr, ["mpatid"], "adate")


@query(
    "x10_uncovered_dates",
    """SELECT mpatid, adate, COUNT(*) AS n FROM mil m WHERE adate IS NOT NULL AND mpatid IS NOT NULL AND NOT EXISTS
       (SELECT 1 FROM enr e WHERE e.patid = m.mpatid AND m.adate BETWEEN e.enr_start AND e.enr_end) GROUP BY ALL""",
)
def _(d: Data) -> DataFrame:
    enr = d("enr").withColumnRenamed("patid", "mpatid")
    return spans.uncovered_dates(d("mil").where("mpatid IS NOT NULL"), enr, ["mpatid"], "adate")


@query("x11_uncovered_dispensing", _uncovered_sql("SELECT patid, rxdate FROM dis", "rxdate", "drugcov"))
def _(d: Data) -> DataFrame:
    return spans.uncovered_patients(d("dis"), d("enr"), "drugcov", "rxdate")


@query("x11_uncovered_vitals", _uncovered_sql("SELECT patid, measure_date FROM vit", "measure_date", "medcov"))
def _(d: Data) -> DataFrame:
    return spans.uncovered_patients(d("vit"), d("enr"), "medcov", "measure_date")


def _order_sql(op: str, one_sided: str) -> str:
    return f"""WITH a AS (SELECT patid, adate AS d FROM enc WHERE adate IS NOT NULL), b AS (SELECT patid, enr_start AS d FROM enr)
      SELECT COALESCE(a.patid, b.patid) AS patid, COUNT(*) AS n_pairs FROM a FULL OUTER JOIN b ON a.patid = b.patid
      WHERE a.d {op} b.d OR {one_sided} GROUP BY 1"""


@query("x12_later_205", _order_sql(">", "b.patid IS NULL"))
def _(d: Data) -> DataFrame:
    return cross.date_order_pairs(d("enc"), d("enr"), "adate", "enr_start", later=True)


@query("x12_earlier_206", _order_sql("<", "a.patid IS NULL"))
def _(d: Data) -> DataFrame:
    return cross.date_order_pairs(d("enc"), d("enr"), "adate", "enr_start", later=False)


def _presence(d: Data) -> DataFrame:
    return cross.presence_matrix({t: (d(t), "mpatid" if t == "mil" else "patid") for t in ("mil", "enr", "dem", "dth", "cod")})


_PRESENCE = """WITH ids AS (SELECT DISTINCT mpatid AS id, 'mil' AS t FROM mil WHERE mpatid IS NOT NULL UNION ALL SELECT DISTINCT patid, 'enr' FROM enr
  UNION ALL SELECT DISTINCT patid, 'dem' FROM dem UNION ALL SELECT DISTINCT patid, 'dth' FROM dth UNION ALL SELECT DISTINCT patid, 'cod' FROM cod),
  w AS (SELECT id, CAST(COUNT(*) FILTER (WHERE t = 'mil') AS VARCHAR) AS mil, CAST(COUNT(*) FILTER (WHERE t = 'enr') AS VARCHAR) AS enr,
        CAST(COUNT(*) FILTER (WHERE t = 'dem') AS VARCHAR) AS dem, CAST(COUNT(*) FILTER (WHERE t = 'dth') AS VARCHAR) AS dth,
        CAST(COUNT(*) FILTER (WHERE t = 'cod') AS VARCHAR) AS cod FROM ids GROUP BY id)
"""


@query("x13_presence_matrix", _PRESENCE + "SELECT mil, enr, dem, dth, cod, COUNT(*) AS count FROM w GROUP BY ALL")
def _(d: Data) -> DataFrame:
    return _presence(d)


@query(
    "x14_pattern_counts",
    _PRESENCE
    + """SELECT 'dem' AS table1, 'enr' AS table2, COUNT(*) AS count FROM w WHERE dem = '1' AND enr = '0'
      UNION ALL SELECT 'mil', 'enr', COUNT(*) FROM w WHERE mil = '1' AND enr = '0'
      UNION ALL SELECT 'enr', 'cod', COUNT(*) FROM w WHERE enr = '1' AND cod = '0'""",
)
def _(d: Data) -> DataFrame:
    return cross.pattern_counts(_presence(d), [("dem", "enr"), ("mil", "enr"), ("enr", "cod")])


@query(
    "x14_value_patterns",
    """SELECT 'mil' AS table1, 'enc' AS table2, (SELECT COUNT(*) FROM (SELECT DISTINCT matchmethod AS v FROM mil WHERE matchmethod IS NOT NULL) AS a
         WHERE v NOT IN (SELECT enctype FROM enc WHERE enctype IS NOT NULL)) AS count
       UNION ALL SELECT 'enc', 'mil', (SELECT COUNT(*) FROM (SELECT DISTINCT enctype AS v FROM enc WHERE enctype IS NOT NULL) AS a
         WHERE v NOT IN (SELECT matchmethod FROM mil WHERE matchmethod IS NOT NULL))""",
)
def _(d: Data) -> DataFrame:
    m = cross.value_matrix({"mil": (d("mil"), "matchmethod"), "enc": (d("enc"), "enctype")})
    return cross.value_pattern_counts(m, [("mil", "enc"), ("enc", "mil")])


@query(
    "x13_value_matrix",
    """SELECT value, CAST(SUM(mil) AS BIGINT) AS mil, CAST(SUM(enc) AS BIGINT) AS enc FROM (
       SELECT enctype AS value, COUNT(*) AS mil, 0 AS enc FROM mil WHERE enctype IS NOT NULL GROUP BY 1
       UNION ALL SELECT enctype, 0, COUNT(*) FROM enc WHERE enctype IS NOT NULL GROUP BY 1) AS u GROUP BY value""",
)
def _(d: Data) -> DataFrame:
    return cross.value_matrix({t: (d(t), "enctype") for t in ("mil", "enc")})


_DAYS = """CASE WHEN cenr_start - cbirth_date IS NULL THEN '00. Missing' WHEN cenr_start - cbirth_date < 0 THEN '01. < 0 days'
  WHEN cenr_start - cbirth_date <= 30 THEN '02. 0-30 days' WHEN cenr_start - cbirth_date <= 60 THEN '03. 31-60 days'
  WHEN cenr_start - cbirth_date <= 120 THEN '04. 61-120 days' WHEN cenr_start - cbirth_date <= 180 THEN '05. 121-180 days'
  WHEN cenr_start - cbirth_date <= 270 THEN '06. 181-270 days' WHEN cenr_start - cbirth_date <= 365 THEN '07. 271-365 days'
  ELSE '08. >= 366 days' END"""


@query(
    "x15_days_to_enrollment",
    f"""SELECT CAST(YEAR(cbirth_date) AS INTEGER) AS year_cbirth_date, {_DAYS} AS agedays_group, COUNT(DISTINCT cpatid) AS count
      FROM mil WHERE cpatid IS NOT NULL GROUP BY 1, 2""",
)
def _(d: Data) -> DataFrame:
    return cross.days_to_enrollment(d("mil"))
