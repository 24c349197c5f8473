"""Sources, sinks and level 1."""

from __future__ import annotations

import uuid
from dataclasses import replace

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from carelens.functions.rulesets import (
    TABLE_IDS,
    VARIABLE_RULES,
    Flag,
    VariableRule,
    flag,
    flags_frame,
    rules_frame,
)
from carelens.operators import flags as fl
from carelens.operators import linkage, profile
from carelens.registry.catalog import query
from carelens.registry.views import Data
from carelens.sources import runs, sinks, tables, work

IDS = ["mpatid", "cpatid", "encounterid", "adate"]
REVIEWED = ["mil", "enr", "dem", "enc", "dis", "lab", "vit", "dth", "cod"]


# --- sources and sinks ----------------------------------------------------------------------


@query("io1_read_table", "SELECT l_orderkey, l_linenumber, l_quantity FROM lineitem")
def _(d: Data) -> DataFrame:
    found = tables.read_tables(d.spark, {"LineItem": f"{d.sf_dir}/lineitem.parquet"})
    return tables.table(found, "LINEITEM").select("l_orderkey", "l_linenumber", "l_quantity")


@query("io2_merge_split", "SELECT o_orderkey, o_custkey, o_orderstatus FROM orders")
def _(d: Data) -> DataFrame:
    orders = d("orders").select("o_orderkey", "o_custkey", "o_orderstatus")
    part = F.pmod(F.xxhash64(*orders.columns), F.lit(3))
    parts = {f"orders{i + 1}": orders.where(part == i) for i in range(3)}
    return tables.merge_split(parts, "orders")


def _gap_tables(d: Data) -> tables.Tables:
    mil, p = d("mil"), linkage.linkage_predicates()
    one = lambda c, *more: fl.with_flag(mil.where(p[c]).select(*IDS, *more), flag(c))
    return {"flag_l3_394": one("394", "birth_type"), "flag_l3_396": one("396"),
            "flag_l3_397": one("397", "cbirth_date"), "other": d("enr")}


_GAP_SQL = """
SELECT 'MIL_3_00_00-0_394' AS flagid, 'Birth_Type= 2-8 and no CPatIDs are linked' AS flag_descr, '' AS message,
       'Warn' AS flag_type, 'N' AS abort_yn, mpatid, cpatid, encounterid, adate, birth_type, CAST(NULL AS DATE) AS cbirth_date
FROM mil WHERE birth_type BETWEEN 2 AND 8 AND cpatid IS NULL
UNION ALL
SELECT 'MIL_3_00_00-0_396', 'MPatID not linked to CPatID', '', 'Warn', 'N', mpatid, cpatid, encounterid, adate, NULL, NULL
FROM mil WHERE cpatid IS NULL AND mpatid IS NOT NULL
UNION ALL
SELECT 'MIL_3_00_00-0_397', 'CPatID not linked to MPatID', '', 'Warn', 'N', mpatid, cpatid, encounterid, adate, NULL, cbirth_date
FROM mil WHERE cpatid IS NOT NULL AND mpatid IS NULL
"""


@query("io3_stack", _GAP_SQL)
def _(d: Data) -> DataFrame:
    return tables.stack(_gap_tables(d), "flag_l3_")


@query(
    "io4_stack_as_text",
    """SELECT encounterid, CAST(birth_type AS VARCHAR) AS value FROM mil
       UNION ALL SELECT encounterid, enctype FROM enc
       UNION ALL SELECT encounterid, CAST(adate AS VARCHAR) FROM mil""",
)
def _(d: Data) -> DataFrame:
    parts = {
        "temp_flag_a": d("mil").select("encounterid", F.col("birth_type").alias("value")),
        "temp_flag_b": d("enc").select("encounterid", F.col("enctype").alias("value")),
        "temp_flag_c": d("mil").select("encounterid", F.col("adate").alias("value")),
    }
    return tables.stack_as_text(parts, "temp_flag_")


@query("io5_align_row_flags", _GAP_SQL)
def _(d: Data) -> DataFrame:
    found = _gap_tables(d)
    return sinks.align_flags(d.spark, [t for n, t in found.items() if n.startswith("flag")])


@query(
    "io6_identifier_guard",
    """SELECT flagid, flag_descr, flag_type, abort_yn, COUNT(*) AS count FROM (
       SELECT 'MIL_3_00_00-0_394' AS flagid, 'Birth_Type= 2-8 and no CPatIDs are linked' AS flag_descr,
              'Warn' AS flag_type, 'N' AS abort_yn FROM mil WHERE birth_type BETWEEN 2 AND 8 AND cpatid IS NULL
       UNION ALL SELECT 'MIL_3_00_00-0_396', 'MPatID not linked to CPatID', 'Warn', 'N' FROM mil WHERE cpatid IS NULL AND mpatid IS NOT NULL
       UNION ALL SELECT 'MIL_3_00_00-0_397', 'CPatID not linked to MPatID', 'Warn', 'N' FROM mil WHERE cpatid IS NOT NULL AND mpatid IS NULL
       ) GROUP BY ALL""",
)
def _(d: Data) -> DataFrame:
    gaps = linkage.linkage_gaps(d("mil"), [])
    return sinks.refuse_identifiers(gaps.groupBy("flagid", "flag_descr", "flag_type", "abort_yn").agg(F.count("*").alias("count")))


@query(
    "io7_flag_schema",
    """SELECT 'MIL_1_06_00-0_126' AS flagid, 'Age value outside range 10-54' AS flag_descr, '' AS message,
       'Warn' AS flag_type, 'N' AS abort_yn FROM mil WHERE age < 10 OR age > 54""",
)
def _(d: Data) -> DataFrame:
    bad = d("mil").where(profile.outside_age(F.col("age")))
    return sinks.to_flag_schema(fl.with_flag(bad, flag("126")))


@query("io8_partner_id", "SELECT 'SITE1' AS dp, patid, enr_start, enr_end FROM enr")
def _(d: Data) -> DataFrame:
    once = sinks.add_partner(d("enr").select("patid", "enr_start", "enr_end"), "site1")
    return sinks.add_partner(once, "site2")


@query(
    "io9_publishable",
    """SELECT 'SITE1' AS dp, 'l2_enc_types' AS name, enctype AS value, COUNT(*) AS count FROM enc GROUP BY enctype
       UNION ALL SELECT 'SITE1', 'l2_race', race, COUNT(*) FROM dem GROUP BY race""",
)
def _(d: Data) -> DataFrame:
    by = lambda t, c: d(t).groupBy(F.col(c).alias("value")).agg(F.count("*").alias("count"))
    made = {
        "l2_enc_types": by("enc", "enctype"),
        "l2_race": by("dem", "race"),
        "all_l1_flags_mstr": d("mil"),
        "all_l2_flags": d("mil"),
    }
    kept = sinks.publishable(made, "site1")
    return tables.union_all([t.select("dp", F.lit(n).alias("name"), "value", "count") for n, t in kept.items()])


def _two_runs(d: Data) -> str:
    """A folder with one published run, and a later one that wrote other counts and failed at a table with identifiers."""
    out = f"{work.shared_dir(d.spark)}/published-{uuid.uuid4().hex}"
    with runs.Run(d.spark, out) as run:
        run.write_rows(d("mil").where("mpatid IS NULL").select("cpatid", "adate"), "mil_unlinked")
        run.write_aggregate(d("enc").groupBy("enctype").agg(F.count("*").alias("count")), "enc_types")
        run.write_work(d("dem").limit(0), "scratch")
    try:
        with runs.Run(d.spark, out) as run:
            run.write_aggregate(d("enc").where("adate IS NULL").groupBy("enctype").agg(F.count("*").alias("count")), "enc_types")
            run.write_aggregate(d("enc").select("patid"), "enc_patients")
    except ValueError as refused:
        if "identifier" not in str(refused):
            raise
    return out


@query("io9_published_run", "SELECT enctype, COUNT(*) AS count FROM enc GROUP BY enctype")
def _(d: Data) -> DataFrame:
    return runs.read_published(d.spark, _two_runs(d), "enc_types")


@query(
    "io9_run_manifest",
    """SELECT 1 AS number, 'completed' AS status, 'row_level' AS zone, 'mil_unlinked' AS name, COUNT(*) AS rows FROM mil WHERE mpatid IS NULL
       UNION ALL SELECT 1, 'completed', 'aggregate', 'enc_types', COUNT(DISTINCT COALESCE(enctype, '')) FROM enc
       UNION ALL SELECT 2, 'failed', NULL, NULL, NULL""",
)
def _(d: Data) -> DataFrame:
    return runs.manifest(d.spark, _two_runs(d)).select(F.col("number").cast("int").alias("number"), "status", "zone", "name", "rows")


# --- structure ------------------------------------------------------------------------------

_COUNTS = " UNION ALL ".join(f"SELECT '{t.upper()}' AS tabid, COUNT(*) AS count_obs FROM {t}" for t in REVIEWED)


@query(
    "p1_missing_tables",
    f"""WITH c AS ({_COUNTS}) SELECT t.tabid || '_1_00_00-0_100' AS flagid, 'Table does not exist' AS flag_descr,
        'Abort' AS flag_type, 'Y' AS abort_yn, CAST(99999 AS BIGINT) AS count
        FROM (VALUES {", ".join(f"('{t.upper()}')" for t in TABLE_IDS)}) t(tabid)
        WHERE t.tabid NOT IN (SELECT tabid FROM c)""",
)
def _(d: Data) -> DataFrame:
    return profile.missing_tables(d.spark, TABLE_IDS, profile.row_counts(d.many(*REVIEWED))).drop("whole")


@query(
    "p2_empty_tables",
    """WITH c AS (SELECT 'MIL' AS tabid, COUNT(*) AS n FROM mil UNION ALL SELECT 'ENR', COUNT(*) FROM enr
       UNION ALL SELECT 'FEA', COUNT(*) FROM enc WHERE encounterid IS NULL)
       SELECT tabid || '_1_00_00-0_101' AS flagid, 'Table is not populated' AS flag_descr, 'Abort' AS flag_type,
       'Y' AS abort_yn, CAST(99999 AS BIGINT) AS count FROM c WHERE n = 0""",
)
def _(d: Data) -> DataFrame:
    # No given table is empty; encounters without an id, which do not occur, stand for one.
    found = d.many("mil", "enr") | {"fea": d("enc").where("encounterid IS NULL")}
    return profile.empty_tables(profile.row_counts(found)).drop("whole")


@query("p3_row_counts", _COUNTS)
def _(d: Data) -> DataFrame:
    return profile.row_counts(d.many(*REVIEWED))


# (column, type class) of the views whose contents the oracles recompute
_COLUMNS = {
    "mil": "mpatid C,cpatid C,adate N,ddate N,encounterid C,enctype C,birth_type N,age N,sex C,"
    "cbirth_date N,mbirth_date N,matchmethod C,cenr_start N",
    "enr": "patid C,enr_start N,enr_end N,medcov C,drugcov C,chart C",
    "dem": "patid C,birth_date N,sex C,hispanic C,race C,postalcode C",
    "enc": "patid C,encounterid C,adate N,enctype C",
}


def contents_sql(view: str, tabid: str | None = None, drop: tuple[str, ...] = (), as_text: tuple[str, ...] = ()) -> str:
    """SELECT that gives the contents table of a view, one branch per column."""
    cols = [c.split() for c in _COLUMNS[view].split(",")]
    cols = [(n, "C" if n in as_text else t) for n, t in cols if n not in drop]
    parts = []
    for i, (name, kind) in enumerate(cols, 1):
        length = f"COALESCE(MAX(LENGTH(CAST({name} AS VARCHAR))), 0)" if kind == "C" else "8"
        parts.append(
            f"SELECT '{(tabid or view).upper()}' AS tabid, COUNT(*) AS nobs, '{name}' AS name, {i} AS varnum,"
            f" '{kind}' AS type, CAST({length} AS INTEGER) AS length FROM {view}"
        )
    return " UNION ALL ".join(parts)


@query("p4_contents", contents_sql("mil") + " UNION ALL " + contents_sql("enr"))
def _(d: Data) -> DataFrame:
    return tables.union_all([profile.contents(d(t), t) for t in ("mil", "enr")])


@query("p4_table_size")  # DuckDB's views do not know where their files lie, so no twin; a test asks the file system
def _(d: Data) -> DataFrame:
    return tables.union_all([profile.table_size(d.spark, f"{d.sf_dir}/{t}.parquet", t) for t in ("lineitem", "orders", "customer")])


_RULES_SQL = ", ".join(
    f"('MIL', '{r.variable}', '{r.varid}', '{r.vartype}', {r.varlength})" for r in VARIABLE_RULES
)


def _compliance_sql(found: str) -> str:
    return f"""a AS ({found}), e AS (SELECT * FROM (VALUES {_RULES_SQL}) v(tabid, variable, varid, vartype, varlength)),
      comp AS (SELECT COALESCE(e.tabid, a.tabid) AS tabid, COALESCE(e.variable, a.name) AS var, e.varid AS varid,
        CASE WHEN e.variable IS NULL THEN 'N' ELSE 'Y' END AS ms_var, CASE WHEN a.name IS NULL THEN 'N' ELSE 'Y' END AS dp_var,
        e.vartype AS ms_type, a.type AS dp_type, CAST(e.varlength AS INTEGER) AS ms_length, a.length AS dp_length,
        CASE WHEN e.variable IS NOT NULL THEN 'not_missing' END AS valid_value_type
        FROM e FULL OUTER JOIN a ON UPPER(e.variable) = UPPER(a.name) AND e.tabid = a.tabid)"""


def _comp(d: Data, df: DataFrame) -> DataFrame:
    return profile.compliance(profile.contents(df, "mil"), rules_frame(d.spark))


@query("p5_compliance", f"WITH {_compliance_sql(contents_sql('mil'))} SELECT * FROM comp")
def _(d: Data) -> DataFrame:
    return _comp(d, d("mil"))


def _structure_sql(found: str, check: str, cond: str, value: str, count: int) -> str:
    return f"""WITH {_compliance_sql(found)} SELECT tabid || '_1_' || varid || '_00-0_{check}' AS flagid, var AS variable,
      {value} AS value, CAST({count} AS BIGINT) AS count FROM comp WHERE ms_var = 'Y' AND {cond}"""


@query(
    "p6_missing_columns",
    _structure_sql(contents_sql("mil", drop=("encounterid", "age")), "110", "dp_var = 'N'", "'NA'", 99999),
)
def _(d: Data) -> DataFrame:
    comp = _comp(d, d("mil").drop("encounterid", "age"))
    return profile.structure_flags(comp).where("flagid LIKE '%_110'").drop("whole")


@query(
    "p7_wrong_type",
    _structure_sql(contents_sql("mil", as_text=("birth_type",)), "112", "dp_var = 'Y' AND ms_type <> dp_type", "dp_type", 1),
)
def _(d: Data) -> DataFrame:
    comp = _comp(d, d("mil").withColumn("birth_type", F.col("birth_type").cast("string")))
    return profile.structure_flags(comp).where("flagid LIKE '%_112'").drop("whole")


@query(
    "p8_wrong_length",
    _structure_sql(
        contents_sql("mil"), "113", "dp_var = 'Y' AND ms_length <> 0 AND ms_length <> dp_length",
        "CAST(dp_length AS VARCHAR)", 99999,
    ),
)
def _(d: Data) -> DataFrame:
    return profile.structure_flags(_comp(d, d("mil"))).where("flagid LIKE '%_113'").drop("whole")


_SHORT = [replace(r, varlength=4) if r.variable == "MPatID" else replace(r, varlength=6) if r.variable == "CPatID" else r
          for r in VARIABLE_RULES]


@query(
    "p9_too_long",
    """SELECT '01' AS varid, 'MPatID' AS variable, mpatid AS value, encounterid, adate FROM mil WHERE LENGTH(mpatid) > 4
       UNION ALL SELECT '02', 'CPatID', cpatid, encounterid, adate FROM mil WHERE LENGTH(cpatid) > 6
       UNION ALL SELECT '04', 'EncounterID', encounterid, encounterid, adate FROM mil WHERE LENGTH(encounterid) > 20""",
)
def _(d: Data) -> DataFrame:
    return profile.too_long(d("mil"), _SHORT, ["encounterid", "adate"])


# --- values ---------------------------------------------------------------------------------

_SPECIAL = VariableRule("CBirth_Date", "07", "N", 8, valid_value_type="special_missing")


def _counts_sql(special: bool = False) -> str:
    rows = [(r.varid, r.variable) for r in VARIABLE_RULES]
    parts = [
        f"SELECT 'MIL' AS tabid, '{i}' AS varid, '{v}' AS variable, COUNT(*) AS count_obs, COUNT({v.lower()}) AS count_nomiss,"
        f" CAST(0 AS BIGINT) AS count_spmiss, COUNT(*) - COUNT({v.lower()}) AS count_null FROM mil"
        for i, v in rows
    ]
    if special:
        sp = "COUNT(*) FILTER (WHERE cbirth_date IS NULL AND birth_type = 9)"
        parts.append(
            "SELECT 'MIL', '07', 'CBirth_Date', COUNT(*), COUNT(cbirth_date),"
            f" {sp}, COUNT(*) - COUNT(cbirth_date) - {sp} FROM mil"
        )
    return " UNION ALL ".join(parts)


@query("p10_value_counts", _counts_sql(special=True))
def _(d: Data) -> DataFrame:
    mil = d("mil").withColumn("cbirth_date__miss", F.when(F.col("birth_type") == 9, "A"))
    return profile.value_counts(mil, [*VARIABLE_RULES, _SPECIAL])


@query(
    "p11_unpopulated",
    """SELECT 'MIL_1_02_00-0_111' AS flagid, 'CPatID' AS variable, '_null_' AS value, CAST(99999 AS BIGINT) AS count
       FROM mil HAVING COUNT(*) > 0
       UNION ALL SELECT 'MIL_1_01_00-0_120', 'MPatID', '_null_', COUNT(*) - COUNT(mpatid) FROM mil HAVING COUNT(*) > COUNT(mpatid)""",
)
def _(d: Data) -> DataFrame:
    emptied = d("mil").withColumn("cpatid", F.lit(None).cast("string"))
    return profile.population_flags(profile.value_counts(emptied, VARIABLE_RULES), flags_frame(d.spark)).drop("whole")


@query(
    "p12_null_counts",
    """SELECT 'MIL_1_01_00-0_120' AS flagid, 'MPatID' AS variable, '_null_' AS value, COUNT(*) - COUNT(mpatid) AS count
       FROM mil HAVING COUNT(*) > COUNT(mpatid)""",
)
def _(d: Data) -> DataFrame:
    return profile.population_flags(profile.value_counts(d("mil"), VARIABLE_RULES), flags_frame(d.spark)).drop("whole")


@query(
    "p12_null_rows",
    """SELECT '01' AS varid, 'MPatID' AS variable, encounterid, adate, cpatid, mpatid FROM mil WHERE mpatid IS NULL
       UNION ALL SELECT '02', 'CPatID', encounterid, adate, cpatid, mpatid FROM mil WHERE cpatid IS NULL""",
)
def _(d: Data) -> DataFrame:
    return profile.null_rows(d("mil"), VARIABLE_RULES, ["encounterid", "adate", "cpatid", "mpatid"])


def _names(d: Data) -> DataFrame:
    return d.sql(NAMES)


# people with names: some with a leading blank, a digit, a hyphen or an apostrophe
NAMES = """
SELECT 'M' || CAST(p_partkey AS STRING) AS mpatid, CAST(NULL AS STRING) AS cpatid,
       CASE p_partkey % 5 WHEN 0 THEN ' ' || p_name WHEN 1 THEN replace(p_name, ' ', '-') WHEN 2 THEN replace(p_name, ' ', '''')
            WHEN 3 THEN replace(p_name, ' ', '') ELSE replace(p_name, ' ', '7') END AS mlname
FROM part
"""
_NAME_FLAGS = [
    Flag("122", 1, "20", "Leading spaces in character variable", variable1="MLName"),
    Flag("133", 1, "20", "Name contains invalid characters", variable1="MLName"),
]


def _flagged(check: str, varid: str, variable: str, view: str, cond: str, value: str, distinct: bool, mother: bool = True, infant: bool = True) -> str:
    ids = f"{'mpatid' if mother else 'CAST(NULL AS VARCHAR)'} AS mpatid, {'cpatid' if infant else 'CAST(NULL AS VARCHAR)'} AS cpatid"
    n = "CAST(1 AS BIGINT)" if distinct else "COUNT(*)"
    return f"""SELECT 'MIL_1_{varid}_00-0_{check}' AS flagid, '{variable}' AS variable, {value} AS value, {ids}, {n} AS count
      FROM {view} WHERE {cond} GROUP BY 1, 2, 3, 4, 5"""


_MIL_VALUE = {
    "121": _flagged("121", "05", "Birth_Type", "mil", "birth_type < 1 OR birth_type > 8", "CAST(birth_type AS VARCHAR)", False, False, False),
    "126": _flagged("126", "06", "Age", "mil", "age < 10 OR age > 54", "CAST(age AS VARCHAR)", True),
    "131": _flagged("131", "03", "ADate", "mil", "adate < DATE '1996-01-01' OR adate > DATE '2000-12-31'", "strftime(adate, '%m/%d/%Y')", True),
}
_MIL_FLAGS = [flag("121"), flag("122"), flag("126"), flag("131")]


def _mil_values(d: Data, checks: list[str]) -> DataFrame:
    wanted = [f for f in _MIL_FLAGS if f.check in checks]
    low, high = (F.lit(x).cast("date") for x in ("1996-01-01", "2000-12-31"))
    return _ids(profile.value_rules(d("mil"), wanted, VARIABLE_RULES, low, high))


def _ids(hits: DataFrame) -> DataFrame:
    return hits.select("flagid", "variable", "value", "mpatid", "cpatid", "count")


# a 126 or 131 variable starts with neither M nor C, or the rule gives both ids
@query("p13_condition", _MIL_VALUE["121"])
def _(d: Data) -> DataFrame:
    return _mil_values(d, ["121"])


@query("p14_leading_blank", _flagged("122", "20", "MLName", f"({NAMES})", "mlname LIKE ' %'", "mlname", True, True, False))
def _(d: Data) -> DataFrame:
    return _ids(profile.value_rules(_names(d), [_NAME_FLAGS[0]], []))


@query("p15_age_range", _MIL_VALUE["126"])
def _(d: Data) -> DataFrame:
    return _mil_values(d, ["126"])


@query("p16_date_window", _MIL_VALUE["131"])
def _(d: Data) -> DataFrame:
    return _mil_values(d, ["131"])


_BAD_NAME = "regexp_matches(trim(mlname), '{}')"


@query("p17_name_characters", _flagged("133", "20", "MLName", f"({NAMES})", _BAD_NAME.format("[^A-Za-z''-]"), "mlname", True, True, False))
def _(d: Data) -> DataFrame:
    return _ids(profile.value_rules(_names(d), [_NAME_FLAGS[1]], []))


@query("p17_name_characters_strict", _flagged("133", "20", "MLName", f"({NAMES})", _BAD_NAME.format("[^A-Za-z]"), "mlname", True, True, False))
def _(d: Data) -> DataFrame:
    return _ids(profile.value_rules(_names(d), [_NAME_FLAGS[1]], [], strict_names=True))


@query("p13_16_all_value_rules", " UNION ALL ".join(_MIL_VALUE.values()))
def _(d: Data) -> DataFrame:
    return _mil_values(d, ["121", "122", "126", "131"])


@query(
    "p18_gate",
    f"""WITH {_compliance_sql(contents_sql('mil', drop=('age',)))}, n AS ({_counts_sql()}),
      v AS (SELECT tabid, var, varid, CASE WHEN dp_var = 'N' OR ms_type <> dp_type THEN 'y1'
            WHEN ms_length <> 0 AND ms_length <> dp_length THEN 'y2' ELSE 'n' END AS exclude FROM comp WHERE ms_var = 'Y')
      SELECT v.tabid, var, v.varid, exclude, CASE WHEN exclude = 'n' AND count_nomiss + count_spmiss > 0 THEN 'Y' ELSE 'N' END AS value_rules
      FROM v LEFT JOIN n ON n.varid = v.varid""",
)
def _(d: Data) -> DataFrame:
    mil = d("mil").drop("age")
    return profile.gate(_comp(d, mil), profile.value_counts(mil, VARIABLE_RULES))


@query(
    "p19_flag_master",
    f"""WITH t AS ({" UNION ALL ".join(_MIL_VALUE.values())}) SELECT DISTINCT flagid, value, mpatid, cpatid,
      CASE variable WHEN 'Birth_Type' THEN 'Invalid data value' WHEN 'Age' THEN 'Age value outside range 10-54'
           ELSE 'Date outside DP min/max range' END AS flag_descr, 'Warn' AS flag_type, 'N' AS abort_yn, variable AS variable1 FROM t""",
)
def _(d: Data) -> DataFrame:
    return fl.flag_master(_mil_values(d, ["121", "126", "131"]), flags_frame(d.spark))


# Beside the flags found: a count that happens to equal the mark, a count beside it, and a mark beside a larger count.
_BESIDE = """SELECT 'MIL_1_06_00-0_126' AS flagid, 'Age' AS variable, 'many' AS value, CAST(99999 + 0 * COUNT(*) AS BIGINT) AS count, FALSE AS whole FROM mil
  UNION ALL SELECT 'MIL_1_06_00-0_126', 'Age', 'many', CAST(5 + 0 * COUNT(*) AS BIGINT), FALSE FROM mil
  UNION ALL SELECT 'MIL_1_01_00-0_111', 'MPatID', '_null_', CAST(99999 AS BIGINT), TRUE FROM mil HAVING COUNT(*) > 0
  UNION ALL SELECT 'MIL_1_01_00-0_111', 'MPatID', '_null_', CAST(150000 + COUNT(*) AS BIGINT), FALSE FROM mil"""


@query(
    "p20_roll_up",
    f"""WITH {_compliance_sql(contents_sql('mil'))}, t AS (
      SELECT flagid, variable, value, count, FALSE AS whole FROM ({" UNION ALL ".join(_MIL_VALUE.values())})
      UNION ALL SELECT tabid || '_1_' || varid || '_00-0_113', var, CAST(dp_length AS VARCHAR), 99999, TRUE
      FROM comp WHERE ms_var = 'Y' AND dp_var = 'Y' AND ms_length <> 0 AND ms_length <> dp_length
      UNION ALL SELECT * FROM ({_BESIDE}) AS b)
      SELECT flagid, variable, value, CAST(CASE WHEN BOOL_OR(whole) THEN 99999 ELSE SUM(count) END AS BIGINT) AS count, BOOL_OR(whole) AS whole
      FROM t GROUP BY 1, 2, 3""",
)
def _(d: Data) -> DataFrame:
    values = _mil_values(d, ["121", "126", "131"]).select("flagid", "variable", "value", "count")
    structure = profile.structure_flags(_comp(d, d("mil")))
    marked = structure.unionByName(values, allowMissingColumns=True).unionByName(d.sql(_BESIDE))
    return fl.roll_up_values(marked)


@query("p21_date_range", "SELECT MIN(adate) AS mindate, MAX(adate) AS maxdate FROM enc")
def _(d: Data) -> DataFrame:
    return profile.date_range(d("enc"), "adate")
