"""Flag definitions and variable rules."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession


@dataclass(frozen=True)
class Flag:
    """One check instance and the metadata its rows carry."""

    check: str
    level: int
    varid: str
    descr: str
    flag_type: str = "Warn"
    abort_yn: str = "N"
    variable1: str = ""
    variable2: str = ""
    tabid: str = "MIL"

    @property
    def flagid(self) -> str:
        return f"{self.tabid.upper()}_{self.level}_{self.varid}_00-0_{self.check}"


@dataclass(frozen=True)
class VariableRule:
    """What is expected of one column."""

    variable: str
    varid: str
    vartype: str  # C character, N numeric or date
    varlength: int
    condition: str = ""  # SQL text; a populated row for which it is true is flagged
    valid_value_type: str = "not_missing"
    tabid: str = "MIL"


# The published flag lookup.
FLAGS = [
    Flag("100", 1, "00", "Table does not exist", "Abort", "Y"),
    Flag("101", 1, "00", "Table is not populated", "Abort", "Y"),
    Flag("102", 1, "00", "Table is not sorted correctly", "Abort", "Y"),
    Flag("110", 1, "01", "Required SCDM variable is missing", "Warn", "N", "MPatID"),
    Flag("110", 1, "02", "Required SCDM variable is missing", "Warn", "N", "CPatID"),
    Flag("110", 1, "03", "Required SCDM variable is missing", "Warn", "N", "ADate"),
    Flag("110", 1, "04", "Required SCDM variable is missing", "Warn", "N", "EncounterID"),
    Flag("110", 1, "05", "Required SCDM variable is missing", "Warn", "N", "Birth_Type"),
    Flag("111", 1, "01", "Variable is not populated", "Warn", "N", "MPatID"),
    Flag("111", 1, "02", "Variable is not populated", "Warn", "N", "CPatID"),
    Flag("112", 1, "01", "Variable type does not match SCDM", "Warn", "N", "MPatID"),
    Flag("113", 1, "01", "Variable length does not match SCDM", "Warn", "N", "MPatID"),
    Flag("120", 1, "01", "Variable contains null values", "Warn", "N", "MPatID"),
    Flag("121", 1, "05", "Invalid data value", "Warn", "N", "Birth_Type"),
    Flag("122", 1, "01", "Leading spaces in character variable", "Warn", "N", "MPatID"),
    Flag("126", 1, "06", "Age value outside range 10-54", "Warn", "N", "Age"),
    Flag("131", 1, "03", "Date outside DP min/max range", "Warn", "N", "ADate"),
    Flag("133", 1, "01", "Name contains invalid characters", "Warn", "N", "MPatID"),
    Flag("200", 2, "00", "MIL ADate outside enrollment coverage", "Abort", "Y", "ADate"),
    Flag("201", 2, "00", "Date ADate outside valid range", "Warn", "N", "ADate"),
    Flag("204", 2, "00", "Variable Birth_Type has invalid value", "Warn", "N", "Birth_Type"),
    Flag("211", 2, "00", "Duplicate records by MPatID, CPatID, ADate", "Warn", "N"),
    Flag("217", 2, "00", "Duplicate records by MPatID, ADate, EncounterID", "Abort", "Y"),
    Flag("218", 2, "00", "Duplicate records by MPatID, ADate", "Abort", "Y"),
    Flag("219", 2, "00", "Duplicate records by CPatID", "Abort", "Y"),
    Flag("221", 2, "00", "MIL records without matching enr record", "Warn", "N", "MPatID"),
    Flag("223", 2, "00", "MIL records without matching enr record", "Warn", "N", "CPatID"),
] + [
    Flag(
        str(370 + b),
        3,
        "00",
        f"Birth_Type ({b}) not consistent with number of linkages; confirmation required",
        "Warn",
        "N",
        "Birth_Type",
    )
    for b in range(1, 6)
] + [
    Flag("394", 3, "00", "Birth_Type= 2-8 and no CPatIDs are linked", "Warn", "N", "Birth_Type"),
    Flag("396", 3, "00", "MPatID not linked to CPatID", "Warn", "N", "MPatID"),
    Flag("397", 3, "00", "CPatID not linked to MPatID", "Warn", "N", "CPatID"),
]

# The published variable rules.
VARIABLE_RULES = [
    VariableRule("MPatID", "01", "C", 20),
    VariableRule("CPatID", "02", "C", 20),
    VariableRule("ADate", "03", "N", 8),
    VariableRule("EncounterID", "04", "C", 20),
    VariableRule("Birth_Type", "05", "N", 8, "birth_type < 1 or birth_type > 8"),
    VariableRule("Age", "06", "N", 8, "age < 10 or age > 54"),
]

# Allowed codes, bounds and identifiers.
LINKED_METHODS = ["RE", "SI", "LA", "BC", "OT"]
UNLINKED_METHODS = ["N1", "N2", "N3", "NA"]
DATE_BOUNDS = ("2010-01-01", "2025-12-31")
BIRTH_TYPES = list(range(1, 9))
AGE_BOUNDS = (10, 54)
IDENTIFIERS = ["mpatid", "cpatid", "patid", "encounterid"]
TABLE_IDS = [
    "mil", "enr", "dem", "dis", "enc", "dia", "pro", "dth", "cod", "lab", "vit", "irx", "txn", "pre", "fac", "pvd",
    "prr", "prs", "fea",
]
WHOLE_MARK = 99999  # printed as the count where the column `whole` is true; a row count may be that number too


def flag(check: str, variable: str | None = None) -> Flag:
    """The lookup row of a check, optionally for one variable."""
    for row in FLAGS:
        if row.check == str(check) and variable in (None, row.variable1):
            return row
    raise KeyError(f"no flag for check {check!r}, variable {variable!r}")


def flags_frame(spark: SparkSession, flags: list[Flag] = FLAGS) -> DataFrame:
    """The lookup as a DataFrame; whether a join broadcasts it is left to its size."""
    schema = (
        "checkid string, tableid string, flagid string, flag_descr string, flag_type string,"
        " abort_yn string, variable1 string, variable2 string, level int"
    )
    rows = [
        (f.check, f.tabid, f.flagid, f.descr, f.flag_type, f.abort_yn, f.variable1, f.variable2, f.level)
        for f in flags
    ]
    return spark.createDataFrame(rows, schema)


def rules_frame(spark: SparkSession, rules: list[VariableRule] = VARIABLE_RULES) -> DataFrame:
    """The variable rules as a DataFrame."""
    schema = (
        "tabid string, variable string, varid string, vartype string, varlength int,"
        " valid_value_type string"
    )
    rows = [(r.tabid, r.variable, r.varid, r.vartype, r.varlength, r.valid_value_type) for r in rules]
    return spark.createDataFrame(rows, schema)
