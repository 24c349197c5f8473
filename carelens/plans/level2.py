"""Level 2 of a review: keys and rules of the linkage table, then its agreement with other tables."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from carelens.functions.rulesets import (
    BIRTH_TYPES,
    DATE_BOUNDS,
    LINKED_METHODS,
    UNLINKED_METHODS,
    Flag,
    flag,
)
from carelens.operators import cross, keys, linkage, rules, spans, summary
from carelens.operators import flags as fl
from carelens.sources.tables import Tables, table, union_all

DETAIL = ["mpatid", "cpatid", "encounterid", "adate"]
# The date that places a row of a table in time.
DATES = {"enr": "enr_start", "enc": "adate", "dis": "rxdate", "vit": "measure_date"}


# How messages write the columns' names.
NAMES = {
    "mpatid": "MPatID", "cpatid": "CPatID", "encounterid": "EncounterID", "enctype": "EncType", "adate": "ADate", "sex": "Sex",
    "cbirth_date": "CBirth_Date", "mbirth_date": "MBirth_Date", "matchmethod": "Match_Method",
}


def _named(columns: list[str], text: str, colon: str = ": ") -> Column:
    """A message that lists columns with their values, dates as month/day/year, and says what is wrong."""
    listed = []
    for c in columns:
        value = F.coalesce(F.date_format(F.col(c), "MM/dd/yyyy") if "date" in c else F.trim(F.col(c).cast("string")), F.lit(""))
        listed.append(F.concat(F.lit(f"{NAMES.get(c, c)} ("), value, F.lit(")")))
    return F.concat(F.concat_ws(", ", *listed), F.lit(colon + text))


def _l2(check: str, descr: str, abort: str = "N", varid: str = "00") -> Flag:
    return Flag(check, 2, varid, descr, "Abort" if abort == "Y" else "Warn", abort)


@dataclass
class LinkageRules:
    """Which columns each check looks at; sites may differ in the columns they hold."""

    unlinked_keys: list[list[str]] = field(
        default_factory=lambda: [["mpatid", "encounterid", "adate", "mbirth_date"]]
    )
    linked_keys: list[list[str]] = field(
        default_factory=lambda: [["mpatid", "cpatid", "encounterid", "enctype"]]
    )
    conflicts: list[list[str]] = field(
        default_factory=lambda: [["mpatid", "adate", "encounterid", "sex"]]
    )
    infant_keys: list[list[str]] = field(default_factory=lambda: [["cpatid", "cbirth_date", "sex"]])
    requires: list[tuple[str, str]] = field(default_factory=lambda: [("encounterid", "adate")])
    ordered: list[tuple[str, str]] = field(default_factory=lambda: [("adate", "ddate")])


def row_rules(r: LinkageRules) -> list[tuple[Flag, Column]]:
    """All one-row checks, to be evaluated in one pass."""
    return [
        (_l2("274", "Linked row with invalid MatchMethod"),
         rules.linked() & rules.code_outside("matchmethod", LINKED_METHODS)),
        (_l2("275", "Unlinked row with invalid MatchMethod"),
         rules.not_linked() & rules.code_outside("matchmethod", UNLINKED_METHODS)),
        *[(_l2("221", f"{a} is filled but {b} is not"), rules.requires(a, b)) for a, b in r.requires],
        *[(_l2("226", f"{a} is later than {b}"), rules.after(a, b)) for a, b in r.ordered],
        (_l2("254", "Mother is born less than 10 years before the child"),
         rules.min_gap_years("mbirth_date", "cbirth_date")),
        (_l2("255", "Child is born outside the delivery stay"),
         rules.birth_window("adate", "cbirth_date", "ddate")),
        (_l2("257", "Linked row lacks the child's birth date or MatchMethod"),
         rules.linked_requires("cbirth_date", "matchmethod")),
        (_l2("280", "First enrollment more than 180 days after delivery"),
         rules.max_gap_days("cenr_start", "adate")),
    ]


def one_table(mil: DataFrame, r: LinkageRules | None = None) -> Tables:
    """Duplicates, conflicts and row rules as flagged rows; delivery counts as an aggregate."""
    r = r or LinkageRules()
    found = [fl.row_checks(mil, row_rules(r), DETAIL)]

    def add(rows: DataFrame, f: Flag, message: Column) -> None:
        found.append(fl.with_flag(rows, f, message).select(*fl.FLAG_COLUMNS, *DETAIL))

    for k in r.unlinked_keys:
        told = _named(k, "Not linked, but variable combination appears on > 1 row")
        add(keys.unlinked_duplicates(mil, k), _l2("217", "Unlinked mother on more than one row", "Y"), told)
    for k in r.linked_keys:
        told = F.concat(F.lit("Linked: "), _named(k, "but variable combination appears on > 1 row", ":"))
        add(keys.linked_duplicates(mil, k), _l2("218", "Linked pair on more than one row", "Y"), told)
    for k in r.conflicts:
        told = F.concat(F.lit("Linked: "), _named(k[:-1], f"{NAMES.get(k[-1], k[-1])} values differ across rows"))
        add(keys.linked_value_conflict(mil, k), _l2("219", f"{k[-1]} differs across rows", "Y"), told)
    for k in r.infant_keys:
        add(keys.infant_duplicates(mil, k), _l2("272", "Infant on more than one row"), _named(k, "Must appear on only 1 row"))
    per_encounter = linkage.deliveries_per_encounter(mil)
    over = linkage.over_birth_type(per_encounter)
    found.append(fl.with_flag(over, _l2("223", "More delivery rows than the birth type says")))
    return {
        "l2_mstr": union_all(found),
        "mil_l2_encid_btype_delivct": over,
        "mil_l2_nencid_btype_delivct": linkage.encounters_by_deliveries(per_encounter),
    }


def across_tables(tables: Tables) -> Tables:
    """Ids the other tables lack, attributes that differ, and days from birth to enrollment."""
    mil, found, out = table(tables, "mil"), [], {}
    if "enr" in tables:
        lost = cross.not_in_reference(mil, tables["enr"], {"mpatid": "patid"})
        found.append(fl.with_flag(lost, _l2("201", "Mother not found in enrollment", "Y")))
    for name, on in {"del": ["mpatid", "encounterid"], "inf": ["cpatid"]}.items():
        if name in tables:
            status = cross.id_file_status(mil, tables[name], on)
            out[f"mil_idfilestatus_{on[0]}_mstr"] = status
            extra = F.struct(*fl.flag_struct(_l2("201", f"Id not found in {name}", "Y")))
            absent = F.struct(*fl.flag_struct(_l2("202", f"Id of {name} not found", "Y")))
            hit = F.when(F.col("idfilestatus") == "E", extra).otherwise(absent)
            found.append(status.select(hit.alias("hit"), *on).select("hit.*", *on))
    if "dem" in tables:
        recode = F.when(F.upper("sex").isin("A", "U"), "O").otherwise(F.col("sex"))
        sex = cross.attribute_mismatch(mil, tables["dem"], ("mpatid", "patid"), ("sex", "sex"), recode)
        found.append(fl.with_flag(sex, _l2("208", "sex differs from demographics", "Y")))
    out["mil_l2_cenrstart_agedays_cat"] = cross.days_to_enrollment(mil)
    if found:
        out["l2_cross_mstr"] = union_all(found)
    return out


def span_states(enr: DataFrame) -> Tables:
    """Every distinct enrollment span with its state, the working table of `enrollment`."""
    return {"enr_l2_states_mstr": spans.classified(enr)}


def enrollment(states: DataFrame) -> Tables:
    """Overlapping, unbridged and invalid enrollment spans, from the written states."""
    flagged = spans.flagged(states)
    found = [
        fl.with_flag(flagged, Flag("215", 2, "00", "Overlapping enrollment spans", tabid="ENR")),
        fl.with_flag(
            spans.unbridged(spans.unflagged(states)), Flag("216", 2, "00", "Consecutive spans not bridged", tabid="ENR")
        ),
        fl.with_flag(
            states.where("state = 'invalid'").select(*spans.SPAN_KEYS),
            Flag("226", 2, "00", "Span ends before it starts", tabid="ENR"),
        ),
    ]
    return {"enr_l2_mstr": union_all(found), "enr_l2_overlap": spans.overlap_summary(flagged)}


def aggregates(tables: Tables) -> Tables:
    """What level 2 publishes beside flags: surplus keys, presence of patients in tables and what lacks where, value
    lengths, complete months and percentiles of dates."""
    mil, out = table(tables, "mil"), {}
    found = [keys.surplus_duplicates(mil, ["mpatid", "cpatid", "adate"], "mil")]
    if "enr" in tables:
        found.append(keys.surplus_duplicates(tables["enr"], spans.SPAN_KEYS, "enr"))
    out["l2_surplus_duplicates"] = union_all(found)
    patients = {n: (tables[n], "patid") for n in ("enr", "dem", "enc", "dis", "lab", "vit", "dth", "cod") if n in tables}
    if len(patients) > 1:
        out["l2_presence_matrix"] = cross.presence_matrix(patients)
        out["l2_value_lengths"] = cross.value_lengths({n: df for n, (df, _) in patients.items()}, "patid")
    dated = {n: (tables[n], d) for n, d in DATES.items() if n in tables}
    out["l2_completeness"] = summary.completeness({"mil": (mil, "adate"), **dated})
    days = mil.groupBy("adate").agg(F.count("*").alias("n"))
    out["l2_adate_percentiles"] = summary.date_percentiles(days, ["adate"])
    return out


def patterns(matrix: DataFrame, lengths: DataFrame) -> Tables:
    """For each two tables, the patients that one has and the other lacks, from the written presence matrix, and the
    lengths of patient ids that one has and the other lacks, from the written lengths."""
    names = [c for c in matrix.columns if c not in ("dp", "count")]
    pairs = [(a, b) for a in names for b in names if a != b]
    once = [(a, b) for a, b in pairs if a < b]
    return {
        "l2_pattern_counts": cross.pattern_counts(matrix, pairs),
        "l2_value_length_differences": cross.value_length_differences(lengths, once, "patid"),
    }


def results(written: Tables, only_abort: bool = False) -> Tables:
    """Flag counts over the written masters of flagged rows; of an aborted level, those of abort flags alone."""
    flagged = [df for df in written.values() if "flagid" in df.columns]
    if only_abort:
        flagged = [df.where("abort_yn = 'Y'") for df in flagged]
    return {"all_l2_flags": fl.roll_up([fl.count_rows(f) for f in flagged])}


def port_checks(spark: SparkSession, tables: Tables) -> dict[str, DataFrame]:
    """The other reading of the level 2 ids: plain key, bound, domain, reference and span checks."""
    mil, enr = table(tables, "mil"), table(tables, "enr")
    dup = {
        "211": ["mpatid", "cpatid", "adate"],
        "217": ["mpatid", "adate", "encounterid"],
        "218": ["mpatid", "adate"],
        "219": ["cpatid"],
    }
    out = {
        c: fl.with_flag(keys.duplicate_rows(mil, k, nulls_equal=False).select(*DETAIL), flag(c))
        for c, k in dup.items()
    }
    by_row = [
        (flag("201"), rules.out_of_range("adate", *DATE_BOUNDS)),
        (flag("204"), rules.outside_domain("birth_type", BIRTH_TYPES)),
    ]
    out["201_204"] = fl.row_checks(mil, by_row, DETAIL)
    lost = cross.rows_not_in_reference(mil, enr, "mpatid", "patid")
    out["221"] = fl.with_flag(lost.select(*DETAIL), flag("221"))
    if "cpatid" in enr.columns:
        lost = cross.rows_not_in_reference(mil, enr, "cpatid", "cpatid")
        out["223"] = fl.with_flag(lost.select(*DETAIL), flag("223"))
    pairs = spans.outside_span_pairs(mil, enr.withColumnRenamed("patid", "mpatid"), ["mpatid"], "adate")
    out["200"] = fl.with_flag(pairs, flag("200"))
    return out
