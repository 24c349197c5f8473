"""Mother-infant linkage: consistency, derived columns, cross tabs, rates (level 3)."""

from __future__ import annotations

from itertools import combinations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from carelens.functions import formats
from carelens.functions.dates import us_date
from carelens.functions.rulesets import flag
from carelens.operators import rules
from carelens.operators.flags import flag_struct
from carelens.operators.spans import DEALS, PARTS

ALL_CLASSES = [
    "linkagestatus", "birth_type", "year", "yearmonth", "icd_ver", "agegroup", "enctype", "sex",
    "daysdiff", "matchmethod",
]
DELIVERY_CLASSES = [
    "linkagestatus", "birth_type", "year", "yearmonth", "icd_ver", "agegroup", "enctype",
    "infantslinked",
]
ICD10_START = "2015-10-01"  # fixed value


def birth_type_linkage(mil: DataFrame) -> DataFrame:
    """Linked deliveries whose number of distinct infants differs from Birth_Type 1 to 5.

    Tasks hold a fixed share of the rows (PARTS). Infants of one delivery are dealt by their id, so that they are told
    apart in up to DEALS tasks.
    """
    keys = ["mpatid", "adate", "encounterid", "birth_type"]
    dealt = mil.where(rules.linked() & F.col("birth_type").between(1, 5)).select(
        *keys, "cpatid", F.pmod(F.xxhash64("cpatid"), F.lit(DEALS)).alias("_deal")
    )
    first = dealt.repartition(PARTS, *keys, "_deal").groupBy(*keys, "_deal").agg(F.countDistinct("cpatid").alias("crows"))
    infants = first.repartition(PARTS, *keys).groupBy(*keys).agg(F.sum("crows").alias("crows")).where("crows <> birth_type")
    b = F.col("birth_type").cast("string")
    tail = "not consistent with number of linkages; confirmation required"
    message = F.concat(
        F.lit("MPatID ("), "mpatid", F.lit("), EncounterID ("), _text("encounterid"),
        F.lit("), Adate ("), us_date(F.col("adate")), F.lit("), Birth_type ("), b,
        F.lit(f"):Birth_Type value {tail}"),
    )
    return infants.select(
        F.concat(F.lit("MIL_3_00_00-0_37"), b).alias("flagid"),
        F.concat(F.lit("Birth_Type ("), b, F.lit(f") {tail}")).alias("flag_descr"),
        message.alias("message"),
        F.lit("Warn").alias("flag_type"),
        F.lit("N").alias("abort_yn"),
        *keys,
        "crows",
    )


def _text(column: str) -> Column:
    return F.coalesce(F.col(column).cast("string"), F.lit(""))


def linkage_predicates() -> dict[str, Column]:
    """Checks 394 (multiple birth, no infant), 396 (mother only), 397 (infant only)."""
    return {
        "394": F.col("birth_type").between(2, 8) & F.col("cpatid").isNull(),
        "396": rules.unlinked_mother(),
        "397": rules.has_infant() & F.col("mpatid").isNull(),
    }


def linkage_message(check: str) -> Column:
    """Message text of a linkage check."""
    mother = [
        F.lit("MPatid ("), _text("mpatid"), F.lit("), EncounterID ("), _text("encounterid"),
        F.lit("), Adate ("), us_date(F.col("adate")),
    ]
    if check == "394":
        b = F.coalesce(F.col("birth_type").cast("string"), F.lit("."))
        parts = [*mother, F.lit("), Birth_Type ("), b,
                 F.lit("): No linkages were found; confirmation required")]
    elif check == "396":
        parts = [*mother, F.lit("): No linkage to infant was found; confirmation required")]
    else:
        parts = [F.lit("CPatid ("), _text("cpatid"), F.lit("), CBirth_Date ("),
                 us_date(F.col("cbirth_date")),
                 F.lit("): No linkage to mother/delivery was found; confirmation required")]
    return F.concat(*parts)


def linkage_gaps(mil: DataFrame, keep: list[str]) -> DataFrame:
    """Rows of checks 394, 396 and 397, found in one scan."""
    found = linkage_predicates()
    hits = F.array(
        *[F.when(p, F.struct(*flag_struct(flag(c), linkage_message(c)))) for c, p in found.items()]
    )
    any_gap = found["394"] | found["396"] | found["397"]
    return (
        mil.where(any_gap)
        .select(F.explode(hits).alias("hit"), *keep)
        .where("hit is not null")
        .select("hit.*", *keep)
    )


def deliveries_per_encounter(mil: DataFrame) -> DataFrame:
    """Delivery rows per encounter and birth type."""
    return mil.where(rules.has_mother()).groupBy("encounterid", "birth_type").agg(
        F.count("*").alias("n_deliveries")
    )


def over_birth_type(per_encounter: DataFrame) -> DataFrame:
    """Encounters with more delivery rows than their birth type says; a missing type is too low."""
    b = F.col("birth_type")
    return per_encounter.where(b.isNull() | (~b.isin(0, 8, 9) & (F.col("n_deliveries") > b)))


def encounters_by_deliveries(per_encounter: DataFrame) -> DataFrame:
    """Encounters per birth type and number of delivery rows."""
    return per_encounter.groupBy("birth_type", "n_deliveries").agg(
        F.count("encounterid").alias("n_encounterid")
    )


# --- derived columns ------------------------------------------------------------------------


def _calendar(day: Column) -> list[Column]:
    return [F.date_format(day, "yyyy").alias("year"), F.date_format(day, "yyyy-MM").alias("yearmonth")]


def _icd(day: Column) -> Column:
    """9 up to September 2015, and for a missing date; 0 after."""
    return F.when(day >= F.lit(ICD10_START).cast("date"), "0").otherwise("9")


def linkage_columns(mil: DataFrame) -> DataFrame:
    """Every row with its derived class columns."""
    mother, infant = F.col("mpatid").isNotNull(), F.col("cpatid").isNotNull()
    status = F.when(mother & infant, "L").when(mother, "M").when(infant, "C")
    return mil.select(
        "mpatid",
        "cpatid",
        "encounterid",
        status.alias("linkagestatus"),
        "birth_type",
        *_calendar(F.coalesce("adate", "cbirth_date")),
        _icd(F.coalesce("ddate", "adate", "cbirth_date")).alias("icd_ver"),
        formats.linkage_age_group(F.col("age"), F.col("mpatid")).alias("agegroup"),
        "enctype",
        "sex",
        formats.days_diff(F.datediff("cbirth_date", "adate")).alias("daysdiff"),
        "matchmethod",
    )


def delivery_columns(mil: DataFrame) -> DataFrame:
    """One row per mother and encounter, with the number of distinct infants linked to it.

    Of several rows of a delivery the smallest by (adate, birth_type, age, enctype) stands for it.
    One aggregate gives both the row and the count.
    """
    row = ["adate", "birth_type", "age", "enctype"]
    one = mil.where(rules.has_mother()).groupBy("mpatid", "encounterid").agg(
        F.min(F.struct(*row)).alias("d"), F.countDistinct("cpatid").alias("infantslinked")
    )
    d = one.select("mpatid", "encounterid", "d.*", "infantslinked")
    return d.select(
        "mpatid",
        "encounterid",
        F.when(F.col("infantslinked") >= 1, "L").otherwise("M").alias("linkagestatus"),
        "birth_type",
        *_calendar(F.col("adate")),
        _icd(F.col("adate")).alias("icd_ver"),
        formats.linkage_age_group(F.col("age"), F.col("mpatid")).alias("agegroup"),
        "enctype",
        "infantslinked",
    )


# --- cross tab ------------------------------------------------------------------------------


def class_masks(n: int, max_depth: int) -> list[int]:
    """Every choice of at most `max_depth` of n class columns; the first column is the top bit."""
    bits = [1 << i for i in range(n)]
    return [sum(c) for k in range(max_depth + 1) for c in combinations(bits, k)]


def level_name(mask: Column, classes: list[str]) -> Column:
    """Names of the class columns in a mask, top bit first."""
    n = len(classes)
    names = [
        F.when(mask.bitwiseAND(F.lit(1 << (n - 1 - i))) != 0, F.lit(c)) for i, c in enumerate(classes)
    ]
    return F.when(mask == 0, "Overall").otherwise(F.concat_ws("    ", *names))


def class_parents(n: int, max_depth: int) -> dict[int, list[int]]:
    """A few larger choices that contain every wanted one, each with the ones it gives.

    Greedy cover of the choices of `max_depth` columns by choices of two more.
    """
    wanted = class_masks(n, max_depth)
    bits = [1 << i for i in range(n)]
    candidates = [sum(c) for c in combinations(bits, min(n, max_depth + 2))]
    parents: dict[int, list[int]] = {}
    while wanted:
        best = max(candidates, key=lambda p: sum(m & p == m for m in wanted))
        parents[best] = [m for m in wanted if m & best == m]
        wanted = [m for m in wanted if m & best != m]
    return parents


def _grouped(cells: DataFrame, masks: Column, classes: list[str]) -> DataFrame:
    """Cells summed under each mask; a column outside the mask becomes null."""
    n = len(classes)
    spread = cells.select(*classes, "count", F.explode(masks).alias("mask"))
    taken = [
        F.when(F.col("mask").bitwiseAND(F.lit(1 << (n - 1 - i))) != 0, F.col(c)).alias(c)
        for i, c in enumerate(classes)
    ]
    return spread.select("mask", *taken, "count").groupBy("mask", *classes).agg(
        F.sum("count").alias("count")
    )


def cross_tab(df: DataFrame, classes: list[str], max_depth: int = 3) -> DataFrame:
    """Row counts for every combination of at most `max_depth` class columns.

    Missing is a level of its own; a column that takes no part is null and absent from the mask.
    Rows shrink to distinct class combinations, these to a few combinations of two columns more
    than wanted, and only those much smaller cells are multiplied by the many wanted combinations.
    """
    parents = class_parents(len(classes), max_depth)
    cells = df.groupBy(*classes).agg(F.count("*").alias("count"))
    larger = _grouped(cells, F.array(*[F.lit(p) for p in parents]), classes)
    children = F.lit(None).cast("array<int>")
    for parent, masks in parents.items():
        children = F.when(F.col("mask") == parent, F.array(*[F.lit(m) for m in masks])).otherwise(children)
    counted = _grouped(larger, children, classes)
    mask = F.col("mask")
    return counted.select(
        F.when(mask < 100, F.lpad(mask.cast("string"), 3, "0")).otherwise(mask.cast("string")).alias("level"),
        level_name(mask, classes).alias("level_desc"),
        *classes,
        "count",
    )


# --- linkage rates --------------------------------------------------------------------------


def deliveries(mil: DataFrame) -> DataFrame:
    """Distinct infants per mother, encounter, type, birth-type group, age group and year."""
    year = F.coalesce(F.date_format("adate", "yyyy"), F.lit("."))
    return (
        mil.where(rules.has_mother())
        .groupBy(
            "mpatid",
            "encounterid",
            "enctype",
            formats.birth_type(F.col("birth_type")).alias("birth_type"),
            formats.mother_age(F.col("age")).alias("agegroup"),
            year.alias("year"),
        )
        .agg(F.countDistinct("cpatid").alias("infantslinked"))
    )


def linkage_rates(delivered: DataFrame) -> DataFrame:
    """Share of deliveries with a linked infant: overall and by four class columns."""
    classes = ["agegroup", "enctype", "year", "birth_type"]
    cells = delivered.groupBy(*classes).agg(
        F.count("*").alias("n"), F.count_if(F.col("infantslinked") > 0).alias("linked")
    )
    sets = [[], *[[F.col(c)] for c in classes]]
    summed = cells.groupingSets(sets, *classes).agg(
        F.sum("n").alias("deliveries"),
        F.sum("linked").alias("infantslinked"),
        *[F.grouping(c).alias(f"g_{c}") for c in classes],
    )
    sort, variable, value = F.when(F.lit(False), 0), F.when(F.lit(False), ""), F.when(F.lit(False), "")
    for i, c in enumerate(classes, start=2):
        used = F.col(f"g_{c}") == 0
        sort, variable, value = sort.when(used, i), variable.when(used, c), value.when(used, F.col(c))
    return summed.select(
        sort.otherwise(1).alias("tablesort"),
        variable.otherwise("overall").alias("variable"),
        F.when(sort.isNull(), F.lit("overall")).otherwise(value).alias("value"),
        "deliveries",
        "infantslinked",
        (F.col("infantslinked") / F.col("deliveries")).alias("linkagerate"),
    )
