"""Value buckets: ordered ranges with a label, turned into one CASE expression."""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column
from pyspark.sql import functions as F


class Range(NamedTuple):
    low: float | None  # None: open below
    high: float | None  # None: open above
    label: str
    high_open: bool = False  # the upper bound itself does not belong


def bucket(
    value: Column, ranges: list[Range], missing: str | None = None, other: Column | None = None
) -> Column:
    """Label of the first range that holds `value`; `missing` for null, else `other`."""
    out = F.when(value.isNull(), F.lit(missing))
    for r in ranges:
        inside = F.lit(True)
        if r.low is not None:
            inside = inside & (value >= r.low)
        if r.high is not None:
            inside = inside & ((value < r.high) if r.high_open else (value <= r.high))
        out = out.when(inside, F.lit(r.label))
    return out.otherwise(F.lit(None).cast("string") if other is None else other)


def raw(value: Column) -> Column:
    """A value outside every range prints as itself."""
    return value.cast("string")


# Ranges and labels of the published formats.
AGE_YEARS = [
    Range(None, 0, "00. Negative", True),
    Range(0, 2, "01. 0-1 yrs", True),
    Range(2, 5, "02. 2-4 yrs", True),
    Range(5, 10, "03. 5-9 yrs", True),
    Range(10, 15, "04. 10-14 yrs", True),
    Range(15, 19, "05. 15-18 yrs", True),
    Range(19, 22, "06. 19-21 yrs", True),
    Range(22, 45, "07. 22-44 yrs", True),
    Range(45, 65, "08. 45-64 yrs", True),
    Range(65, 75, "09. 65-74 yrs", True),
    Range(75, None, "10. 75+ yrs"),
]
AGE_DAYS = [
    Range(None, 0, "01. < 0 days", True),
    Range(0, 30, "02. 0-30 days"),
    Range(31, 60, "03. 31-60 days"),
    Range(61, 120, "04. 61-120 days"),
    Range(121, 180, "05. 121-180 days"),
    Range(181, 270, "06. 181-270 days"),
    Range(271, 365, "07. 271-365 days"),
    Range(366, None, "08. >= 366 days"),
]
MISSING = "00. Missing"
DAYS_DIFF = [
    Range(None, -31, "00:< -30 days"),
    Range(-30, -11, "01:-11 through -30 days"),
    Range(-10, -4, "02:-4 through -10 days"),
    Range(-3, -1, "03:-1 through -3 days"),
    Range(0, 0, "04:0 days"),
    Range(1, 3, "05:1 through 3 days"),
    Range(4, 10, "06:4 through 10 days"),
    Range(11, 30, "07:11 through 30 days"),
    Range(31, None, "08:> 30 days"),
]
DAYS_DIFF_MISSING = "09:NA"
MOTHER_AGE = [Range(10, 19, "10-19"), Range(20, 44, "20-44"), Range(45, 54, "45-54")]
BIRTH_TYPE = [
    Range(0, 0, "0= Unspecified number of live births"),
    Range(1, 1, "1= 1 live birth"),
    Range(2, 2, "2= 2 live births"),
    Range(3, 3, "3= 3 live births"),
    Range(4, 4, "4= 4 live births"),
    Range(5, 8, "5-8= Multiple live births, unspecified number"),
    Range(9, 9, "9= Conflicting code(s) for number of live births"),
]
RECORD_COUNT = [
    Range(None, 1, "1"),
    Range(2, 2, "2"),
    Range(3, 3, "3"),
    Range(4, 4, "4"),
    Range(5, None, ">4"),
]
FIVE_YEAR_AGE = [
    Range(None, 0, "<0", True),
    Range(0, 1, "00-01"),
    Range(2, 4, "02-04"),
    Range(5, 9, "05-09"),
    Range(10, 14, "10-14"),
    Range(15, 19, "15-19"),
    Range(20, 24, "20-24"),
    Range(25, 29, "25-29"),
    Range(30, 34, "30-34"),
    Range(35, 39, "35-39"),
    Range(40, 44, "40-44"),
    Range(45, 49, "45-49"),
    Range(50, 54, "50-54"),
    Range(55, 59, "55-59"),
    Range(60, 64, "60-64"),
    Range(65, 69, "65-69"),
    Range(70, 74, "70-74"),
    Range(75, 79, "75-79"),
    Range(80, None, "80+"),
]
PEDIATRIC_1 = "0-18 (Pediatric Populations I)"
PEDIATRIC_2 = "0-21 (Pediatric Populations II)"
YOUNG_ADULT = "0-<26 (Young Adult Coverage Eligible)"
CHILDBEARING = "10-54 & Sex = F (Childbearing Age)"
# The first two extra categories share a sort number.
AGE_SORT = {r.label: i for i, r in enumerate(FIVE_YEAR_AGE, start=1)} | {
    PEDIATRIC_1: 20,
    PEDIATRIC_2: 20,
    YOUNG_ADULT: 21,
    CHILDBEARING: 22,
}
OVERLAP = {"D": "Duplicate", "O": "Overlap", "S": "Subset"}


def age_years(value: Column) -> Column:
    return bucket(value, AGE_YEARS, MISSING)


def age_days(value: Column) -> Column:
    return bucket(value, AGE_DAYS, MISSING)


def days_diff(value: Column) -> Column:
    return bucket(value, DAYS_DIFF, DAYS_DIFF_MISSING)


def mother_age(value: Column) -> Column:
    return bucket(value, MOTHER_AGE, ".", raw(value))


def birth_type(value: Column) -> Column:
    return bucket(value, BIRTH_TYPE, ".", raw(value))


def record_count(value: Column) -> Column:
    return bucket(value, RECORD_COUNT)


def five_year_age(value: Column) -> Column:
    return bucket(value, FIVE_YEAR_AGE)


def linkage_age_group(age: Column, mpatid: Column) -> Column:
    """Age group of a linkage row: rows without a mother are infants, odd or null ages 'Other'."""
    return F.when(mpatid.isNull(), F.lit("Infants")).otherwise(
        bucket(age, MOTHER_AGE, "Other", F.lit("Other"))
    )
