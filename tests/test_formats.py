import pytest
from pyspark.sql import functions as F

from carelens.functions import formats
from carelens.functions.dates import complete_years, us_date


@pytest.mark.parametrize(
    "ranges, cases",
    [
        (formats.AGE_YEARS, {-1: "00. Negative", 0: "01. 0-1 yrs", 1: "01. 0-1 yrs", 2: "02. 2-4 yrs", 18: "05. 15-18 yrs",
                             19: "06. 19-21 yrs", 21: "06. 19-21 yrs", 22: "07. 22-44 yrs", 74: "09. 65-74 yrs", 75: "10. 75+ yrs"}),
        (formats.DAYS_DIFF, {-31: "00:< -30 days", -30: "01:-11 through -30 days", -11: "01:-11 through -30 days", -10: "02:-4 through -10 days",
                             -1: "03:-1 through -3 days", 0: "04:0 days", 31: "08:> 30 days"}),
        (formats.AGE_DAYS, {-1: "01. < 0 days", 30: "02. 0-30 days", 31: "03. 31-60 days", 365: "07. 271-365 days", 366: "08. >= 366 days"}),
        (formats.FIVE_YEAR_AGE, {-1: "<0", 1: "00-01", 4: "02-04", 5: "05-09", 79: "75-79", 80: "80+"}),
        (formats.RECORD_COUNT, {1: "1", 4: "4", 5: ">4", 99: ">4"}),
        (formats.BIRTH_TYPE, {0: "0= Unspecified number of live births", 5: "5-8= Multiple live births, unspecified number",
                              9: "9= Conflicting code(s) for number of live births"}),
    ],
)
def test_bucket_bounds(spark, ranges, cases):
    df = spark.createDataFrame([(k, v) for k, v in cases.items()], "x int, want string")
    assert df.where(formats.bucket(F.col("x"), ranges) != F.col("want")).count() == 0


def test_values_outside_every_range(spark):
    df = spark.createDataFrame([(9,), (55,), (None,)], "x int")
    got = [r[0] for r in df.select(formats.mother_age(F.col("x"))).collect()]
    assert got == ["9", "55", "."]


def test_age_sort_repeats_one_number():
    assert formats.AGE_SORT[formats.PEDIATRIC_1] == formats.AGE_SORT[formats.PEDIATRIC_2] == 20
    assert [formats.AGE_SORT[k] for k in ("<0", "80+", formats.YOUNG_ADULT, formats.CHILDBEARING)] == [1, 19, 21, 22]


def test_age_group_of_infants_and_missing_ages(spark):
    df = spark.createDataFrame([("M", 10), ("M", None), (None, 30), ("M", 60)], "mpatid string, age int")
    got = [r[0] for r in df.select(formats.linkage_age_group(F.col("age"), F.col("mpatid"))).collect()]
    assert got == ["10-19", "Other", "Infants", "Other"]


def test_complete_years_and_us_date(spark):
    df = spark.sql("SELECT DATE '2000-02-29' b, DATE '2020-02-28' a UNION ALL SELECT DATE '2000-02-29', DATE '2020-02-29' UNION ALL SELECT NULL, NULL")
    got = [tuple(r) for r in df.select(complete_years(F.col("b"), F.col("a")), us_date(F.col("a"))).collect()]
    assert got == [(19, "02/28/2020"), (20, "02/29/2020"), (None, ".")]
