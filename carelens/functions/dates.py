"""Date helpers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def lowest_day() -> Column:
    return F.lit("0001-01-01").cast("date")


def us_date(value: Column) -> Column:
    """MM/dd/yyyy as messages print dates; a missing date prints as a dot."""
    return F.coalesce(F.date_format(value, "MM/dd/yyyy"), F.lit("."))


def or_lowest(value: Column) -> Column:
    """A missing date sorts below every date."""
    return F.coalesce(value, lowest_day())


def complete_years(birth: Column, at: Column) -> Column:
    """Age in full years, by calendar months."""
    months = (F.year(at) - F.year(birth)) * 12 + (F.month(at) - F.month(birth))
    short = F.when(F.day(at) < F.day(birth), 1).otherwise(0)
    return F.floor((months - short) / 12).cast("int")
