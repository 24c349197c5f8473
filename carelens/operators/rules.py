"""Row predicates (level 2, one table).

Each function gives the predicate; `flags.row_checks` evaluates many in one pass, `hits` one.
A predicate over missing values is null, which counts as "not flagged" unless said otherwise.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def hits(df: DataFrame, predicate: Column) -> DataFrame:
    """Rows for which the predicate holds."""
    return df.where(predicate)


def linked() -> Column:
    """Mother and infant both present."""
    return F.col("mpatid").isNotNull() & F.col("cpatid").isNotNull()


def not_linked() -> Column:
    """Mother or infant absent."""
    return F.col("mpatid").isNull() | F.col("cpatid").isNull()


def unlinked_mother() -> Column:
    return F.col("mpatid").isNotNull() & F.col("cpatid").isNull()


def has_infant() -> Column:
    return F.col("cpatid").isNotNull()


def has_mother() -> Column:
    return F.col("mpatid").isNotNull()


def code_outside(column: str, allowed: list[str]) -> Column:
    """Code not in the list after trimming and upper-casing; a missing code is outside."""
    return ~F.coalesce(F.upper(F.trim(column)).isin(allowed), F.lit(False))


def out_of_range(column: str, low: str, high: str) -> Column:
    """Date before `low` or after `high`."""
    day = F.col(column)
    return (day < F.lit(low).cast("date")) | (day > F.lit(high).cast("date"))


def outside_domain(column: str, allowed: list) -> Column:
    """Value not in the list; a missing value passes."""
    return F.col(column).isNotNull() & ~F.col(column).isin(allowed)


def requires(first: str, second: str) -> Column:
    """`first` is filled but `second` is not."""
    return F.col(first).isNotNull() & F.col(second).isNull()


def min_gap_years(first: str, second: str, years: int = 10) -> Column:
    """`first` lies after `second`, or less than `years` before it."""
    return (F.col(first) > F.col(second)) | (F.datediff(second, first) / 365.25 < years)


def birth_window(admitted: str, birth: str, discharged: str) -> Column:
    """Birth not within 3 days before admission to discharge (or to 1 day after admission)."""
    last = F.coalesce(F.col(discharged), F.date_add(admitted, 1))
    return (F.col(birth) < F.date_sub(admitted, 3)) | (F.col(birth) > last)


def linked_requires(first: str, second: str) -> Column:
    """A linked row lacks one of two values."""
    return linked() & (F.col(first).isNull() | F.col(second).isNull())


def max_gap_days(first: str, second: str, days: int = 180) -> Column:
    """`first` more than `days` after `second`."""
    return F.datediff(first, second) > days


def after(first: str, second: str) -> Column:
    """`first` later than `second`, both filled."""
    return F.col(first) > F.col(second)


def before(first: str, second: str) -> Column:
    """`first` earlier than `second`, both filled."""
    return F.col(first) < F.col(second)


def condition(text: str) -> Column:
    """A predicate given as SQL text in a rule table."""
    return F.expr(text)
