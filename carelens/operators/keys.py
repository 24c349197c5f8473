"""Duplicate keys and conflicting values.

Keys are counted by an aggregate, which combines copies before the shuffle, and the rows of the
few bad keys are fetched back by a null-safe semi join. A window over the key would put all rows of
a hot key into one task; AQE splits them in the semi join. (It does so only where both sides come
straight from a shuffle. Plain equality would reuse the aggregate's partitioning instead.)
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from carelens.operators import rules


def null_safe(left: DataFrame, right: DataFrame, keys: list[str]) -> Column:
    """Equality on all keys where null equals null."""
    return reduce(
        lambda a, b: a & b, [left[k].eqNullSafe(right["k_" + k]) for k in keys]
    )


def rows_of(df: DataFrame, bad_keys: DataFrame, keys: list[str]) -> DataFrame:
    """Rows of `df` whose key is among `bad_keys`; null keys match null keys."""
    wanted = bad_keys.select(*[F.col(k).alias("k_" + k) for k in keys])
    return df.join(wanted, null_safe(df, wanted, keys), "left_semi")


def repeated(df: DataFrame, keys: list[str]) -> DataFrame:
    """Keys on more than one row, with their row count."""
    return df.groupBy(*keys).agg(F.count("*").alias("n")).where("n > 1")


def surplus_duplicates(df: DataFrame, keys: list[str], tabid: str) -> DataFrame:
    """How many rows repeat an earlier key: the sum of n - 1."""
    n = F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).cast("long")
    return repeated(df, keys).agg(n.alias("count_dup")).select(
        F.lit(tabid.upper()).alias("tabid"), "count_dup"
    )


def duplicate_rows(df: DataFrame, keys: list[str], nulls_equal: bool = True) -> DataFrame:
    """Every row whose key occurs more than once; optionally a null never matches."""
    if not nulls_equal:
        df = df.where(reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in keys]))
    return rows_of(df, repeated(df, keys), keys)


def distinct_keys(df: DataFrame, keys: list[str]) -> DataFrame:
    """The key columns without repeats."""
    return df.select(*keys).distinct()


def unlinked_duplicates(df: DataFrame, keys: list[str]) -> DataFrame:
    """Mothers without infant whose key combination is on more than one row."""
    return duplicate_rows(df.where(rules.unlinked_mother()), keys)


def linked_duplicates(df: DataFrame, keys: list[str]) -> DataFrame:
    """Linked pairs whose key combination is on more than one row."""
    return duplicate_rows(df.where(rules.linked()), keys)


def infant_duplicates(df: DataFrame, keys: list[str]) -> DataFrame:
    """Infants whose key combination is on more than one row."""
    return duplicate_rows(df.where(rules.has_infant()), keys)


def linked_value_conflict(df: DataFrame, variables: list[str]) -> DataFrame:
    """Linked rows, duplicate on the first three variables, whose last variable differs.

    The last variable must take more than one value within the variables before it, counted over
    the duplicate rows only.
    """
    rows = df.where(rules.linked())
    dup_keys, within, last = variables[:3], variables[:-1], variables[-1]
    # one row per duplicate key combination and value of the last variable
    values = rows.groupBy(*dict.fromkeys([*dup_keys, last])).agg(F.count("*").alias("n"))
    if last in dup_keys:
        duplicates = values.where("n > 1")
        differing = duplicates.groupBy(*within).agg(F.countDistinct(last).alias("d")).where("d > 1")
        bad = rows_of(duplicates, differing, within)
    else:
        bad = (
            values.groupBy(*within)
            .agg(F.sum("n").alias("n"), F.count(last).alias("d"))
            .where("n > 1 and d > 1")
        )
    return rows_of(rows, bad, dup_keys)
