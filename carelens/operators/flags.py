"""Flag columns, messages and counts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from carelens.functions.rulesets import WHOLE_MARK, Flag
from carelens.operators.spans import DEALS, PARTS
from carelens.sources.tables import union_all

FLAG_COLUMNS = ["flagid", "flag_descr", "message", "flag_type", "abort_yn"]
COUNT_KEYS = ["flagid", "abort_yn", "flag_type", "flag_descr"]


def flag_struct(flag: Flag, message: Column | None = None) -> list[Column]:
    """The five flag columns as literals."""
    return [
        F.lit(flag.flagid).alias("flagid"),
        F.lit(flag.descr).alias("flag_descr"),
        (F.lit("") if message is None else message).alias("message"),
        F.lit(flag.flag_type).alias("flag_type"),
        F.lit(flag.abort_yn).alias("abort_yn"),
    ]


def with_flag(df: DataFrame, flag: Flag, message: Column | None = None) -> DataFrame:
    """Flagged rows with the flag columns in front."""
    return df.select(*flag_struct(flag, message), "*")


def row_checks(df: DataFrame, checks: list[tuple[Flag, Column]], keep: list[str]) -> DataFrame:
    """Many row predicates in one pass: one output row per row and predicate that holds.

    Rows that break no rule, nearly all of them, are filtered before anything is built.
    """
    holds = [F.coalesce(p, F.lit(False)) for _, p in checks]
    any_hold = holds[0]
    for h in holds[1:]:
        any_hold = any_hold | h
    hits = F.array(*[F.when(h, F.struct(*flag_struct(f))) for (f, _), h in zip(checks, holds)])
    return (
        df.where(any_hold)
        .select(F.explode(hits).alias("hit"), *keep)
        .where(F.col("hit").isNotNull())
        .select("hit.*", *keep)
    )


def count_messages(flagged: DataFrame) -> DataFrame:
    """Rows per flag and message. Nearly every message differs, so tasks hold a fixed share of them (PARTS).

    Rows of one message are dealt by where they come from, so that they meet in up to DEALS tasks before the last one.
    """
    keys = ["flagid", "message", "flag_descr", "flag_type", "abort_yn"]
    dealt = flagged.select(*keys, F.pmod(F.spark_partition_id(), F.lit(DEALS)).alias("_deal"))
    first = dealt.repartition(PARTS, "message", "_deal").groupBy(*keys, "_deal").agg(F.count("*").alias("count"))
    return first.repartition(PARTS, "message").groupBy(*keys).agg(F.sum("count").alias("count"))


def count_rows(flagged: DataFrame) -> DataFrame:
    """Rows per flag, whatever their message."""
    return flagged.groupBy(*COUNT_KEYS).agg(F.count("*").alias("count"))


def _whole(df: DataFrame) -> Column:
    """Whether a row's flag is about a whole table or column; its count is then the mark, no number of rows."""
    return F.coalesce(F.col("whole"), F.lit(False)) if "whole" in df.columns else F.lit(False)


def _total(count: str = "count") -> list[Column]:
    """Sum of the row counts; the mark if any of the rows is about a whole table or column."""
    rows = F.coalesce(F.sum(F.when(~F.col("whole"), F.col(count))), F.lit(0))
    return [F.when(F.max("whole"), F.lit(WHOLE_MARK)).otherwise(rows).cast("long").alias("count"), F.max("whole").alias("whole")]


def count_flags(
    rows: DataFrame, lookup: DataFrame, on: list[str], count_column: str | None = None
) -> DataFrame:
    """Rows per flag: counted (or their `count_column` summed) by `on`, then named by the lookup.

    The rows shrink to one per key before the join. `on` may name one table or two. Keys that the
    lookup lacks stay, together, as one row without flag attributes.
    """
    marked = rows.withColumn("whole", _whole(rows)).withColumn("n", F.col(count_column) if count_column else F.lit(1))
    totals = marked.groupBy(*on).agg(*_total("n"))
    return totals.join(lookup, on, "left").groupBy(*COUNT_KEYS).agg(*_total())


def roll_up(frames: list[DataFrame]) -> DataFrame:
    """Total count per flag over the outputs of several levels; a whole-table flag stays one."""
    both = union_all([f.select(*COUNT_KEYS, "count", _whole(f).alias("whole")) for f in frames])
    return both.where("count > 0 or whole").groupBy(*COUNT_KEYS).agg(*_total())


def flag_master(rows: DataFrame, lookup: DataFrame) -> DataFrame:
    """Distinct flag, value and ids, with the lookup's description."""
    names = lookup.select("flagid", "flag_descr", "flag_type", "abort_yn", "variable1")
    distinct = rows.select("flagid", "value", "mpatid", "cpatid").distinct()
    return distinct.join(names, "flagid", "left")


def roll_up_values(rows: DataFrame) -> DataFrame:
    """Count per flag, variable and value; a flag about the whole table or column keeps its mark."""
    return rows.withColumn("whole", _whole(rows)).groupBy("flagid", "variable", "value").agg(*_total())


def count_types(rows: DataFrame, check: str, patient: str = "patid") -> DataFrame:
    """Flagged records and distinct patients as two rows."""
    one = rows.agg(
        F.countDistinct(patient).alias("patients"), F.count("*").alias("records")
    )
    pairs = F.array(
        F.struct(F.lit("Unique PatID").alias("count_type"), F.col("patients").alias("count")),
        F.struct(F.lit("Records").alias("count_type"), F.col("records").alias("count")),
    )
    return one.select(F.lit(check).alias("checkid"), F.inline(pairs))
