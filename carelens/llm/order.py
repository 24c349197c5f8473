"""Places of rows within their group, without a window over a whole group."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from carelens.llm.common import Work


def numbered(work: Work, rows: DataFrame, group: list[str], order: list[str], name: str) -> DataFrame:
    """rows with `place`, their number within the group from 0 in ascending order (null first), and `n`, its rows.

    One range sort deals out all rows, so a group of very many rows is cut over many tasks; a place is the row's number
    in its range and what the group has in earlier ranges. The only window sees a row per group and range. Rows that are
    equal in group and order are told apart by where they were read, so many of them are cut, too; which of them comes
    first is open. Columns may not be called place, n or start with `_`. No rows: no rows.
    """
    keys = [*group, *order, "_read"]
    cut = rows.withColumn("_read", F.monotonically_increasing_id()).repartitionByRange(*keys).sortWithinPartitions(*keys)
    cut = work.keep(cut.drop("_read").withColumns({"_range": F.spark_partition_id(), "_at": F.monotonically_increasing_id()}), name)
    ranges = cut.groupBy(*group, "_range").agg(F.count("*").alias("_rows"), F.min("_at").alias("_first"))
    all_of, before = Window.partitionBy(*group), Window.partitionBy(*group).orderBy("_range")
    ranges = ranges.select(
        *[F.col(g).alias(f"_{g}") for g in group],
        F.col("_range").alias("_in"),
        (F.sum("_rows").over(before) - F.col("_rows") - F.col("_first")).alias("_shift"),
        F.sum("_rows").over(all_of).alias("n"),
    )
    same = [F.col("_range") == F.col("_in"), *[F.col(g).eqNullSafe(F.col(f"_{g}")) for g in group]]
    joined = cut.join(ranges, same).withColumn("place", F.col("_at") + F.col("_shift"))
    return joined.select(*rows.columns, "place", "n")
