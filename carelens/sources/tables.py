"""Tables by name, split tables, and stacking of result tables."""

from __future__ import annotations

import re
from collections.abc import Mapping
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

Tables = dict[str, DataFrame]


def read_tables(spark: SparkSession, paths: Mapping[str, str | list[str]]) -> Tables:
    """One DataFrame per name; a name given several paths is one physically split table."""
    return {
        name.lower(): spark.read.parquet(*([where] if isinstance(where, str) else where))
        for name, where in paths.items()
    }


def table(tables: Tables, name: str) -> DataFrame:
    """A table by name, in any case."""
    try:
        return tables[name.lower()]
    except KeyError:
        raise KeyError(f"table {name!r} not found; have {sorted(tables)}") from None


def union_all(frames: list[DataFrame]) -> DataFrame:
    """Rows of all frames; a column some frame lacks is null there."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def merge_split(tables: Tables, root: str) -> DataFrame:
    """Union of `root1`, `root2`, ... or `root` itself when it is not split."""
    parts = [t for n, t in tables.items() if re.fullmatch(rf"{re.escape(root.lower())}\d+", n)]
    return union_all(parts) if parts else table(tables, root)


def stack(tables: Tables, prefix: str) -> DataFrame:
    """Rows of every table whose name starts with `prefix`."""
    found = [t for n, t in sorted(tables.items()) if n.startswith(prefix.lower())]
    if not found:
        raise KeyError(f"no table starts with {prefix!r}; have {sorted(tables)}")
    return union_all(found)


def stack_as_text(tables: Tables, prefix: str, column: str = "value") -> DataFrame:
    """`stack` for tables whose `column` has different types: it becomes text first."""
    texts = {n: t.withColumn(column, F.col(column).cast("string")) for n, t in tables.items()
             if n.startswith(prefix.lower())}
    return stack(texts, prefix)


def blank_to_null(df: DataFrame, *columns: str) -> DataFrame:
    """A blank or all-space string counts as missing; trailing padding is cut."""
    return df.withColumns(
        {c: F.when(F.trim(c) != "", F.rtrim(F.col(c))) for c in columns}
    )


def iso_dates(df: DataFrame, *columns: str) -> DataFrame:
    """ISO text to dates; text that is no date becomes null."""
    return df.withColumns({c: F.col(c).try_cast("date") for c in columns})


def lower_columns(df: DataFrame, *columns: str) -> DataFrame:
    """The listed columns in lower case."""
    return df.withColumns({c: F.lower(c) for c in columns})
