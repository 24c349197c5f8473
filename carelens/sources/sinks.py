"""Result zones: row-level results with identifiers, aggregate results without."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from carelens.functions.rulesets import IDENTIFIERS
from carelens.sources.tables import Tables, union_all

FLAG_COLUMNS = ["flagid", "flag_descr", "message", "flag_type", "abort_yn"]
FLAG_SCHEMA = ", ".join(f"{c} string" for c in FLAG_COLUMNS)
ROW_ZONE = "row_level"
AGGREGATE_ZONE = "aggregate"
WORK_ZONE = "working"
# Local working tables that are not published.
NOT_PUBLISHED = [
    "all_l1_flags",
    "all_l1_flags_mstr",
    "l2_mstr",
    "all_l3_flags_mstr",
    "all_l2_flags",
    "mil_l2_encid_btype_delivct",
]


def to_flag_schema(df: DataFrame) -> DataFrame:
    """Only the five flag columns, as text."""
    return df.select(*[F.col(c).cast("string").alias(c) for c in FLAG_COLUMNS])


def align_flags(spark: SparkSession, frames: list[DataFrame]) -> DataFrame:
    """All flag rows under one schema: columns by name, absent ones null."""
    if not frames:
        return spark.createDataFrame([], FLAG_SCHEMA)
    both = union_all(frames)
    return both.select(*sorted(both.columns))


def write_row_flags(spark: SparkSession, frames: list[DataFrame], out_dir: str) -> str:
    """Write row-level flags; with no results an empty file with the flag columns is left."""
    path = f"{out_dir}/{ROW_ZONE}/flags"
    align_flags(spark, frames).write.mode("overwrite").parquet(path)
    return path


def _field_names(schema: T.DataType) -> list[str]:
    if isinstance(schema, T.StructType):
        return [n for f in schema.fields for n in [f.name, *_field_names(f.dataType)]]
    if isinstance(schema, T.ArrayType):
        return _field_names(schema.elementType)
    if isinstance(schema, T.MapType):
        return _field_names(schema.keyType) + _field_names(schema.valueType)
    return []


def refuse_identifiers(df: DataFrame) -> DataFrame:
    """Raise when a column, at any depth and in any case, identifies a person or encounter."""
    found = [n for n in _field_names(df.schema) if n.lower() in IDENTIFIERS]
    if found:
        raise ValueError(f"aggregate output must not carry identifier columns, found {found}")
    return df


def write_aggregate(df: DataFrame, out_dir: str, name: str) -> str:
    """Write an aggregate table after the identifier guard."""
    path = f"{out_dir}/{AGGREGATE_ZONE}/{name}"
    refuse_identifiers(df).write.mode("overwrite").parquet(path)
    return path


def write_aggregate_flags(spark: SparkSession, frames: list[DataFrame], out_dir: str) -> str:
    """Write aggregate flags; each input is guarded before it is stacked."""
    return write_aggregate(
        align_flags(spark, [refuse_identifiers(f) for f in frames]), out_dir, "flags"
    )


def add_partner(df: DataFrame, partner: str) -> DataFrame:
    """Put the data partner's id first, unless the table already has it."""
    if "dp" in [c.lower() for c in df.columns]:
        return df
    return df.select(F.lit(partner.upper()).alias("dp"), "*")


def publishable(tables: Tables, partner: str, deny: list[str] = NOT_PUBLISHED) -> Tables:
    """Working tables that may leave the site, with the partner id and past the guard."""
    return {
        name: refuse_identifiers(df if "signature" in name else add_partner(df, partner))
        for name, df in tables.items()
        if "mstr" not in name and name not in deny
    }


def publish(tables: Tables, partner: str, out_dir: str, deny: list[str] = NOT_PUBLISHED) -> list[str]:
    """Write every publishable table and publish them together; where they lie. One that fails keeps all back."""
    from carelens.sources.runs import Run  # which builds on the zones above

    ready = publishable(tables, partner, deny)
    if not ready:
        return []
    with Run(next(iter(ready.values())).sparkSession, out_dir) as run:
        return [run.write_aggregate(df, n) for n, df in ready.items()]
