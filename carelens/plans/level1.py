"""Level 1 of a review: are the table and its columns as expected, are the values?

`scans` reads the table; `results` works on what the scans gave, which is written in between.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from carelens.functions.rulesets import FLAGS, VARIABLE_RULES, Flag, VariableRule, flags_frame, rules_frame
from carelens.operators import flags as fl
from carelens.operators import profile
from carelens.sources.tables import Tables


def table_checks(spark: SparkSession, tables: Tables, expected: list[str]) -> Tables:
    """Row counts, and abort flags for expected tables that are absent or empty."""
    counts = profile.row_counts({t: tables[t] for t in expected if t in tables})
    flags = profile.missing_tables(spark, expected, counts).unionByName(profile.empty_tables(counts))
    return {"all_l1_nobs": counts, "table_flags": flags}


def scans(
    df: DataFrame,
    tabid: str = "mil",
    rules: list[VariableRule] = VARIABLE_RULES,
    flags: list[Flag] = FLAGS,
    window: tuple[Column, Column] | None = None,
) -> Tables:
    """All counters of one table in one pass, and its value-rule hits in another."""
    low, high = window or (None, None)
    return {
        "l1_counters_mstr": profile.counters(df, rules),
        "l1_hits_mstr": profile.value_rules(df, [f for f in flags if f.level == 1], rules, low, high),
    }


def results(
    spark: SparkSession,
    scanned: Tables,
    schema,
    rules: list[VariableRule] = VARIABLE_RULES,
    flags: list[Flag] = FLAGS,
    tabid: str = "mil",
) -> Tables:
    """Contents, value counts, compliance, the flag master and its roll-up, from the scans of a table with this schema."""
    lookup = flags_frame(spark, flags)
    counted = scanned["l1_counters_mstr"]
    cont = profile.contents_of(counted, schema, tabid)
    counts = profile.value_counts_of(counted, schema.names, rules, tabid)
    comp = profile.compliance(cont, rules_frame(spark, rules))
    hits = scanned["l1_hits_mstr"]
    column_hits = profile.structure_flags(_declared_only(comp, schema)).unionByName(
        profile.population_flags(counts, lookup), allowMissingColumns=True
    )
    rolled = fl.roll_up_values(
        hits.select("flagid", "variable", "value", "count").unionByName(column_hits, allowMissingColumns=True)
    )
    names = lookup.select("flagid", "flag_descr", "flag_type", "abort_yn")
    return {
        "all_l1_cont": cont,
        "all_l1_record_count": counts,
        "all_l1_scdm_comp": comp,
        "all_l1_flags_mstr": fl.flag_master(hits, lookup),
        "all_l1_flags": rolled.join(names, "flagid"),
    }


def _declared_only(comp: DataFrame, schema) -> DataFrame:
    """Compliance with text lengths only where the source declares them.

    A plain string has no declared length, so it cannot be of the wrong one.
    """
    plain = [
        f.name.lower()
        for f in schema.fields
        if profile.type_class(f.dataType) == "C" and profile.declared_length(f) is None
    ]
    undeclared = F.lower("var").isin(plain) if plain else F.lit(False)
    return comp.withColumn("ms_length", F.when(undeclared, 0).otherwise(F.col("ms_length")))
