"""The plain check run: every check of the linkage table by id, row-level flags as output.

Checks run level by level. A fatal check with flags ends the run: later checks, by id, give nothing.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from carelens.functions.rulesets import VARIABLE_RULES, Flag, VariableRule, flag
from carelens.operators import flags as fl
from carelens.operators import linkage, profile
from carelens.plans.level2 import DETAIL, port_checks
from carelens.sources import runs, sinks
from carelens.sources.tables import Tables, table, union_all

# Checks that end a run, and below the texts of the variable checks.
ABORT_CHECKS = {"100", "101", "200", "217", "218", "219"}


@dataclass
class Outcome:
    """How a run ended; `flags` and `counts` are where the results lie."""

    status: str = "completed"
    stopped_at: str | None = None
    flags: str = ""
    counts: str = ""
    disabled: list[str] = field(default_factory=list)


def _variable_flag(check: str, rule: VariableRule) -> Flag:
    text = {
        "110": "Required SCDM variable '{}' is missing",
        "111": "Variable '{}' is not populated",
        "112": "Variable '{}' type mismatch",
        "113": "Variable '{}' length exceeds SCDM max of {}",
        "120": "Variable '{}' contains null values",
    }[check]
    return Flag(check, 1, rule.varid, text.format(rule.variable, rule.varlength), variable1=rule.variable)


def level1(spark: SparkSession, mil: DataFrame, rules: list[VariableRule] = VARIABLE_RULES) -> DataFrame:
    """Flags 101 to 126; the row checks share one pass."""
    types = {f.name.lower(): profile.type_class(f.dataType) for f in mil.schema.fields}
    # facts of the schema, one row each
    known = [_variable_flag("110", r) for r in rules if r.variable.lower() not in types]
    known += [_variable_flag("112", r) for r in rules if types.get(r.variable.lower(), r.vartype) != r.vartype]
    rows = [(f.flagid, f.descr, "", f.flag_type, f.abort_yn) for f in known]
    found = [spark.createDataFrame(rows, sinks.FLAG_SCHEMA)]
    empty = mil.agg(F.count("*").alias("n")).where("n = 0").select()
    found.append(fl.with_flag(empty, flag("101")))

    counts = profile.unpopulated(profile.value_counts(mil, rules)).where("count_obs > 0")
    descr = F.concat(F.lit("Variable '"), "variable", F.lit("' is not populated"))
    found.append(
        counts.select(
            F.concat(F.lit("MIL_1_"), "varid", F.lit("_00-0_111")).alias("flagid"),
            descr.alias("flag_descr"),
            F.lit("").alias("message"),
            F.lit("Warn").alias("flag_type"),
            F.lit("N").alias("abort_yn"),
        )
    )
    by_row = []
    for r in rules:
        name = r.variable.lower()
        if name not in types:
            continue
        if types[name] == "C" and r.varlength > 0:
            by_row.append((_variable_flag("113", r), F.length(name) > r.varlength))
        by_row.append((_variable_flag("120", r), F.col(name).isNull()))
    if types.get("age") == "N":
        by_row.append((flag("126"), profile.outside_age(F.col("age"))))
    detail = [c for c in DETAIL if c in types]
    if by_row:
        found.append(fl.row_checks(mil, by_row, detail))
    return union_all(found)


def level2(spark: SparkSession, tables: Tables) -> DataFrame:
    """Flags 200 to 223."""
    return union_all(list(port_checks(spark, tables).values()))


def level3(mil: DataFrame) -> DataFrame:
    """Flags 371 to 397."""
    return union_all([linkage.birth_type_linkage(mil), linkage.linkage_gaps(mil, DETAIL)])


def run_checks(
    spark: SparkSession,
    tables: Tables,
    out_dir: str,
    enabled: list[str] | None = None,
    disabled: list[str] | None = None,
) -> Outcome:
    """Run the checks and publish their flags; `enabled`, if given, wins over `disabled`.

    A level is written before the next one is built. Only the smallest id of a fatal check with
    flags comes to the driver. Flags and counts are published together; a check that fails leaves
    those published before (see `runs`).
    """
    with runs.Run(spark, out_dir) as run:
        done = _levels(run, tables, enabled, disabled)
        run.status, run.stopped_at = done.status, done.stopped_at
    return done


def _levels(run: runs.Run, tables: Tables, enabled: list[str] | None, disabled: list[str] | None) -> Outcome:
    spark = run.spark
    done = Outcome(disabled=[] if enabled else list(disabled or []))
    mil = table(tables, "mil")
    levels = [
        lambda: level1(spark, mil),
        lambda: level2(spark, tables),
        lambda: level3(mil),
    ]
    kept = []
    for n, build in enumerate(levels, 1):
        check = F.substring_index("flagid", "_", -1)
        wanted = check.isin(enabled) if enabled else ~check.isin(done.disabled) if done.disabled else F.lit(True)
        flags = spark.read.parquet(run.write_work(build().where(wanted), f"level_{n}"))  # may hold flags that the result leaves out
        fatal = check.isin(sorted(ABORT_CHECKS)) & (F.col("abort_yn") == "Y")
        first = flags.where(fatal).agg(F.min(check).alias("c")).first()["c"]
        kept.append(flags if first is None else flags.where(check <= first))
        if first is not None:
            done.status, done.stopped_at = "aborted", first
            break
    done.flags = run.write_rows(sinks.align_flags(spark, kept), "flags")
    written = spark.read.parquet(done.flags)
    done.counts = run.write_aggregate(fl.count_rows(written), "flag_counts")
    return done
