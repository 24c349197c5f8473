"""A whole review: level by level, written as it goes, stopped by the first fatal level.

Each step's tables are written before the next step reads them, so nothing is computed twice and a
lost executor costs one step at most. The decision to go on asks the written flag counts for one
fatal row; nothing else comes to the driver. The tables are staged and published together when the
review ends, also when fatal flags ended it; one that fails leaves the published tables alone.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession

from carelens.operators import flags as fl
from carelens.plans import level1, level2, level3, snapshot
from carelens.plans.level2 import LinkageRules
from carelens.sources import runs, sinks
from carelens.sources.tables import Tables, table


@dataclass
class Outcome:
    """How far a review came and what it wrote."""

    status: str = "completed"
    level: int = 0
    written: dict[str, str] = field(default_factory=dict)


def _write(run: runs.Run, tables: Tables, partner: str) -> dict[str, str]:
    """Masters and working tables to the row zone, the rest past the guard to the aggregate zone."""
    written = {}
    for name, df in tables.items():
        if "mstr" in name or name in sinks.NOT_PUBLISHED:
            written[name] = run.write_rows(df, name)
        else:
            written[name] = run.write_aggregate(sinks.add_partner(df, partner), name)
    return written


def _fatal(flags: DataFrame) -> bool:
    """Whether written flag counts hold an abort flag."""
    return not flags.where("abort_yn = 'Y' and count > 0").isEmpty()


def review(
    spark: SparkSession,
    tables: Tables,
    out_dir: str,
    partner: str,
    window: tuple[Column, Column] | None = None,
    rules: LinkageRules | None = None,
    maxdate: Column | None = None,
    previous: DataFrame | None = None,
) -> Outcome:
    """Levels 1 to 3 of the linkage table, then the population summaries.

    `previous`, the flag counts of the load before, adds the comparison for sign-off; they may be those published in
    out_dir. Where an exception ends the review, what was published before stays (see `runs`).
    """
    with runs.Run(spark, out_dir) as run:
        done = _levels(run, tables, partner, window, rules, maxdate, previous)
        run.status, run.stopped_at = done.status, None if done.status == runs.COMPLETED else f"level {done.level}"
    return done


def _levels(
    run: runs.Run,
    tables: Tables,
    partner: str,
    window: tuple[Column, Column] | None,
    rules: LinkageRules | None,
    maxdate: Column | None,
    previous: DataFrame | None,
) -> Outcome:
    spark, done = run.spark, Outcome()

    def put(level: int, built: Tables) -> Tables:
        """Write one step's tables and give them as read from there."""
        done.level = level
        paths = _write(run, built, partner)
        done.written |= paths
        return {name: spark.read.parquet(path) for name, path in paths.items()}

    def stop(flags: DataFrame) -> bool:
        if _fatal(flags):
            done.status = "aborted"
        return done.status == "aborted"

    if stop(put(1, level1.table_checks(spark, tables, ["mil"]))["table_flags"]):
        return done
    mil = table(tables, "mil")
    scanned = put(1, level1.scans(mil, window=window))
    first = put(1, level1.results(spark, scanned, mil.schema))
    if stop(first["all_l1_flags"]):
        return done
    # The table on its own first: a fatal flag there ends the level, and only fatal flags are counted.
    own = put(2, level2.one_table(mil, rules))
    if not own["l2_mstr"].where("abort_yn = 'Y'").isEmpty():
        stop(put(2, level2.results(own, only_abort=True))["all_l2_flags"])
        return done
    masters = own | put(2, level2.across_tables(tables))
    if "enr" in tables:
        states = put(2, level2.span_states(tables["enr"]))["enr_l2_states_mstr"]
        masters |= put(2, level2.enrollment(states))
    fatal = [df for df in masters.values() if "abort_yn" in df.columns]
    aborted = any(not df.where("abort_yn = 'Y'").isEmpty() for df in fatal)
    second = put(2, level2.results(masters, only_abort=aborted))
    if stop(second["all_l2_flags"]):
        return done
    seen = put(2, level2.aggregates(tables))
    if "l2_presence_matrix" in seen:
        put(2, level2.patterns(seen["l2_presence_matrix"], seen["l2_value_lengths"]))
    put(3, level3.results(put(3, level3.masters(mil))))
    both = put(3, {"all_l1_l2_flags": fl.roll_up([first["all_l1_flags"], second["all_l2_flags"]])})
    if previous is not None:
        put(3, {"sign_off": level3.sign_off(both["all_l1_l2_flags"].drop("dp", "whole"), previous)})
    if maxdate is not None:
        periods = put(4, snapshot.periods(tables))["enr_final_mstr"]
        put(4, snapshot.summaries(tables, periods, maxdate))
    return done
