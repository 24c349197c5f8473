"""Enrollment spans: classification, bridging, merging, coverage by day.

No window here may see an unbounded group, even if one patient id holds a third of all rows. Two
devices keep groups within the calendar: rows first shrink to one per patient and day, so that a
patient has at most as many as there are days; or ordered work runs per patient and start month,
and only its short result is combined per patient.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.window import WindowSpec

from carelens.functions.dates import or_lowest
from carelens.functions.formats import OVERLAP

SPAN_KEYS = ["patid", "enr_start", "enr_end", "medcov", "drugcov", "chart"]
BRIDGE_DAYS = 46  # fixed value: a longer pause starts a new period
# Adaptive coalescing sizes partitions by their packed bytes, a small part of what rows take in a sort or a hash
# table, so that few tasks would hold them all; numbers given to repartition stay as they are.
PARTS, DEALS = 256, 16


def _ordered(*columns: str) -> list[Column]:
    return [F.col(c).asc_nulls_first() for c in columns]


# --- exclusions ---------------------------------------------------------------------------


def exclude(df: DataFrame, listed: DataFrame, on: dict[str, str]) -> DataFrame:
    """Rows whose key is not listed; `on` maps columns of `df` to columns of `listed`."""
    return df.join(*_listed(df, listed, on), "left_anti")


def restrict(df: DataFrame, listed: DataFrame, on: dict[str, str]) -> DataFrame:
    """Rows whose key is listed."""
    return df.join(*_listed(df, listed, on), "left_semi")


def _listed(df: DataFrame, listed: DataFrame, on: dict[str, str]) -> tuple[DataFrame, Column]:
    keys = listed.select(*[F.col(c).alias(f"x_{c}") for c in on.values()]).distinct()
    cond = F.lit(True)
    for ours, theirs in on.items():
        cond = cond & df[ours].eqNullSafe(keys[f"x_{theirs}"])
    return keys, cond


# --- classification of overlapping and unbridged spans --------------------------------------


def invalid_spans(spans: DataFrame) -> DataFrame:
    """Spans that end before they start; a missing end counts, a missing start does not."""
    return spans.where(_invalid())


def _invalid() -> Column:
    return or_lowest(F.col("enr_end")) < or_lowest(F.col("enr_start"))


def classified(spans: DataFrame) -> DataFrame:
    """Each distinct span with its state, from one pass: invalid, D, S, O (flagged), drop, or keep.

    In (patient, start, end) order only spans of the same start can repeat their predecessor or
    lie within it, so that comparison needs no more than the spans of one patient and start. What
    stays, at most one span per patient and start day, is compared with the previous one that stays;
    the other spans keep to windows of their own start.
    """
    same_start = Window.partitionBy("patid", "enr_start").orderBy(*_ordered(*SPAN_KEYS[2:]))
    lagged = spans.select(*SPAN_KEYS).distinct().select(
        "*",
        F.lag("enr_end").over(same_start).alias("lag_end"),
        F.row_number().over(same_start).alias("nth"),
    )
    end, lag_end = or_lowest(F.col("enr_end")), or_lowest(F.col("lag_end"))
    first = lagged.select(
        *SPAN_KEYS,
        F.when(_invalid(), "invalid")
        .when(F.col("nth") == 1, "keep")
        .when(end == lag_end, "D")
        .when((or_lowest(F.col("enr_start")) <= lag_end) & (end <= lag_end), "S")
        .otherwise("drop")  # contains its predecessor: neither flagged nor kept
        .alias("state"),
    )
    stays = F.col("state") == "keep"
    w = Window.partitionBy("patid", "stays", "own").orderBy(*_ordered("enr_start"))
    second = first.withColumn("stays", stays).withColumn("own", F.when(~stays, F.col("enr_start"))).select(
        *SPAN_KEYS, "state", "stays", F.lag("enr_end").over(w).alias("lag_end"), F.row_number().over(w).alias("nth")
    )
    lag_end = or_lowest(F.col("lag_end"))
    over = (or_lowest(F.col("enr_start")) <= lag_end) | (or_lowest(F.col("enr_end")) <= lag_end)
    state = F.when(F.col("stays") & (F.col("nth") > 1) & over, "O").otherwise(F.col("state"))
    return second.select(*SPAN_KEYS, state.alias("state"))


def flagged(states: DataFrame) -> DataFrame:
    """The classified spans that duplicate, lie within, or overlap an earlier span of the patient."""
    label = F.when(F.lit(False), "")
    for code, text in OVERLAP.items():
        label = label.when(F.col("state") == code, text)
    return states.where(F.col("state").isin(*OVERLAP)).select(*SPAN_KEYS, label.alias("dateconflict"))


def unflagged(states: DataFrame) -> DataFrame:
    """The classified spans without the overlapping ones; invalid spans stay."""
    return states.where("state in ('keep', 'invalid')").select(*SPAN_KEYS)


def overlaps(spans: DataFrame) -> DataFrame:
    """Spans that duplicate, lie within, or overlap an earlier span of the patient."""
    return flagged(classified(spans))


def without_overlaps(spans: DataFrame) -> DataFrame:
    """Distinct spans less the overlapping ones; invalid spans stay."""
    return unflagged(classified(spans))


def overlap_summary(flagged: DataFrame) -> DataFrame:
    """Records and patients per kind of conflict, with zeros for kinds that do not occur."""
    counters = []
    for code, label in OVERLAP.items():
        is_kind = F.col("dateconflict") == label
        counters.append(F.count_if(is_kind).alias(f"r_{code}"))
        counters.append(F.countDistinct(F.when(is_kind, F.col("patid"))).alias(f"p_{code}"))
    rows = []
    for code, label in OVERLAP.items():
        for kind, col in [("Unique PatID", f"p_{code}"), ("Records", f"r_{code}")]:
            rows.append(
                F.struct(
                    F.lit(label).alias("dateconflict"),
                    F.lit(kind).alias("counttype"),
                    F.col(col).alias("count"),
                )
            )
    return flagged.agg(*counters).select(F.inline(F.array(*rows)))


def unbridged(spans: DataFrame) -> DataFrame:
    """Spans that start the day after the previous one ended, with the same coverage.

    Takes spans without overlaps, so a patient has at most one per start day.
    """
    w = Window.partitionBy("patid").orderBy(*_ordered(*SPAN_KEYS[1:]))
    covs = ["medcov", "drugcov", "chart"]
    lagged = spans.where("enr_start is not null and enr_end is not null and enr_start <= enr_end").select(
        *SPAN_KEYS,
        F.row_number().over(w).alias("nth"),
        F.lag("enr_end").over(w).alias("lag_end"),
        *[F.lag(c).over(w).alias(f"lag_{c}") for c in covs],
    )
    same = F.col("enr_start") == F.date_add("lag_end", 1)
    for c in covs:
        same = same & F.col(c).eqNullSafe(F.col(f"lag_{c}"))
    return lagged.where((F.col("nth") > 1) & same).select(*SPAN_KEYS)


# --- coverage types, bridging, merging ------------------------------------------------------


def by_coverage(spans: DataFrame, kinds: tuple[str, ...] = ("m", "d", "md")) -> DataFrame:
    """Spans tagged with each coverage type they belong to: medical, drug, both."""
    med, drug = F.lower("medcov") == "y", F.lower("drugcov") == "y"
    belongs = {"m": med, "d": drug, "md": med & drug}
    tags = F.array(*[F.when(belongs[k], F.lit(k)) for k in kinds])
    return (
        spans.select(F.explode(tags).alias("cov"), "patid", "enr_start", "enr_end")
        .where("cov is not null")
    )


def _starts_anew(w: WindowSpec, lag_end: Column, gap: int) -> Column:
    """1 where a span starts more than `gap` days after the end before it; a missing end is low."""
    late = or_lowest(F.col("enr_start")) > or_lowest(F.date_add(lag_end, gap))
    return F.when((F.row_number().over(w) > 1) & late, 1).otherwise(0)


def bridge(spans: DataFrame, keys: list[str], gap: int = BRIDGE_DAYS) -> DataFrame:
    """Periods of spans that follow each other with at most `gap` days between.

    A span is compared with the end of the span before it in (start, end) order, not with the
    latest end so far, so a short nested span can split a period.
    """
    distinct = spans.select(*keys, "enr_start", "enr_end").distinct()
    monthly = distinct.withColumn("month", F.trunc("enr_start", "MM"))
    # 1. pieces within one start month
    w = Window.partitionBy(*keys, "month").orderBy(*_ordered("enr_start", "enr_end"))
    opens = _starts_anew(w, F.lag("enr_end").over(w), gap)
    pieces = (
        monthly.withColumn("opens", opens)
        .withColumn("piece", F.sum("opens").over(w))
        .withColumn("closes", F.coalesce(F.lead("opens").over(w), F.lit(1)) == 1)
        .groupBy(*keys, "month", "piece")
        .agg(
            F.min("enr_start").alias("enr_start"),
            F.max("enr_end").alias("enr_end"),
            F.max(F.when(F.col("closes"), F.col("enr_end"))).alias("last_end"),
        )
    )
    # 2. pieces of one patient: at most a few per month
    p = Window.partitionBy(*keys).orderBy(*_ordered("month", "piece"))
    opens = _starts_anew(p, F.lag("last_end").over(p), gap)
    return (
        pieces.withColumn("opens", opens)
        .withColumn("period", F.sum("opens").over(p))
        .groupBy(*keys, "period")
        .agg(F.min("enr_start").alias("enr_start"), F.max("enr_end").alias("enr_end"))
        .drop("period")
    )


def merge_periods(spans: DataFrame, keys: list[str], start: str, end: str) -> DataFrame:
    """Spans joined when they overlap or touch: a pause of one day or more separates periods.

    A missing end or start counts as the other one, a span without either as none. Compares with the
    latest end so far. Merging is associative, so it runs per start month first
    and then over the disjoint periods of a patient.
    """

    def merge(df: DataFrame, part: list[str]) -> DataFrame:
        w = Window.partitionBy(*part).orderBy(*_ordered(start, end))
        reach = F.max(end).over(w.rowsBetween(Window.unboundedPreceding, -1))
        opens = F.when(F.col(start) > F.date_add(reach, 1), 1).otherwise(0)
        return (
            df.withColumn("opens", opens)
            .withColumn("period", F.sum("opens").over(w))
            .groupBy(*part, "period")
            .agg(F.min(start).alias(start), F.max(end).alias(end))
            .drop("period")
        )

    known = spans.select(*keys, F.coalesce(start, end).alias(start), F.coalesce(end, start).alias(end))
    distinct = known.where(F.col(start).isNotNull()).distinct().withColumn("month", F.trunc(start, "MM"))
    return merge(merge(distinct, [*keys, "month"]), keys)


def enrolled(periods: DataFrame, keys: list[str]) -> DataFrame:
    """Patients with at least one period."""
    return periods.select(*keys).distinct()


def last_span(periods: DataFrame, keys: list[str]) -> DataFrame:
    """The latest period of each patient."""
    latest = periods.groupBy(*keys).agg(F.max(F.struct("enr_start", "enr_end")).alias("s"))
    return latest.select(*keys, "s.*")


# --- dates against spans --------------------------------------------------------------------


def day_coverage(
    records: DataFrame,
    spans: DataFrame,
    keys: list[str],
    date: str,
    weights: dict[str, Column] | None = None,
    kinds: dict[str, Column] | None = None,
    start: str = "enr_start",
    end: str = "enr_end",
) -> DataFrame:
    """Per key and record day: its weights, how many spans hold the day, how many spans there are.

    Spans become +1 on their first day and -1 on the day after their last; a running sum over the
    days of a key then says how many are open. No record is ever paired with a span, so a patient
    with many of both costs no more than their days. Spans without both ends are left out. `kinds`
    names predicates over the spans; each gives a count of its own, in the same pass. Tasks hold a fixed
    share of the rows (PARTS), whatever the planner takes their size for.
    """
    weights = weights or {"n": F.lit(1)}
    kinds = kinds or {"open_spans": F.lit(True)}
    zero = F.lit(0).cast("long")
    marks = records.where(F.col(date).isNotNull()).select(
        *keys,
        F.col(date).alias("day"),
        *[c.cast("long").alias(w) for w, c in weights.items()],
        F.lit(1).alias("is_record"),
        *[zero.alias(k) for k in kinds],
        zero.alias("begun"),
    )
    valid = F.col(start) <= F.col(end)
    holds = {k: F.when(valid & p, 1).otherwise(0).cast("long") for k, p in kinds.items()}
    edges = F.array(
        F.struct(
            F.col(start).alias("day"),
            *[h.alias(k) for k, h in holds.items()],
            F.lit(1).cast("long").alias("begun"),
        ),
        F.struct(
            F.date_add(end, 1).alias("day"), *[(-h).alias(k) for k, h in holds.items()], zero.alias("begun")
        ),
    )
    edged = spans.where(F.col(start).isNotNull() & F.col(end).isNotNull()).select(
        *keys, F.inline(edges)
    )
    both = marks.unionByName(
        edged.select("*", *[zero.alias(w) for w in weights], F.lit(0).alias("is_record"))
    )
    sums = [*[F.sum(c).alias(c) for c in [*weights, *kinds, "begun"]], F.max("is_record").alias("is_record")]
    # Rows of one key and day are dealt by where they come from, so that they meet in up to DEALS tasks before the last one.
    dealt = both.withColumn("_deal", F.pmod(F.spark_partition_id(), F.lit(DEALS)))
    first = dealt.repartition(PARTS, *keys, "day", "_deal").groupBy(*keys, "day", "_deal").agg(*sums)
    daily = first.repartition(PARTS, *keys).groupBy(*keys, "day").agg(*sums)
    w = Window.partitionBy(*keys).orderBy("day").rowsBetween(Window.unboundedPreceding, 0)
    return (
        daily.select(
            *keys,
            "day",
            *weights,
            "is_record",
            *[F.sum(k).over(w).alias(k) for k in kinds],
            F.sum("begun").over(Window.partitionBy(*keys)).alias("all_spans"),
        )
        .where("is_record = 1")
        .drop("is_record")
    )


def outside_span_pairs(records: DataFrame, spans: DataFrame, keys: list[str], date: str) -> DataFrame:
    """Per key and date: records, and pairs of a record with a span that does not hold its date.

    The pairs themselves all look alike and are many, so they are counted, not written out.
    """
    known = records
    for k in keys:
        known = known.where(F.col(k).isNotNull())
    days = day_coverage(known, spans, keys, date)
    return days.select(
        *keys,
        F.col("day").alias(date),
        "n",
        (F.col("n") * (F.col("all_spans") - F.col("open_spans"))).alias("n_pairs"),
    ).where("n_pairs > 0")


def uncovered_dates(records: DataFrame, spans: DataFrame, keys: list[str], date: str) -> DataFrame:
    """Per key and date: records whose date no span holds."""
    days = day_coverage(records, spans, keys, date)
    return days.where("open_spans = 0").select(*keys, F.col("day").alias(date), "n")


def uncovered_patients(
    records: DataFrame, spans: DataFrame, coverage: str, date: str, key: str = "patid"
) -> DataFrame:
    """Patients of both tables none of whose dates lies in a span with the coverage.

    Any span makes a patient eligible, only spans with `coverage` = 'Y' and no end before the
    start cover a date. A missing start is open. Gives the patient's record count.
    """
    long0, long1 = F.lit(0).cast("long"), F.lit(1).cast("long")
    marks = records.where(F.col(key).isNotNull()).select(
        F.col(key).alias("patid"),
        F.col(date).alias("day"),
        long1.alias("n"),
        long0.alias("delta"),
        long0.alias("seen"),
    )
    first = or_lowest(F.col("enr_start"))
    covers = F.when((F.col(coverage) == "Y") & (first <= F.col("enr_end")), 1).otherwise(0).cast("long")
    edges = F.array(
        F.struct(first.alias("day"), covers.alias("delta"), long1.alias("seen")),
        F.struct(F.date_add("enr_end", 1).alias("day"), (-covers).alias("delta"), long0.alias("seen")),
    )
    edged = spans.where("patid is not null").select("patid", F.inline(edges))
    daily = (
        marks.unionByName(edged.select("patid", "day", long0.alias("n"), "delta", "seen"))
        .groupBy("patid", "day")
        .agg(F.sum("n").alias("n"), F.sum("delta").alias("delta"), F.sum("seen").alias("seen"))
    )
    w = Window.partitionBy("patid").orderBy(*_ordered("day")).rowsBetween(Window.unboundedPreceding, 0)
    covered = F.when((F.col("n") > 0) & F.col("day").isNotNull() & (F.col("open_spans") > 0), 1)
    return (
        daily.withColumn("open_spans", F.sum("delta").over(w))
        .groupBy("patid")
        .agg(
            F.sum("n").alias("n_records"),
            F.sum("seen").alias("seen"),
            F.max(covered.otherwise(0)).alias("covered"),
        )
        .where("n_records > 0 and seen > 0 and covered = 0")
        .select("patid", "n_records")
    )
