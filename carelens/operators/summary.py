"""Characterization summaries: completeness window, percentiles, enrollment, demographics, use."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from carelens.functions import formats
from carelens.functions.dates import complete_years
from carelens.operators.spans import day_coverage, last_span
from carelens.sources.tables import union_all

PERCENTILES = {"p1": 0.01, "p5": 0.05, "p25": 0.25, "median": 0.5, "p75": 0.75, "p95": 0.95, "p99": 0.99}
THRESHOLD = 0.8  # fixed value: share of the neighbouring month that makes a month complete


# --- completeness window --------------------------------------------------------------------


def completeness(tables: dict[str, tuple[DataFrame, str]], threshold: float = THRESHOLD) -> DataFrame:
    """First and last complete month of each table's date column.

    A month starts the data when it has at least `threshold` of the next month's rows, and ends it
    when it has at least that share of the previous month's. Windows see one row per month.
    """
    monthly = union_all(
        [
            df.where(F.col(date).isNotNull())
            .groupBy(F.trunc(date, "MM").alias("month"))
            .agg(F.count("*").alias("n"))
            .select(F.lit(name.upper()).alias("tabid"), "month", "n")
            for name, (df, date) in tables.items()
        ]
    )
    w = Window.partitionBy("tabid").orderBy("month")
    seen = monthly.select(
        "tabid",
        "month",
        F.row_number().over(w).alias("nth"),
        (F.col("n") / F.lead("n").over(w) >= threshold).alias("may_start"),
        (F.col("n") / F.lag("n").over(w) >= threshold).alias("may_end"),
    )
    return (
        seen.groupBy("tabid")
        .agg(
            F.min(F.when(F.col("may_start"), F.col("month"))).alias("mindate"),
            F.last_day(F.max(F.when(F.col("may_end"), F.col("month")))).alias("maxdate"),
            (F.max(F.when(F.col("may_end"), F.col("nth"))) - F.max("nth")).cast("int").alias("months_from_last"),
        )
        .where("mindate is not null and maxdate is not null")
    )


def overall_window(windows: DataFrame, tabids: list[str]) -> DataFrame:
    """Latest start and earliest end over the listed tables, with each table's own window."""
    wide = [
        F.max(F.when(F.col("tabid") == t.upper(), F.col(d))).alias(f"{t.lower()}_{d}")
        for d in ("mindate", "maxdate")
        for t in tabids
    ]
    return windows.where(F.col("tabid").isin([t.upper() for t in tabids])).agg(
        F.max("mindate").alias("dp_mindate"), F.min("maxdate").alias("dp_maxdate"), *wide
    )


# --- percentiles and sums -------------------------------------------------------------------


def date_percentiles(counts: DataFrame, dates: list[str], weight: str = "n") -> DataFrame:
    """Weighted n, min, percentiles and max of date columns, interpolated between days.

    `percentile` keeps one counter per distinct day, so its state is bounded by the calendar.
    """
    days = {d: F.unix_date(d) for d in dates}
    exprs: list[Column] = []
    for d, day in days.items():
        share = F.array(*[F.lit(p) for p in PERCENTILES.values()])
        exprs += [
            F.coalesce(F.sum(F.when(F.col(d).isNotNull(), F.col(weight))), F.lit(0)).alias(f"{d}_n"),
            F.min(d).alias(f"{d}_min"),
            F.max(d).alias(f"{d}_max"),
            F.percentile(day, share, F.col(weight)).alias(f"{d}_p"),
        ]
    rows = [
        F.struct(
            F.lit(d).alias("variable"),
            F.col(f"{d}_n").alias("n"),
            F.col(f"{d}_min").alias("min"),
            *[
                F.date_from_unix_date(F.floor(F.col(f"{d}_p")[i]).cast("int")).alias(name)
                for i, name in enumerate(PERCENTILES)
            ],
            F.col(f"{d}_max").alias("max"),
        )
        for d in dates
    ]
    return counts.agg(*exprs).select(F.inline(F.array(*rows)))


def date_percentiles_by_rank(counts: DataFrame, date: str, weight: str = "n") -> DataFrame:
    """The same by cumulated weight: the day that reaches the share, or the mean of two.

    Where the cumulated weight meets the share exactly, this day and the next are averaged.
    """
    daily = counts.where(F.col(date).isNotNull()).groupBy(F.unix_date(date).alias("day")).agg(
        F.sum(weight).cast("long").alias("w")
    )
    # one row per distinct day: the whole calendar is a small group
    order = Window.orderBy("day")
    ranked = daily.select(
        "day",
        F.sum("w").over(order).alias("cum"),
        F.lead("day").over(order).alias("next_day"),
        F.sum("w").over(Window.partitionBy()).alias("total"),
    )
    exprs = []
    for name, p in PERCENTILES.items():
        share = F.lit(round(p * 100)).cast("long") * F.col("total")  # in hundredths of a row
        exact = F.col("cum") * 100 == share
        at = F.min(
            F.when(
                F.col("cum") * 100 >= share,
                F.struct("day", F.when(exact, (F.col("day") + F.coalesce("next_day", "day")) / 2)
                         .otherwise(F.col("day").cast("double")).alias("value")),
            )
        )
        exprs.append(F.date_from_unix_date(F.floor(at["value"]).cast("int")).alias(name))
    return ranked.agg(
        F.max("total").alias("n"),
        F.date_from_unix_date(F.min("day")).alias("min"),
        *exprs,
        F.date_from_unix_date(F.max("day")).alias("max"),
    ).select(F.lit(date).alias("variable"), "*")


def class_sums(df: DataFrame, classes: list[str | Column], sums: list[str]) -> DataFrame:
    """Sums by class columns; a missing class value is a class."""
    return df.groupBy(*classes).agg(*[F.sum(s).alias(s) for s in sums])


def bucketed_sums(df: DataFrame, column: str, ranges: list[formats.Range], sums: list[str]) -> DataFrame:
    """Sums by the bucket of one column."""
    return class_sums(df, [formats.bucket(F.col(column), ranges, formats.MISSING).alias(column)], sums)


def count_by(df: DataFrame, *columns: str | Column) -> DataFrame:
    """Row count by columns; without columns the total."""
    return df.groupBy(*columns).agg(F.count("*").alias("count"))


# --- enrollment -----------------------------------------------------------------------------


def with_length(periods: DataFrame) -> DataFrame:
    """Periods with their length in days, both ends included."""
    return periods.withColumn("loe", F.datediff("enr_end", "enr_start") + 1)


def length_by_record(periods: DataFrame) -> DataFrame:
    """Periods by length."""
    return count_by(with_length(periods), "loe")


def length_by_patient(periods: DataFrame, key: str = "patid") -> DataFrame:
    """Patients by their total length."""
    total = with_length(periods).groupBy(key).agg(F.sum("loe").alias("tloe"))
    return count_by(total, "tloe")


def periods_by_year(periods: DataFrame) -> DataFrame:
    """Periods that touch each calendar year; a patient counts once per period.

    Periods shrink to (first year, last year) pairs before years are listed.
    """
    pairs = (
        periods.where("year(enr_start) <= year(enr_end)")
        .groupBy(F.year("enr_start").alias("y1"), F.year("enr_end").alias("y2"))
        .agg(F.count("*").alias("n"))
    )
    return (
        pairs.select(F.explode(F.sequence("y1", "y2")).alias("year"), "n")
        .groupBy("year")
        .agg(F.sum("n").alias("count"))
    )


def patient_totals(periods: DataFrame, maxdate: Column, key: str = "patid") -> DataFrame:
    """Distinct patients, and those whose last period reaches `maxdate`."""
    return last_span(periods, [key]).agg(
        F.count("*").alias("patients"), F.count_if(F.col("enr_end") >= maxdate).alias("active_patients")
    )


def periods_per_patient(periods: DataFrame, key: str = "patid") -> DataFrame:
    """Patients by their number of periods."""
    per = periods.groupBy(key).agg(F.count("*").alias("enr_count"))
    return count_by(per, "enr_count")


# --- demographics ---------------------------------------------------------------------------


def age_profile(periods: DataFrame, dem: DataFrame, maxdate: Column) -> DataFrame:
    """Each patient's age at the start of the last period, and whether that period is active.

    `n` counts equal demographic rows of a patient; they shrink to one before the join.
    """
    born = dem.where("birth_date is not null").groupBy("patid", "birth_date", F.upper("sex").alias("sex")).agg(
        F.count("*").alias("n")
    )
    return (
        last_span(periods, ["patid"])
        .join(born, "patid")
        .select(
            "patid",
            complete_years(F.col("birth_date"), F.col("enr_start")).alias("age"),
            "sex",
            (F.col("enr_end") >= maxdate).alias("active"),
            "n",
        )
    )


def age_categories(profile: DataFrame) -> DataFrame:
    """Patients per age category: five-year groups and four wider groups that overlap them.

    Patients shrink to one row per age, sex and activity before the categories are listed.
    """
    cells = profile.groupBy("age", (F.col("sex") == "F").alias("female"), "active").agg(F.sum("n").alias("n"))
    age = F.col("age")
    labels = F.array(
        formats.five_year_age(age),
        F.when((age >= 0) & (age < 19), formats.PEDIATRIC_1),
        F.when((age >= 0) & (age < 22), formats.PEDIATRIC_2),
        F.when((age >= 0) & (age < 26), formats.YOUNG_ADULT),
        F.when(age.between(10, 54) & F.col("female"), formats.CHILDBEARING),
    )
    sort = F.when(F.lit(False), 0)
    for label, number in formats.AGE_SORT.items():
        sort = sort.when(F.col("agecategory") == label, number)
    return (
        cells.select(F.explode(labels).alias("agecategory"), "active", "n")
        .where("agecategory is not null")
        .groupBy("agecategory")
        .agg(
            F.sum("n").alias("count"),
            F.coalesce(F.sum(F.when(F.col("active"), F.col("n"))), F.lit(0)).alias("active_count"),
        )
        .select(sort.alias("sortorder"), "agecategory", "count", "active_count")
    )


def enrolled_rows(dem: DataFrame, enrolled: DataFrame, columns: list[str]) -> DataFrame:
    """Demographic rows of enrolled patients: the columns and `n` equal rows.

    Equal rows of a patient shrink to one before the join.
    """
    cells = dem.groupBy("patid", *columns).agg(F.count("*").alias("n"))
    return cells.join(enrolled.select("patid"), "patid").select(*columns, "n")


def category_counts(df: DataFrame, columns: list[str], weight: str = "n") -> DataFrame:
    """Rows by each of several columns, in one pass."""
    cells = df.groupBy(*columns).agg(F.sum(weight).alias("n"))
    summed = cells.groupingSets([[F.col(c)] for c in columns], *columns).agg(
        F.sum("n").alias("count"), *[F.grouping(c).alias(f"g_{c}") for c in columns]
    )
    variable, value = F.when(F.lit(False), ""), F.when(F.lit(False), "")
    for c in columns:
        used = F.col(f"g_{c}") == 0
        variable, value = variable.when(used, c), value.when(used, F.col(c).cast("string"))
    return summed.select(variable.alias("variable"), value.alias("value"), "count")


def geography(dem: DataFrame, zips: DataFrame, weight: str = "n") -> DataFrame:
    """Patients per state; '00' for a missing postal code, '99' for an unknown one.

    Patients shrink to one row per postal code before the lookup.
    """
    state = (
        F.when(F.col("statecode").isNotNull(), F.col("statecode"))
        .when(F.col("postalcode").isNull(), "00")
        .otherwise("99")
    )
    return (
        dem.groupBy("postalcode")
        .agg(F.sum(weight).alias("count"))
        .join(zips.select("postalcode", "statecode"), "postalcode", "left")
        .groupBy(state.alias("statecode"))
        .agg(F.sum("count").alias("count"))
    )


# --- use of care inside enrollment ----------------------------------------------------------


def records_in_enrollment(
    records: DataFrame, periods: DataFrame, date: str, kinds: list[str], key: str = "patid"
) -> DataFrame:
    """Patients by coverage type and their number of records inside periods of that type.

    A record inside two overlapping periods counts twice. All types share one pass.
    """
    open_of = {k: F.col("cov") == k for k in kinds}
    days = day_coverage(records, periods, [key], date, kinds=open_of)
    per = days.groupBy(key).agg(*[F.sum(F.col("n") * F.col(k)).alias(k) for k in kinds])
    pairs = F.array(*[F.struct(F.lit(k).alias("cov"), F.col(k).alias("n_records")) for k in kinds])
    return count_by(per.select(F.inline(pairs)).where("n_records > 0"), "cov", "n_records")


def lab_dates(lab: DataFrame) -> DataFrame:
    """Lab rows with their test date: the lab, else the result, else the order date."""
    return lab.select("patid", F.coalesce("lab_dt", "result_dt", "order_dt").alias("testdate"))


def vitals_in_enrollment(vitals: DataFrame, periods: DataFrame, mode: str = "all") -> DataFrame:
    """Distinct patients with each vital sign inside periods.

    mode 'all': every filled measure counts; mode 'prefix', for parity: a missing measure hides the
    later ones of its row (order HGT, WGT, DIA, SYS). Measures stay columns until one row is left.
    """
    if mode not in ("prefix", "all"):
        raise ValueError(f"mode must be 'prefix' or 'all', got {mode!r}")
    measures = {"HGT": "ht", "WGT": "wt", "DIA": "diastolic", "SYS": "systolic"}
    weights, before = {}, F.lit(True)
    for name, column in measures.items():
        filled = F.col(column).isNotNull()
        before = before & filled if mode == "prefix" else filled
        weights[name] = before.cast("long")
    days = day_coverage(vitals, periods, ["patid"], "measure_date", weights).where("open_spans > 0")
    per = days.groupBy("patid").agg(*[F.max(F.col(m) > 0).alias(m) for m in measures])
    wide = per.agg(*[F.count_if(F.col(m)).alias(m) for m in measures])
    rows = F.array(
        *[F.struct(F.lit(m).alias("vs_type"), F.col(m).alias("count")) for m in measures]
    )
    return wide.select(F.inline(rows)).where("count > 0")


def records_of_enrolled(
    records: DataFrame, enrolled: DataFrame, kinds: list[str], key: str = "patid"
) -> DataFrame:
    """Records (deaths) of enrolled patients per coverage type, 0 where there are none.

    Records shrink to one row per patient before the join.
    """
    per = count_by(records, key).join(enrolled.select("cov", key), key)
    totals = per.agg(
        *[F.coalesce(F.sum(F.when(F.col("cov") == k, F.col("count"))), F.lit(0)).alias(k) for k in kinds]
    )
    rows = F.array(*[F.struct(F.lit(k).alias("cov"), F.col(k).alias("count")) for k in kinds])
    return totals.select(F.inline(rows))


def causes_per_patient(cod: DataFrame, enrolled: DataFrame, key: str = "patid") -> DataFrame:
    """Enrolled patients by coverage type and number of cause-of-death records: 1 to 4, or more."""
    per = count_by(cod, key).join(enrolled.select("cov", key), key)
    return count_by(per, "cov", formats.record_count(F.col("count")).alias("cod_count"))


# --- attrition ------------------------------------------------------------------------------


def attrition(
    df: DataFrame, exclusions: list[Column], group: str, distinct: list[str] | None = None
) -> DataFrame:
    """What is left after each exclusion, applied one after the other.

    Counts rows, or distinct combinations of `distinct`. A row is reduced to the number of
    exclusions it survives, so all steps come from one pass.
    """
    survived = F.lit(len(exclusions))
    for i in reversed(range(len(exclusions))):
        survived = F.when(F.coalesce(exclusions[i], F.lit(False)), F.lit(i)).otherwise(survived)
    rows = df.select(*(distinct or []), survived.alias("survived"))
    if distinct:
        rows = rows.groupBy(*distinct).agg(F.max("survived").alias("survived"))
    counters = [F.count_if(F.col("survived") >= i).alias(f"left_{i}") for i in range(len(exclusions) + 1)]
    steps = [
        F.struct(
            F.lit(group).alias("analysisgrp"),
            F.lit(str(i)).alias("level"),
            F.col(f"left_{i}").alias("num"),
            (F.col(f"left_{i - 1}") - F.col(f"left_{i}")).alias("removed"),
        )
        for i in range(1, len(exclusions) + 1)
    ]
    return rows.agg(*counters).select(F.inline(F.array(*steps)))
