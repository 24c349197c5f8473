"""Span operators against plain sequential code over many random patients."""

import datetime as dt
import random
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from carelens.operators import spans, summary

DAY0 = dt.date(2020, 1, 1)
LOW = dt.date.min


def day(n):
    return DAY0 + dt.timedelta(days=n)


def low(d):
    return d or LOW


def random_spans(seed, patients=120, nulls=True, horizon=400):
    """(patid, start, end, med, drug, chart) with repeats, nested, inverted and open spans."""
    rnd, out = random.Random(seed), []
    for p in range(patients):
        for _ in range(rnd.randint(1, 9)):
            start = rnd.randint(0, horizon)
            end = start + rnd.choice([-120, -60, -10, -1, 0, 5, 20, 40, 45, 60, 200])
            row = [f"P{p}", day(start), day(end), rnd.choice("YN"), rnd.choice("YN"), rnd.choice("YN")]
            if nulls and rnd.random() < 0.08:
                row[rnd.choice([1, 2])] = None
            out.append(tuple(row))
            if rnd.random() < 0.2:
                out.append(tuple(row))
            if rnd.random() < 0.2:
                out.append((*row[:3], "Y", "X", row[5]))
    return out


SCHEMA = "patid string, enr_start date, enr_end date, medcov string, drugcov string, chart string"


def by_patient(rows):
    groups = defaultdict(list)
    for r in rows:
        groups[r[0]].append(r)
    return groups


def span_key(r):
    return (low(r[1]), low(r[2]), *r[3:])


def overlaps_by_hand(rows):
    """Two passes over sorted spans, each looking at the previous input row."""
    flagged, kept = [], []
    for group in by_patient(set(rows)).values():
        group.sort(key=span_key)
        first, invalid = [], []
        for i, r in enumerate(group):
            s, e = low(r[1]), low(r[2])
            if e < s:
                invalid.append(r)
                continue
            if i == 0:
                first.append(r)
                continue
            a, b = low(group[i - 1][1]), low(group[i - 1][2])
            if s <= a and e >= b:
                if s == a and e == b:
                    flagged.append((*r, "Duplicate"))
                elif s <= b and e <= b:
                    flagged.append((*r, "Subset"))
            else:
                first.append(r)
        for i, r in enumerate(first):
            b = low(first[i - 1][2])
            if i and (low(r[1]) <= b or low(r[2]) <= b):
                flagged.append((*r, "Overlap"))
            else:
                kept.append(r)
        kept += invalid
    return flagged, kept


def bridge_by_hand(rows, gap=46):
    out = []
    for p, group in by_patient({r[:3] for r in rows}).items():
        group.sort(key=lambda r: (low(r[1]), low(r[2])))
        periods, before = [], None
        for i, r in enumerate(group):
            limit = LOW if i == 0 or before is None else before + dt.timedelta(days=gap)
            if i == 0 or low(r[1]) > limit:
                periods.append([])
            periods[-1].append(r)
            before = r[2]
        for q in periods:
            out.append((p, min([r[1] for r in q if r[1]], default=None), max([r[2] for r in q if r[2]], default=None)))
    return out


def merge_by_hand(rows):
    out = []
    for p, group in by_patient({r[:3] for r in rows if r[1] and r[2]}).items():
        cur = None
        for _, s, e in sorted(group):
            if cur is None:
                cur = [s, e]
            elif s > cur[1] + dt.timedelta(days=1):
                out.append((p, *cur))
                cur = [s, e]
            else:
                cur[1] = max(e, cur[1])
        out.append((p, *cur))
    return out


def text(rows):
    return Counter(tuple(map(str, r)) for r in rows)


@pytest.mark.parametrize("seed", [1, 2])
def test_overlaps(spark, seed):
    rows = random_spans(seed)
    df = spark.createDataFrame(rows, SCHEMA)
    flagged, kept = overlaps_by_hand(rows)
    assert text(spans.overlaps(df).collect()) == text(flagged)
    assert text(spans.without_overlaps(df).collect()) == text(kept)


def test_overlap_summary_has_zeros(spark):
    df = spark.createDataFrame([("P", day(0), day(9), "Y", "Y", "Y"), ("P", day(0), day(9), "Y", "Y", "N")], SCHEMA)
    got = {(r.dateconflict, r.counttype): r["count"] for r in spans.overlap_summary(spans.overlaps(df)).collect()}
    assert got[("Duplicate", "Records")] == 1 and got[("Overlap", "Records")] == 0 and len(got) == 6


def test_unbridged_needs_the_next_day_and_equal_coverage(spark):
    rows = [("P", day(0), day(9), "Y", "Y", None), ("P", day(10), day(19), "Y", "Y", None), ("P", day(20), day(29), "Y", "N", None),
            ("P", day(31), day(39), "Y", "N", None), ("Q", day(40), day(49), "Y", "Y", None)]
    got = spans.unbridged(spark.createDataFrame(rows, SCHEMA)).collect()
    assert [(r.patid, r.enr_start) for r in got] == [("P", day(10))]


@pytest.mark.parametrize("seed", [3, 4])
def test_bridge(spark, seed):
    rows = random_spans(seed)
    got = spans.bridge(spark.createDataFrame(rows, SCHEMA), ["patid"]).collect()
    assert text(got) == text(bridge_by_hand(rows))


@pytest.mark.parametrize("pause, periods", [(46, 1), (47, 2)])
def test_bridge_gap(spark, pause, periods):
    rows = [("P", day(0), day(10), "Y", "Y", "Y"), ("P", day(10 + pause), day(90), "Y", "Y", "Y")]
    assert spans.bridge(spark.createDataFrame(rows, SCHEMA), ["patid"]).count() == periods


def test_bridge_and_merge_differ_on_nested_spans(spark):
    rows = [("P", day(0), day(300), "Y", "Y", "Y"), ("P", day(10), day(20), "Y", "Y", "Y"), ("P", day(100), day(110), "Y", "Y", "Y")]
    df = spark.createDataFrame(rows, SCHEMA)
    assert spans.bridge(df, ["patid"]).count() == 2
    assert spans.merge_periods(df, ["patid"], "enr_start", "enr_end").count() == 1


@pytest.mark.parametrize("seed", [5, 6])
def test_merge(spark, seed):
    rows = [r for r in random_spans(seed) if r[1] and r[2]]
    got = spans.merge_periods(spark.createDataFrame(rows, SCHEMA), ["patid"], "enr_start", "enr_end").collect()
    assert text(got) == text(merge_by_hand(rows))


def random_dates(seed, patients=130):
    rnd = random.Random(seed)
    return [(f"P{p}", day(rnd.randint(-20, 460)) if rnd.random() > 0.05 else None)
            for p in range(patients) for _ in range(rnd.randint(1, 8))]


def test_day_coverage_counts_spans_that_hold_the_day(spark):
    rows, dates = random_spans(7), random_dates(8)
    groups = by_patient(rows)
    want = Counter()
    for p, d in dates:
        if d:
            whole = [r for r in groups.get(p, []) if r[1] and r[2]]
            want[(p, d, sum(r[1] <= d <= r[2] for r in whole), len(whole))] += 1
    df = spans.day_coverage(spark.createDataFrame(dates, "patid string, d date"), spark.createDataFrame(rows, SCHEMA), ["patid"], "d")
    got = {(r.patid, r.day, r.open_spans, r.all_spans or 0): r.n for r in df.collect()}
    assert got == dict(want)


def test_records_in_enrollment_counts_overlapping_periods_twice(spark):
    periods = spark.createDataFrame([("md", "P", day(0), day(50)), ("md", "P", day(40), day(90)), ("d", "P", day(0), day(5))],
                                    "cov string, patid string, enr_start date, enr_end date")
    dates = spark.createDataFrame([("P", day(45)), ("P", day(45)), ("P", day(91)), ("Q", day(1))], "patid string, d date")
    got = summary.records_in_enrollment(dates, periods, "d", ["d", "md"]).collect()
    assert [tuple(r) for r in got] == [("md", 4, 1)]


@pytest.mark.parametrize("coverage, column", [("medcov", 3), ("drugcov", 4)])
def test_uncovered_patients(spark, coverage, column):
    rows, dates = random_spans(9), random_dates(10)
    groups, want = by_patient(rows), {}
    for p in {p for p, _ in dates} & set(groups):
        mine = [d for q, d in dates if q == p]
        good = [r for r in groups[p] if r[column] == "Y" and r[2] and low(r[1]) <= r[2]]
        if not any(d and low(r[1]) <= d <= r[2] for d in mine for r in good):
            want[p] = len(mine)
    df = spans.uncovered_patients(spark.createDataFrame(dates, "patid string, d date"), spark.createDataFrame(rows, SCHEMA), coverage, "d")
    assert {r.patid: r.n_records for r in df.collect()} == want and want


def test_outside_span_pairs_and_uncovered_dates(spark):
    enr = spark.createDataFrame([("P", day(0), day(10), "Y", "Y", "Y"), ("P", day(5), day(20), "Y", "Y", "Y"), ("P", day(9), day(2), "Y", "Y", "Y")], SCHEMA)
    dates = spark.createDataFrame([("P", day(7)), ("P", day(10)), ("P", day(10)), ("P", day(30)), ("Q", day(1)), (None, day(1))], "patid string, d date")
    got = {(r.patid, r.d): (r.n, r.n_pairs) for r in spans.outside_span_pairs(dates, enr, ["patid"], "d").collect()}
    assert got == {("P", day(7)): (1, 1), ("P", day(10)): (2, 2), ("P", day(30)): (1, 3)}
    late = spans.uncovered_dates(dates, enr, ["patid"], "d").collect()
    assert {(r.patid, r.d) for r in late} == {("P", day(30)), ("Q", day(1)), (None, day(1))}


def test_no_enrollment_rows_at_all(spark):
    enr = spark.createDataFrame([], SCHEMA)
    dates = spark.createDataFrame([("P", day(7))], "patid string, d date")
    assert spans.uncovered_patients(dates, enr, "medcov", "d").count() == 0
    assert spans.uncovered_dates(dates, enr, ["patid"], "d").count() == 1
    assert spans.bridge(enr, ["patid"]).count() == 0


def test_periods_by_year_counts_periods_and_skips_inverted(spark):
    rows = [("P", dt.date(2019, 6, 1), dt.date(2021, 1, 1)), ("P", dt.date(2021, 5, 1), dt.date(2021, 6, 1)), ("Q", dt.date(2022, 1, 1), dt.date(2020, 1, 1))]
    df = spark.createDataFrame(rows, "patid string, enr_start date, enr_end date")
    assert {r.year: r["count"] for r in summary.periods_by_year(df).collect()} == {2019: 1, 2020: 1, 2021: 2}


def test_vitals_modes(spark):
    vit = spark.createDataFrame([("P", day(1), None, 2.0, 3.0, 4.0), ("P", day(1), 1.0, 2.0, None, 4.0), ("Q", day(99), 1.0, 1.0, 1.0, 1.0)],
                                "patid string, measure_date date, ht double, wt double, diastolic double, systolic double")
    md = spark.createDataFrame([("P", day(0), day(9)), ("Q", day(0), day(9))], "patid string, enr_start date, enr_end date")
    assert {r.vs_type: r["count"] for r in summary.vitals_in_enrollment(vit, md, "prefix").collect()} == {"HGT": 1, "WGT": 1}
    assert {r.vs_type for r in summary.vitals_in_enrollment(vit, md, "all").collect()} == {"HGT", "WGT", "DIA", "SYS"}
    with pytest.raises(ValueError):
        summary.vitals_in_enrollment(vit, md, "some")


def test_exclude_and_restrict_match_nulls(spark, rows):
    df = spark.createDataFrame([("a", 1), (None, 2), ("b", 3)], "patid string, n int")
    out = spark.createDataFrame([("a",), ("a",), (None,)], "id string")
    assert rows(spans.exclude(df, out, {"patid": "id"})) == [("b", 3)]
    assert sorted(r.n for r in spans.restrict(df, out, {"patid": "id"}).collect()) == [1, 2]


def test_percentile_definitions_differ(spark):
    df = spark.createDataFrame([(day(0), 1), (day(10), 1), (day(20), 2)], "d date, n long")
    smooth = summary.date_percentiles(df, ["d"]).collect()[0]
    rank = summary.date_percentiles_by_rank(df, "d").collect()[0]
    assert (smooth.n, smooth.median, rank.n, rank.median) == (4, day(15), 4, day(15))
    assert (smooth.p25, rank.p25) == (day(7), day(5))


def test_completeness_window(spark):
    counts = {1: 2, 2: 10, 3: 10, 4: 9, 5: 3}
    rows = [(dt.date(2020, m, 1 + i),) for m, n in counts.items() for i in range(n)]
    df = spark.createDataFrame(rows, "d date")
    got = [tuple(r) for r in summary.completeness({"enc": (df, "d")}).collect()]
    assert got == [("ENC", dt.date(2020, 2, 1), dt.date(2020, 4, 30), -1)]


def test_attrition_counts_rows_and_distinct(spark, rows):
    df = spark.createDataFrame([("a", 1, None), ("a", 1, 5), ("b", 2, 5), (None, 3, 5)], "p string, d int, x int")
    steps = [F.col("p").isNull(), F.col("x") > 4]
    assert rows(summary.attrition(df, steps, "g").select("level", "num", "removed")) == [("1", 3, 1), ("2", 1, 2)]
    assert rows(summary.attrition(df, steps, "g", ["p", "d"]).select("level", "num", "removed")) == [("1", 2, 1), ("2", 1, 1)]


def test_day_coverage_holds_a_fixed_share_of_rows_in_a_task(spark):
    """Rows that pack well are not put together again: both shuffles keep their number of partitions."""
    days = spark.range(0, 40_000, 1, 8).select(
        F.concat(F.lit("M"), F.col("id") % 4000).alias("patid"), F.date_add(F.lit("2020-01-01"), (F.col("id") % 7).cast("int")).alias("d")
    )
    enr = days.select("patid", F.col("d").alias("enr_start"), F.date_add("d", 3).alias("enr_end")).distinct()
    out = spans.day_coverage(days, enr, ["patid"], "d")
    assert out.rdd.getNumPartitions() == spans.PARTS
    assert out.agg(F.sum("n")).first()[0] == 40_000
    # One patient and day of very many rows reaches the last task as a few rows.
    one = spark.range(0, 20_000, 1, 40).select(F.lit("M").alias("patid"), F.lit("2020-01-01").cast("date").alias("d"))
    only = spans.day_coverage(one, enr.limit(1), ["patid"], "d", weights={"n": F.lit(1), "rows": F.lit(1)}).where("patid = 'M'")
    assert tuple(only.select("n", "rows").first()) == (20_000, 20_000)
