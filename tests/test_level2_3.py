import datetime as dt
import random
from collections import Counter, defaultdict
from itertools import combinations

import pytest
from pyspark.sql import functions as F

from carelens.operators import compare, cross, keys, linkage, rules

D = dt.date
MIL = "mpatid string, cpatid string, adate date, encounterid string, birth_type int"


def frame(spark, *rows):
    return spark.createDataFrame(list(rows), MIL)


def test_duplicates_with_and_without_null_keys(spark):
    df = frame(spark, ("M1", "C1", D(2020, 1, 1), "E1", 1), ("M1", "C1", D(2020, 1, 1), "E1", 1), ("M2", None, D(2020, 1, 1), "E2", 1),
               ("M2", None, D(2020, 1, 1), "E3", 1), ("M3", "C3", D(2020, 1, 1), "E4", 1))
    k = ["mpatid", "cpatid", "adate"]
    assert sorted(r.mpatid for r in keys.duplicate_rows(df, k).collect()) == ["M1", "M1", "M2", "M2"]
    assert sorted(r.mpatid for r in keys.duplicate_rows(df, k, nulls_equal=False).collect()) == ["M1", "M1"]
    assert keys.surplus_duplicates(df, k, "mil").collect()[0].count_dup == 2
    assert keys.surplus_duplicates(df.limit(0), k, "mil").collect()[0].count_dup == 0
    # the same check ids in their other reading
    assert sorted(r.encounterid for r in keys.unlinked_duplicates(df, ["mpatid", "adate"]).collect()) == ["E2", "E3"]
    assert [r.mpatid for r in keys.linked_duplicates(df, ["mpatid", "cpatid"]).collect()] == ["M1", "M1"]


def test_value_conflict_counts_only_duplicate_rows(spark):
    rows = [("M1", "C1", "E1", "F"), ("M1", "C2", "E1", "M"), ("M2", "C3", "E2", "F"), ("M2", "C4", "E2", "F"), ("M3", "C5", "E3", "F"),
            ("M4", "C6", "E4", "F"), ("M4", "C7", "E4", None), ("M5", None, "E5", "F"), ("M5", "C8", "E5", "M")]
    df = spark.createDataFrame(rows, "mpatid string, cpatid string, encounterid string, sex string").withColumn("one", F.lit(1))
    got = keys.linked_value_conflict(df, ["mpatid", "encounterid", "one", "sex"])
    assert sorted(r.mpatid for r in got.collect()) == ["M1", "M1"]
    # three variables: (mpatid, encounterid, sex) must itself repeat before sex can differ
    more = df.unionByName(df.where("mpatid = 'M1'"))
    got = keys.linked_value_conflict(more, ["mpatid", "encounterid", "sex"])
    assert sorted(r.mpatid for r in got.collect()) == ["M1"] * 4
    assert keys.linked_value_conflict(df, ["mpatid", "encounterid", "sex"]).count() == 0


def test_row_rules_at_their_bounds(spark):
    def hit(predicate, *values, types):
        df = spark.createDataFrame([values], types)
        return rules.hits(df, predicate).count() == 1

    two = "a date, b date"
    assert not hit(rules.min_gap_years("a", "b"), D(2000, 1, 1), D(2010, 1, 1), types=two)
    assert hit(rules.min_gap_years("a", "b"), D(2000, 1, 1), D(2009, 12, 30), types=two)
    assert hit(rules.min_gap_years("a", "b"), D(2001, 1, 1), D(2000, 1, 1), types=two)
    assert not hit(rules.min_gap_years("a", "b"), None, D(2000, 1, 1), types=two)
    assert not hit(rules.max_gap_days("a", "b"), D(2020, 6, 29), D(2020, 1, 1), types=two)
    assert hit(rules.max_gap_days("a", "b"), D(2020, 6, 30), D(2020, 1, 1), types=two)
    stay = "adate date, birth date, ddate date"
    for birth, ddate, bad in [(7, 15, False), (6, 15, True), (15, 15, False), (16, 15, True), (11, None, False), (12, None, True)]:
        got = hit(rules.birth_window("adate", "birth", "ddate"), D(2020, 1, 10), D(2020, 1, birth), ddate and D(2020, 1, ddate), types=stay)
        assert got is bad
    for d, bad in [(D(2009, 12, 31), True), (D(2010, 1, 1), False), (D(2025, 12, 31), False), (D(2026, 1, 1), True), (None, False)]:
        assert hit(rules.out_of_range("a", "2010-01-01", "2025-12-31"), d, types="a date") is bad
    for b, bad in [(0, True), (1, False), (8, False), (99, True), (None, False)]:
        assert hit(rules.outside_domain("b", list(range(1, 9))), b, types="b int") is bad
    for m, bad in [(" re ", False), ("N1", True), (None, True)]:
        assert hit(rules.code_outside("m", ["RE"]), m, types="m string") is bad
    assert hit(rules.requires("a", "b"), D(2020, 1, 1), None, types=two)
    assert not hit(rules.requires("a", "b"), None, None, types=two)


def test_birth_type_linkage_default_fixture(spark):
    df = frame(spark, ("M1", "C1", D(2020, 1, 1), "E1", 1), ("M2", "C2", D(2020, 2, 1), "E2", 2), ("M3", "C3", D(2020, 3, 1), "E3", 3),
               ("M4", None, D(2020, 3, 1), "E4", 2), ("M5", "C5", D(2020, 3, 1), "E5", 6))
    got = linkage.birth_type_linkage(df).collect()
    assert sorted(r.flagid for r in got) == ["MIL_3_00_00-0_372", "MIL_3_00_00-0_373"]
    assert "Adate (02/01/2020), Birth_type (2):Birth_Type value not" in sorted(r.message for r in got)[0]


def test_linkage_gaps(spark):
    df = frame(spark, ("M1", None, D(2020, 1, 1), "E1", 8), ("M2", None, D(2020, 1, 1), "E2", 9), (None, "C3", None, None, 1)).withColumn("cbirth_date", F.col("adate"))
    got = Counter(r.flagid[-3:] for r in linkage.linkage_gaps(df, ["mpatid"]).collect())
    assert got == {"394": 1, "396": 2, "397": 1}


def test_encounters_over_birth_type(spark):
    rows = [("M1", "C", None, "E1", b) for b in (None, 1, 1, 9, 9, 0, 8)]
    over = linkage.over_birth_type(linkage.deliveries_per_encounter(frame(spark, *rows))).collect()
    assert sorted((r.birth_type or -1, r.n_deliveries) for r in over) == [(-1, 1), (1, 2)]


@pytest.mark.parametrize("n, depth", [(10, 3), (8, 3), (3, 2), (2, 3), (4, 1)])
def test_class_parents_cover_every_choice_once(n, depth):
    parents = linkage.class_parents(n, depth)
    given = [m for masks in parents.values() for m in masks]
    assert sorted(given) == sorted(set(linkage.class_masks(n, min(depth, n))))
    assert all(m & p == m for p, masks in parents.items() for m in masks)


def test_cross_tab_by_hand(spark):
    rnd = random.Random(1)
    data = [tuple(rnd.choice(["x", "y", None]) for _ in range(4)) for _ in range(200)]
    names = ["a", "b", "c", "d"]
    want = Counter()
    for row in data:
        for k in range(4):
            for pick in combinations(range(4), k):
                mask = sum(1 << (3 - i) for i in pick)
                want[(f"{mask:03d}", *[row[i] if i in pick else None for i in range(4)])] += 1
    got = linkage.cross_tab(spark.createDataFrame(data, "a string, b string, c string, d string"), names)
    assert {(r.level, r.a, r.b, r.c, r.d): r["count"] for r in got.collect()} == dict(want)
    assert {r.level: r.level_desc for r in got.collect()}["000"] == "Overall"
    assert {r.level: r.level_desc for r in got.collect()}["013"] == "a    b    d"


def test_icd_version_and_status(spark):
    df = spark.createDataFrame(
        [("M", "C", "E", D(2015, 9, 30), None, None), ("M", None, "E", D(2015, 10, 1), None, None), (None, "C", None, None, None, None)],
        "mpatid string, cpatid string, encounterid string, adate date, ddate date, cbirth_date date",
    ).selectExpr("*", "1 birth_type", "20 age", "'IP' enctype", "'F' sex", "'RE' matchmethod")
    got = {(r.linkagestatus, r.icd_ver, r.year, r.daysdiff) for r in linkage.linkage_columns(df).collect()}
    assert got == {("L", "9", "2015", "09:NA"), ("M", "0", "2015", "09:NA"), ("C", "9", None, "09:NA")}


# --- across tables --------------------------------------------------------------------------


def test_date_order_pairs_by_hand(spark):
    rnd = random.Random(5)
    day = lambda: D(2020, 1, rnd.randint(1, 28)) if rnd.random() > 0.1 else None
    a = [(rnd.choice(["p", "q", "r", "s", None]), day()) for _ in range(60)]
    b = [(rnd.choice(["p", "q", "t", "u", None]), day()) for _ in range(60)]
    one, two = spark.createDataFrame(a, "patid string, d date"), spark.createDataFrame(b, "patid string, d date")
    for later in (True, False):
        for drop in (True, False):
            left, right, want = defaultdict(list), defaultdict(list), Counter()
            for p, d in a:
                if d:
                    left[p].append(d)
            for p, d in b:
                if d or not drop:
                    right[p].append(d or D.min)
            for p in set(left) | set(right):
                for x in left[p] or [D.min]:
                    for y in right[p] or [D.min]:
                        want[p] += x > y if later else x < y
            got = cross.date_order_pairs(one, two, "d", "d", later, drop_null2=drop)
            assert {r.patid: r.n_pairs for r in got.collect()} == {p: n for p, n in want.items() if n}


def test_references_and_nulls(spark, rows):
    a = spark.createDataFrame([("x", None), ("x", "e"), ("y", "e"), (None, "e"), ("x", None)], "mpatid string, encounterid string")
    ref = spark.createDataFrame([("x", None), (None, None)], "mpatid string, encounterid string")
    assert rows(cross.not_in_reference(a, ref, {"mpatid": "mpatid", "encounterid": "encounterid"})) == [("x", "e"), ("y", "e")]
    assert [r.mpatid for r in cross.rows_not_in_reference(a, ref, "mpatid", "mpatid").collect()] == ["y"]
    assert cross.rows_not_in_reference(a, ref.limit(0), "mpatid", "mpatid").count() == 4


def test_attribute_mismatch_by_hand(spark):
    rnd = random.Random(3)
    a = [(rnd.choice(["k", "l", "m", None]), rnd.choice(["1", "2", "3", None])) for _ in range(40)]
    b = [(rnd.choice(["k", "l", None]), rnd.choice(["1", None])) for _ in range(6)] + [("m", "3")]
    want = {x for k, x in a for j, y in b if k == j and x is not None and x != y}
    got = cross.attribute_mismatch(spark.createDataFrame(a, "k string, v string"), spark.createDataFrame(b, "j string, w string"), ("k", "j"), ("v", "w"))
    assert {r.value for r in got.collect()} == want


def test_presence_matrix_and_patterns(spark, rows):
    t = {n: (spark.createDataFrame([(x,) for x in ids], "patid string"), "patid") for n, ids in {"mil": ["a", "a", "b", None], "enr": ["b", "c"]}.items()}
    m = cross.presence_matrix(t)
    assert rows(m) == [("0", "1", 1), ("1", "0", 1), ("1", "1", 1)]
    assert rows(cross.pattern_counts(m, [("mil", "enr"), ("enr", "mil")])) == [("enr", "mil", 1), ("mil", "enr", 1)]


def test_value_lengths_missing_on_one_side(spark, rows):
    t = {"a": spark.createDataFrame([("xx",), ("yyy",)], "v string"), "b": spark.createDataFrame([(None,)], "v string")}
    got = cross.value_length_mismatch(cross.value_lengths(t, "v"), "a", "b", "v")
    assert rows(got.select("length1", "length2")) == [(2, None), (3, None)]


def test_value_lengths_of_one_side_grow_with_the_lengths(spark, rows):
    """40 and 30 lengths, 10 of them shared: 50 rows, where pairs would be 1,190."""
    t = {"a": spark.range(40).selectExpr("repeat('x', cast(id + 1 as int)) v"), "b": spark.range(60).selectExpr("repeat('y', cast(id % 30 + 31 as int)) v")}
    lengths = cross.value_lengths(t | {"c": t["a"]}, "v")
    got = rows(cross.value_length_differences(lengths, [("a", "b")], "v").drop("table1", "table2", "variable"))
    assert got == sorted([(n, None, 1, None) for n in range(1, 31)] + [(None, n, None, 2) for n in range(41, 61)], key=repr)
    assert cross.value_length_mismatch(lengths, "a", "b", "v").count() == 40 * 30 - 10
    many = cross.value_length_differences(lengths, [("a", "c"), ("a", "b"), ("b", "c")], "v")
    assert rows(many.groupBy("table1", "table2").count()) == [("A", "B", 50), ("B", "C", 50)]


def test_value_lengths_of_an_empty_table(spark, rows):
    t = {"a": spark.createDataFrame([("xx",), ("yyy",), ("zz ",)], "v string"), "b": spark.createDataFrame([(None,)], "v string")}
    got = cross.value_length_differences(cross.value_lengths(t, "v"), [("a", "b")], "v")
    assert rows(got) == [("A", "B", "v", 2, None, 2, None), ("A", "B", "v", 3, None, 1, None)]


# --- comparison -----------------------------------------------------------------------------


@pytest.mark.parametrize("name, want", [("FlagType", "flag_type"), ("AbortYN", "abort_yn"), ("flag_descr", "flag_descr"), ("ADate", "a_date"), ("Birth_Type", "birth_type"), ("x1Y", "x1_y"), ("A1B", "a1_b"), ("ID2name", "id2name"), ("ABCd", "ab_cd"), ("MPatID", "m_pat_id")])
def test_snake_case(name, want):
    assert compare.snake_case(name) == want


def test_result_differences(spark):
    schema = "flagid string, message string, abort_yn string, mpatid string"
    e = spark.createDataFrame([("f1", "m", "N", "M1"), ("f1", "m", "N", None), ("f2", "m", "N", "M1")], schema)
    a = spark.createDataFrame([("f1", "other", "N", "M1"), ("f1", "m", "Y", None), ("f3", "m", "N", "M9")], schema)
    got = Counter((r.kind, r.key) for r in compare.result_differences(e, a, ["flagid", "mpatid"]).collect())
    assert got == Counter([("missing", "f2|M1"), ("unexpected", "f3|M9"), ("message", "f1|M1"), ("message", "f1|M1"),
                           ("strict", "f1|(null)"), ("strict", "f1|(null)"), ("flagid_expected_only", "f2"), ("flagid_actual_only", "f3")])
    told = e.withColumn("message", F.lit("reworded"))
    match = compare.is_match(compare.result_differences(e, told, ["flagid", "mpatid"])).collect()[0]
    assert match.is_match and match.message == 6  # two values of each of three keys


def test_result_differences_of_repeated_keys(spark):
    """Values and row counts of a key are compared as often as they stand; null is not the empty string."""
    def table(*rows):
        return spark.createDataFrame([("f", d, "N", p) for p, d in rows], "flagid string, flag_descr string, abort_yn string, mpatid string")

    def told(e, a):
        return sorted((r.kind, r.key, r.field, r.value or "", r.n_expected, r.n_actual) for r in compare.result_differences(e, a, ["flagid", "mpatid"]).collect())

    e = table(("M", "d1"), ("M", "d2"), ("M", "d3"))
    a = table(("M", "d1"), ("M", "d3"), ("M", "d3"), ("M", "d1"))
    assert told(e, e) == []
    assert told(e, a) == sorted([("rows", "f|M", "", "", 3, 4), ("strict", "f|M", "flag_descr", "d1", 1, 2), ("strict", "f|M", "flag_descr", "d2", 1, 0),
                                 ("strict", "f|M", "flag_descr", "d3", 1, 2), ("strict", "f|M", "abort_yn", "N", 3, 4)])
    assert [t[:2] for t in told(table((None, "d")), table(("", "d")))] == [("missing", "f|(null)"), ("unexpected", "f|")]


def test_header_ignores_exactly_one_hour(spark):
    def head(*rows):
        return spark.createDataFrame(list(rows), "memname string, memtype string, nobs long, crdate string, modate string").selectExpr(
            "memname", "memtype", "nobs", "timestamp(crdate) crdate", "timestamp(modate) modate")

    a = head(("t1", "data", 1, "2020-01-01 10:00:00", "2020-01-01 10:00:00"), ("t2", "data", 1, "2020-01-01 10:00:00", "2020-01-01 10:00:00"))
    b = head(("t1", "data", 9, "2020-01-01 11:00:00", "2020-01-01 11:00:01"))
    got = {(r.sources, r.memname, r.variable) for r in compare.header_differences(a, b).collect()}
    assert got == {("SCDM and QA", "t1", "modate"), *{("SCDM Only", "t2", v) for v in ("memtype", "nobs", "crdate", "modate")}}
    assert compare.header_differences(a, a).count() == 0


def test_load_comparison_without_division_by_zero(spark):
    schema = "flagid string, abort_yn string, flag_type string, flag_descr string, count long"
    new = spark.createDataFrame([("a", "N", "Warn", "x", 5), ("b", "N", "Warn", "x", 5)], schema)
    old = spark.createDataFrame([("a", "Y", "Abort", "old", 0), ("c", "Y", "Abort", "old", 4)], schema)
    got = {r.flagid: (r.abort_yn, r.diff_count, r.pctchg_count) for r in compare.load_comparison(new, old).collect()}
    assert got == {"a": ("N", 5, None), "b": ("N", None, None), "c": ("Y", None, None)}
