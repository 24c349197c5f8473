import pytest
from pyspark.sql import functions as F

from carelens.functions.rulesets import WHOLE_MARK, VARIABLE_RULES, Flag, VariableRule, flag, flags_frame, rules_frame
from carelens.operators import flags as fl
from carelens.operators import profile
from carelens.sources import tables

MIL = "mpatid string, cpatid string, adate date, encounterid string, birth_type int, age int"


def mil(spark, *rows):
    return spark.createDataFrame(list(rows), MIL.replace("adate date", "adate string")).withColumn("adate", F.col("adate").cast("date"))


def compliance(spark, df, rules=VARIABLE_RULES):
    return profile.compliance(profile.contents(df, "mil"), rules_frame(spark, rules))


def test_missing_and_empty_tables(spark, rows):
    empty = mil(spark).limit(0)
    counts = profile.row_counts({"mil": empty, "enr": spark.range(3).toDF("patid")})
    assert rows(counts) == [("ENR", 3), ("MIL", 0)]
    assert [r.flagid for r in profile.empty_tables(counts).collect()] == ["MIL_1_00_00-0_101"]
    lost = profile.missing_tables(spark, ["mil", "dem"], counts).collect()
    assert [(r.flagid, r["count"], r.abort_yn) for r in lost] == [("DEM_1_00_00-0_100", WHOLE_MARK, "Y")]


def test_missing_column_shows_on_an_empty_table(spark):
    df = mil(spark).drop("encounterid").limit(0)
    hits = profile.structure_flags(compliance(spark, df)).where("flagid like '%110'").collect()
    assert [(h.flagid, h.value, h["count"]) for h in hits] == [("MIL_1_04_00-0_110", "NA", WHOLE_MARK)]


def test_wrong_type_and_declared_length(spark):
    df = mil(spark, ("M1", "C1", "2020-01-01", "E1", 1, 20)).withColumn("birth_type", F.col("birth_type").cast("string"))
    df = df.withColumn("mpatid", F.col("mpatid").alias("mpatid", metadata={"__CHAR_VARCHAR_TYPE_STRING": "varchar(15)"}))
    comp = compliance(spark, df)
    got = {h.flagid: h.value for h in profile.structure_flags(comp).collect()}
    assert got["MIL_1_05_00-0_112"] == "C"
    assert got["MIL_1_01_00-0_113"] == "15"
    gate = {r["var"]: (r.exclude, r.value_rules) for r in profile.gate(comp, profile.value_counts(df, VARIABLE_RULES)).collect()}
    assert gate["Birth_Type"] == ("y1", "N") and gate["MPatID"] == ("y2", "N") and gate["Age"] == ("n", "Y")


def test_unpopulated_takes_the_place_of_null_count(spark, rows):
    df = mil(spark, ("M1", None, "2020-01-01", "E1", 1, 20), (None, None, "2020-01-01", "E1", 1, 20))
    got = profile.population_flags(profile.value_counts(df, VARIABLE_RULES), flags_frame(spark))
    assert rows(got) == [("MIL_1_01_00-0_120", "MPatID", "_null_", 1, False), ("MIL_1_02_00-0_111", "CPatID", "_null_", WHOLE_MARK, True)]


def test_special_missing_counts_apart(spark):
    df = spark.createDataFrame([(None, "A"), (None, None), ("2020", None)], "cbirth_date string, cbirth_date__miss string")
    rule = VariableRule("CBirth_Date", "07", "N", 8, valid_value_type="special_missing")
    r = profile.value_counts(df, [rule]).collect()[0]
    assert (r.count_obs, r.count_nomiss, r.count_spmiss, r.count_null) == (3, 1, 1, 1)


def test_age_bounds_and_condition(spark, rows):
    df = mil(spark, ("M1", "C1", "2020-01-01", "E1", 0, 25), ("M2", "C2", "2020-01-01", "E2", 9, 5), ("M3", None, "2020-01-01", "E3", None, 60),
             ("M4", "C4", "2020-01-01", "E4", 8, 10), ("M5", "C5", "2020-01-01", "E5", 0, 54), ("M6", "C6", "2020-01-01", "E6", 1, None))
    hits = profile.value_rules(df, [flag("121"), flag("126")], VARIABLE_RULES)
    assert rows(hits.select("flagid", "value", "mpatid", "cpatid", "count")) == [
        ("MIL_1_05_00-0_121", "0", None, None, 2),
        ("MIL_1_05_00-0_121", "9", None, None, 1),
        ("MIL_1_06_00-0_126", "5", "M2", "C2", 1),
        ("MIL_1_06_00-0_126", "60", "M3", None, 1),
    ]


def test_value_rules_skip_absent_and_mistyped_columns(spark):
    df = mil(spark, ("M1", "C1", "2020-01-01", "E1", 9, 5)).withColumn("birth_type", F.lit("x"))
    got = profile.value_rules(df, [flag("121"), flag("126")], VARIABLE_RULES).collect()
    assert [r.flagid for r in got] == ["MIL_1_06_00-0_126"]


def test_date_window_is_inclusive(spark):
    df = mil(spark, *[("M", "C", d, "E", 1, 20) for d in ("2009-12-31", "2010-01-01", "2025-12-31", "2026-01-01")])
    low, high = F.lit("2010-01-01").cast("date"), F.lit("2025-12-31").cast("date")
    got = profile.value_rules(df, [flag("131")], VARIABLE_RULES, low, high)
    assert sorted(r.value for r in got.collect()) == ["01/01/2026", "12/31/2009"]


@pytest.mark.parametrize("strict, want", [(False, {"O Neil", "X7", " Lead"}), (True, {"O Neil", "X7", "O'Neil", "Mary-Ann", " Lead"})])
def test_names(spark, strict, want):
    names = ["Anna", "O'Neil", "Mary-Ann", "O Neil", "X7", " Lead"]
    df = spark.createDataFrame([(f"M{i}", None, n) for i, n in enumerate(names)], "mpatid string, cpatid string, mlname string")
    flags = [Flag("133", 1, "20", "name", variable1="MLName"), Flag("122", 1, "20", "blank", variable1="MLName")]
    got = profile.value_rules(df, flags, [], strict_names=strict).collect()
    bad = {r.value for r in got if r.flagid.endswith("133")}
    assert bad == want - {" Lead"}
    assert {r.value for r in got if r.flagid.endswith("122")} == {" Lead"}


def test_long_ids_and_null_rows(spark):
    df = mil(spark, ("M" * 21, "C1", "2020-01-01", "E1", 1, 20), (None, "C2", "2020-01-01", "E2", None, 20))
    assert [(r.variable, r.encounterid) for r in profile.too_long(df, VARIABLE_RULES, ["encounterid"]).collect()] == [("MPatID", "E1")]
    got = profile.null_rows(df, VARIABLE_RULES, ["encounterid"]).collect()
    assert sorted(r.variable for r in got) == ["Birth_Type", "MPatID"]


MARKED = [("f", "v", "x", WHOLE_MARK, True), ("f", "v", "x", 150_000, False), ("g", "v", "x", WHOLE_MARK, False), ("g", "v", "x", 5, False)]


def test_only_marked_rows_keep_the_mark(spark):
    """A count may equal the mark; a mark beside a larger count stays the mark."""
    df = spark.createDataFrame(MARKED, "flagid string, variable string, value string, count long, whole boolean")
    assert {r.flagid: (r["count"], r.whole) for r in fl.roll_up_values(df).collect()} == {"f": (WHOLE_MARK, True), "g": (100_004, False)}
    named = df.selectExpr("flagid", "'N' abort_yn", "'Warn' flag_type", "'d' flag_descr", "count", "whole")
    plain = spark.createDataFrame([("h", "N", "Warn", "d", 7)], "flagid string, abort_yn string, flag_type string, flag_descr string, count long")
    assert {r.flagid: (r["count"], r.whole) for r in fl.roll_up([named, plain]).collect()} == {
        "f": (WHOLE_MARK, True), "g": (100_004, False), "h": (7, False)}


def test_counts_without_a_lookup_row_stay(spark):
    df = spark.createDataFrame([("126", "MIL", 99_999, False), ("126", "MIL", 5, False), ("000", "MIL", 4, False), (None, "MIL", 1, False)],
                               "checkid string, tableid string, n long, whole boolean")
    got = {(r.flagid, r["count"], r.whole) for r in fl.count_flags(df, flags_frame(spark), ["checkid", "tableid"], "n").collect()}
    assert got == {("MIL_1_06_00-0_126", 100_004, False), (None, 5, False)}


def test_lookups_of_any_size(spark):
    many = [Flag(str(i), 1, "00", f"check {i}") for i in range(20_000)]
    df = spark.createDataFrame([("19999", "MIL"), ("7", "MIL")], "checkid string, tableid string")
    got = {r.flag_descr: r["count"] for r in fl.count_flags(df, flags_frame(spark, many), ["checkid", "tableid"]).collect()}
    assert got == {"check 19999": 1, "check 7": 1}
    rules = [VariableRule(f"v{i}", f"{i:05}", "C", 20) for i in range(20_000)]
    assert rules_frame(spark, rules).count() == 20_000


def test_table_size_is_what_the_file_system_says(spark, tmp_path):
    spark.range(1000).repartition(3).write.parquet(str(tmp_path / "t"))
    files = [f for f in (tmp_path / "t").iterdir() if f.name.startswith("part-")]
    got = profile.table_size(spark, [str(f) for f in files], "t").collect()[0]
    assert (got.tabid, got.filesize, got.nfiles) == ("T", sum(f.stat().st_size for f in files), len(files))
    plan = profile.table_size(spark, str(tmp_path / "t"), "t")._jdf.queryExecution().executedPlan().toString()
    assert "content" not in plan


def test_lookup_changes_change_the_output(spark):
    df = spark.createDataFrame([("126", "MIL"), ("126", "MIL"), ("999", "MIL")], "checkid string, tableid string")
    renamed = [Flag("126", 1, "77", "other text", "Abort", "Y")]
    got = [tuple(r) for r in fl.count_flags(df, flags_frame(spark, renamed), ["checkid", "tableid"]).collect()]
    assert sorted(got, key=repr) == sorted([("MIL_1_77_00-0_126", "Y", "Abort", "other text", 2, False), (None, None, None, None, 1, False)], key=repr)


def test_tables_by_name_and_prefix(spark, tmp_path):
    a, b = spark.range(3).toDF("x"), spark.range(2).selectExpr("cast(id as string) x", "id y")
    a.write.parquet(str(tmp_path / "a"))
    b.select("y").withColumnRenamed("y", "x").write.parquet(str(tmp_path / "b"))
    found = tables.read_tables(spark, {"Enr": [str(tmp_path / "a"), str(tmp_path / "b")], "MIL": str(tmp_path / "a")})
    assert tables.table(found, "eNr").count() == 5
    with pytest.raises(KeyError, match="dem"):
        tables.table(found, "dem")
    assert tables.merge_split({"enr1": a, "enr2": a, "enrx": b}, "ENR").count() == 6
    both = tables.stack_as_text({"f_a": a.withColumnRenamed("x", "value"), "f_b": b.withColumnRenamed("x", "value")}, "f_")
    assert dict(both.dtypes)["value"] == "string" and both.count() == 5


def test_blank_is_missing_and_bad_dates_become_null(spark):
    df = spark.createDataFrame([("  ", "2020-01-02"), ("a  ", "nope"), (None, None)], "s string, d string")
    got = [tuple(r) for r in tables.iso_dates(tables.blank_to_null(df, "s"), "d").selectExpr("s", "string(d)").collect()]
    assert got == [(None, "2020-01-02"), ("a", None), (None, None)]


def test_tables_without_ruled_columns(spark):
    df = spark.createDataFrame([("x",)], "other string")
    assert profile.value_rules(df, [flag("126")], VARIABLE_RULES).count() == 0
    assert profile.too_long(df, VARIABLE_RULES, ["other"]).count() == 0
    assert profile.null_rows(df, VARIABLE_RULES, ["other"]).count() == 0
    counts = profile.value_counts(df, VARIABLE_RULES)
    assert counts.count() == 0
    assert counts.dtypes == profile.value_counts(df.selectExpr("other mpatid"), VARIABLE_RULES).dtypes
