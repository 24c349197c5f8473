import pytest
from pyspark.sql import functions as F

from carelens.functions.rulesets import flag
from carelens.operators import flags as fl
from carelens.plans.level2 import port_checks
from carelens.plans.review import review
from carelens.registry import Data
from carelens.sources import logs, sinks

# --- sinks ----------------------------------------------------------------------------------


@pytest.mark.parametrize("column", ["mpatid", "CPatID", "PATID", "EncounterID"])
def test_identifiers_are_refused_in_any_case(spark, column):
    with pytest.raises(ValueError, match=column):
        sinks.refuse_identifiers(spark.createDataFrame([(1,)], f"`{column}` int"))


def test_nested_identifiers_are_refused(spark):
    df = spark.range(1).select(F.array(F.struct(F.lit("x").alias("MPatID"))).alias("detail"))
    with pytest.raises(ValueError, match="MPatID"):
        sinks.refuse_identifiers(df)
    assert sinks.refuse_identifiers(spark.range(1).toDF("n_patid")).count() == 1


def test_nothing_is_written_when_refused(spark, tmp_path):
    with pytest.raises(ValueError):
        sinks.write_aggregate_flags(spark, [spark.createDataFrame([("x", "M")], "flagid string, mpatid string")], str(tmp_path))
    assert not list(tmp_path.iterdir())


def test_row_flags_are_aligned(spark, tmp_path):
    a = fl.with_flag(spark.createDataFrame([("M1",)], "mpatid string"), flag("396"))
    b = fl.with_flag(spark.createDataFrame([("C1", 2)], "cpatid string, birth_type int"), flag("397"))
    got = spark.read.parquet(sinks.write_row_flags(spark, [a, b], str(tmp_path)))
    assert got.columns == ["abort_yn", "birth_type", "cpatid", "flag_descr", "flag_type", "flagid", "message", "mpatid"]
    assert {(r.mpatid, r.cpatid) for r in got.collect()} == {("M1", None), (None, "C1")}


def test_no_flags_leave_an_empty_file(spark, tmp_path):
    got = spark.read.parquet(sinks.write_row_flags(spark, [], str(tmp_path)))
    assert got.columns == sinks.FLAG_COLUMNS and got.count() == 0


def test_publishing(spark, tmp_path):
    n = spark.createDataFrame([(1,)], "n int")
    work = {"counts": n, "x_mstr": n, "all_l2_flags": n, "run_signature": n}
    written = sinks.publish(work, "ab", str(tmp_path))
    assert [w.rsplit("/", 1)[1] for w in written] == ["counts", "run_signature"]
    assert spark.read.parquet(written[0]).collect()[0].dp == "AB"
    assert spark.read.parquet(written[1]).columns == ["n"]


# --- logs -----------------------------------------------------------------------------------


def test_lines_are_numbered_across_file_splits(spark, tmp_path):
    for name, n in (("a.log", 5000), ("b.log", 17)):
        (tmp_path / name).write_text("".join(f"line {i} of {name}\n" for i in range(1, n + 1)))
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "10KB")
    spark.conf.set("spark.sql.files.openCostInBytes", "1KB")
    try:
        lines = logs.read_lines(spark, str(tmp_path))
        assert spark.read.text(str(tmp_path)).rdd.getNumPartitions() > 5
        wrong = lines.where(F.concat(F.lit("line "), "logline_number", F.lit(" of "), "logname") != F.col("logline"))
        assert wrong.count() == 0 and lines.count() == 5017
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
        spark.conf.unset("spark.sql.files.openCostInBytes")


def test_logs_of_one_name_do_not_mix(spark, tmp_path):
    for folder, text in (("a", "MPRINT(ONE):  x\nNOTE: fine\n"), ("b", "ERROR: bad\n")):
        (tmp_path / folder).mkdir()
        (tmp_path / folder / "run.log").write_text(text)
    got = logs.classify_lines(logs.read_lines(spark, str(tmp_path / "*"))).collect()
    assert [(r.level, r.logname, r.logline_number, r.macro) for r in got] == [(1, "run.log", 1, None)]
    assert got[0].path.endswith("b/run.log")


@pytest.mark.parametrize("group", [2, 100_000])
def test_log_classification(spark, monkeypatch, group):
    monkeypatch.setattr(logs, "LINES_PER_GROUP", group)
    text = ["NOTE: Invalid data", "MPRINT(LOAD):  data x;", "some code", "ERROR: no file", "ERROR: (Package) bad", "WARNING: careful",
            "WARNING: (Package) careful", "NOTE: fine", "mprint(save): * missing values;", 'NOTE: "invalid" text', "Errors happened",
            "note: data step stopped due to looping", "NOTE: Missing values were generated", ""]
    df = spark.createDataFrame([("l", i, t) for i, t in enumerate(text, 1)], "logname string, logline_number long, logline string")
    got = {r.logline_number: (r.level, r.description, r.macro) for r in logs.classify_lines(df).collect()}
    assert got == {
        1: (5, "SAS Note", None), 4: (1, "SAS Error", "load"), 5: (2, "Package Error", "load"), 6: (3, "SAS Warning", "load"),
        7: (4, "Package Warning", "load"), 9: (5, "SAS Note", "save"), 13: (5, "SAS Note", "save"),
    }


# --- the whole review -----------------------------------------------------------------------

NAMES = ["mil", "enr", "dem", "enc", "dis", "lab", "vit", "dth", "cod", "del", "inf"]




def test_review_stops_at_an_empty_table(spark, tmp_path):
    d = Data(spark, "/root/testdata/sf0.001")
    done = review(spark, d.many(*NAMES) | {"mil": d("mil").limit(0)}, str(tmp_path), "site")
    assert (done.status, done.level) == ("aborted", 1)
    assert set(done.written) == {"all_l1_nobs", "table_flags"}


def test_review_stops_at_fatal_level_2_flags(spark, tmp_path):
    d = Data(spark, "/root/testdata/sf0.001")
    done = review(spark, d.many(*NAMES), str(tmp_path), "site")
    assert (done.status, done.level) == ("aborted", 2)
    found = spark.read.parquet(done.written["all_l2_flags"])
    assert found.where("abort_yn = 'Y' and count > 0").count() > 0
    # the table on its own was fatal: only fatal flags are counted, and no other table was looked at
    assert found.where("abort_yn <> 'Y'").count() == 0
    assert not {"l2_cross_mstr", "enr_l2_mstr", "mil_l2_cenrstart_agedays_cat"} & set(done.written)
    told = {r.flagid[-3:]: r.message for r in spark.read.parquet(done.written["l2_mstr"]).where("message <> ''").collect()}
    assert told["217"].startswith("MPatID (M") and told["217"].endswith("): Not linked, but variable combination appears on > 1 row")
    assert "l3_mil_aggregate" not in done.written


def test_review_to_the_end(spark, tmp_path):
    """A consistent table passes all levels; only masters carry identifiers."""
    d = Data(spark, "/root/testdata/sf0.001")
    mil = d.sql(
        """SELECT 'M' || CAST(c_custkey AS STRING) mpatid, 'C' || CAST(c_custkey AS STRING) cpatid, DATE '2000-03-01' adate, DATE '2000-03-02' ddate,
           'E' || CAST(c_custkey AS STRING) encounterid, 'IP' enctype, CAST(1 + c_custkey % 2 AS INT) birth_type, 30 age, 'O' sex, DATE '2000-03-01' cbirth_date,
           DATE '1970-01-01' mbirth_date, 'RE' matchmethod, DATE '2000-03-05' cenr_start FROM customer WHERE c_custkey % 8 <> 0 AND c_custkey % 4 IN (2, 3)"""
    )
    few = {n: d(n) for n in ("dem", "enc", "dis", "lab", "vit", "dth", "cod")}
    enr = mil.selectExpr("mpatid patid", "adate - 100 enr_start", "adate + 100 enr_end", "'Y' medcov", "'Y' drugcov", "'N' chart")
    ids = {"del": mil.select("mpatid", "encounterid"), "inf": mil.select("cpatid")}
    old = spark.createDataFrame([("MIL_9", "N", "Warn", "x", 3)], "flagid string, abort_yn string, flag_type string, flag_descr string, count long")
    done = review(spark, few | ids | {"mil": mil, "enr": enr}, str(tmp_path), "site", maxdate=F.lit("2000-06-01").cast("date"), previous=old)
    assert (done.status, done.level) == ("completed", 4)
    flags = spark.read.parquet(done.written["all_l3_flags"])
    assert [(r.flagid, r.dp) for r in flags.collect()] == [("MIL_3_00_00-0_372", "SITE")]
    for name, path in done.written.items():
        if f"/{sinks.AGGREGATE_ZONE}/" in path:
            sinks.refuse_identifiers(spark.read.parquet(path))
    assert {"sign_off", "l2_presence_matrix", "l2_surplus_duplicates", "l2_pattern_counts", "l2_value_length_differences", "l2_completeness", "l2_adate_percentiles", "enr_l2_overlap"} <= set(done.written)
    assert "MIL_9" in {r.flagid for r in spark.read.parquet(done.written["sign_off"]).collect()}
    assert {"dis_pat_rxcount", "mil_linkage_rates", "l3_mil_aggregate_deliv", "all_l1_l2_flags"} <= set(done.written)


def test_port_checks_give_flag_rows(spark):
    d = Data(spark, "/root/testdata/sf0.001")
    for name, df in port_checks(spark, d.many("mil", "enr")).items():
        assert set(sinks.FLAG_COLUMNS) <= set(df.columns), name
        assert df.count() > 0, name
