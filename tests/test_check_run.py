import pytest
from pyspark.sql import functions as F

from carelens.plans import checks
from carelens.registry import Data

SF = "/root/testdata/sf0.001"
FATAL = ["200", "217", "218", "219"]


@pytest.fixture(scope="module")
def data(spark):
    return Data(spark, SF).many("mil", "enr")


def ids(spark, path):
    return {r.flagid[-3:] for r in spark.read.parquet(path).select("flagid").distinct().collect()}


def test_fatal_check_ends_the_run(spark, data, tmp_path):
    done = checks.run_checks(spark, data, str(tmp_path))
    assert (done.status, done.stopped_at) == ("aborted", "200")
    assert ids(spark, done.flags) == {"120", "126", "200"}


def test_later_checks_of_the_level_give_nothing(spark, data, tmp_path):
    done = checks.run_checks(spark, data, str(tmp_path), disabled=["200", "217"])
    assert done.stopped_at == "218"
    assert ids(spark, done.flags) == {"120", "126", "201", "204", "211", "218"}


def test_without_fatal_checks_all_levels_run(spark, data, tmp_path):
    done = checks.run_checks(spark, data, str(tmp_path), disabled=FATAL)
    found = ids(spark, done.flags)
    assert done.status == "completed" and {"221", "371", "394", "396", "397"} <= found and not found & set(FATAL)
    counts = {r.flagid: r["count"] for r in spark.read.parquet(done.counts).collect()}
    assert counts["MIL_3_00_00-0_397"] == data["mil"].where("cpatid is not null and mpatid is null").count()


def test_enabled_wins(spark, data, tmp_path):
    done = checks.run_checks(spark, data, str(tmp_path), enabled=["397"], disabled=["397"])
    assert ids(spark, done.flags) == {"397"}


def test_structure_flags_and_empty_table(spark, data):
    mil = data["mil"].limit(0).drop("encounterid").withColumn("birth_type", F.lit("x"))
    found = {r.flagid for r in checks.level1(spark, mil).collect()}
    assert found == {"MIL_1_00_00-0_101", "MIL_1_04_00-0_110", "MIL_1_05_00-0_112"}


def test_unpopulated_column(spark, data):
    mil = data["mil"].where("mpatid is null")
    got = {r.flagid: r.flag_descr for r in checks.level1(spark, mil).where("flagid like '%_111'").collect()}
    assert got == {"MIL_1_01_00-0_111": "Variable 'MPatID' is not populated"}
