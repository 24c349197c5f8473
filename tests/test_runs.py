"""Results are published as a whole: whatever fails, the tables published before stay as they were."""

import hashlib

import pytest
from pyspark.sql import functions as F

from carelens.plans import checks, level3, review
from carelens.registry import Data
from carelens.sources import runs, sinks

SF = "/root/testdata/sf0.001"


def prints(folder):
    """Every file below a folder with a hash of its bytes."""
    return {str(p.relative_to(folder)): hashlib.md5(p.read_bytes()).hexdigest() for p in folder.rglob("*") if p.is_file()}


def consistent(spark, more="true"):
    """A linkage table that passes levels 1 and 2, and its patients' spans."""
    d = Data(spark, SF)
    mil = d.sql(
        f"""SELECT 'M' || CAST(c_custkey AS STRING) mpatid, 'C' || CAST(c_custkey AS STRING) cpatid, DATE '2000-03-01' adate, DATE '2000-03-02' ddate,
           'E' || CAST(c_custkey AS STRING) encounterid, 'IP' enctype, CAST(1 + c_custkey % 2 AS INT) birth_type, 30 age, 'O' sex, DATE '2000-03-01' cbirth_date,
           DATE '1970-01-01' mbirth_date, 'RE' matchmethod, DATE '2000-03-05' cenr_start FROM customer WHERE c_custkey % 8 <> 0 AND c_custkey % 4 IN (2, 3) AND {more}"""
    )
    enr = mil.selectExpr("mpatid patid", "adate - 100 enr_start", "adate + 100 enr_end", "'Y' medcov", "'Y' drugcov", "'N' chart")
    few = {n: d(n) for n in ("dem", "enc", "dth")}
    return few | {"mil": mil, "enr": enr, "del": mil.select("mpatid", "encounterid"), "inf": mil.select("cpatid")}


def test_a_review_that_fails_in_level_3_leaves_the_published_tables(spark, tmp_path, monkeypatch):
    out, tables = str(tmp_path), consistent(spark)
    first = review.review(spark, tables, out, "site")
    assert (first.status, first.level) == ("completed", 3)
    found = runs.published(spark, out)
    assert found == first.written
    before = prints(tmp_path / "runs")

    def broken(*_):
        raise RuntimeError("no third level")

    monkeypatch.setattr(level3, "results", broken)
    with pytest.raises(RuntimeError, match="no third level"):
        review.review(spark, consistent(spark, "c_custkey > 50"), out, "site")
    assert runs.published(spark, out) == found
    after = prints(tmp_path / "runs")
    assert {k: after[k] for k in before} == before and len(after) > len(before)
    failed = runs.manifest(spark, out).where("status = 'failed'").collect()
    assert [(r["error"], r["name"], r["number"]) for r in failed] == [("RuntimeError: no third level", None, 2)]

    # mended, and compared with the flags published before, which the run itself does not disturb
    monkeypatch.undo()
    previous = runs.read_published(spark, out, "all_l1_l2_flags").drop("dp", "whole")
    third = review.review(spark, tables, out, "site", previous=previous)
    assert runs.published(spark, out) == third.written and "sign_off" in third.written
    assert not set(third.written.values()) & set(found.values())
    assert prune_and_list(spark, out, tmp_path, 1) == {path.split("/runs/")[1].split("/")[0] for path in third.written.values()}


def prune_and_list(spark, out, tmp_path, keep):
    runs.prune(spark, out, keep)
    return {p.name for p in (tmp_path / "runs").iterdir()}


def test_an_aborted_review_is_published_without_older_tables(spark, tmp_path):
    out, tables = str(tmp_path), consistent(spark)
    review.review(spark, tables, out, "site")
    done = review.review(spark, {**tables, "mil": tables["mil"].limit(0)}, out, "site")
    assert done.status == "aborted" and set(runs.published(spark, out)) == {"all_l1_nobs", "table_flags"}
    last = runs.manifest(spark, out).where("number = 2").select("status", "stopped_at", "name", "rows").collect()
    assert {(r["status"], r["stopped_at"]) for r in last} == {("aborted", "level 1")}
    assert {r["name"]: r["rows"] for r in last} == {n: spark.read.parquet(p).count() for n, p in done.written.items()}


def test_a_check_that_fails_keeps_flags_and_counts_back(spark, tmp_path, monkeypatch):
    out, tables = str(tmp_path), Data(spark, SF).many("mil", "enr")
    done = checks.run_checks(spark, tables, out, enabled=["397"])
    assert runs.published(spark, out) == {"flags": done.flags, "flag_counts": done.counts}
    monkeypatch.setattr(checks.fl, "count_rows", lambda df: df.select(F.raise_error(F.lit("lost")).alias("n")))
    with pytest.raises(Exception, match="lost"):
        checks.run_checks(spark, tables, out, enabled=["396"])
    assert runs.published(spark, out) == {"flags": done.flags, "flag_counts": done.counts}
    assert {r.flagid[-3:] for r in runs.read_published(spark, out, "flags").collect()} == {"397"}


def test_a_refused_table_keeps_the_others_back(spark, tmp_path):
    out, n = str(tmp_path), spark.createDataFrame([(1,)], "n int")
    with runs.Run(spark, out) as run:
        run.write_aggregate(n, "counts")
        run.write_rows(spark.createDataFrame([("M1",)], "mpatid string"), "masters")
        run.write_work(n, "scratch")
    assert set(runs.published(spark, out)) == {"counts", "masters"}
    assert set(runs.published(spark, out, sinks.AGGREGATE_ZONE)) == {"counts"}
    with pytest.raises(ValueError, match="mpatid"), runs.Run(spark, out) as run:
        run.write_aggregate(n.union(n), "counts")
        run.write_aggregate(spark.createDataFrame([("M1",)], "mpatid string"), "others")
    assert runs.read_published(spark, out, "counts").count() == 1


def test_a_run_that_dies_is_as_if_it_never_was(spark, tmp_path):
    out, n = str(tmp_path), spark.createDataFrame([(1,)], "n int")
    dead = runs.Run(spark, out)
    dead.write_aggregate(n, "counts")
    assert runs.published(spark, out) == {} and runs.manifest(spark, out).count() == 0
    with pytest.raises(KeyError, match="counts"):
        runs.read_published(spark, out, "counts")
    assert runs.prune(spark, out) == []
    with runs.Run(spark, out):
        pass
    assert runs.published(spark, out) == {} and runs.manifest(spark, out).count() == 1


def test_runs_side_by_side_do_not_mix(spark, tmp_path):
    out = str(tmp_path)
    one, two = runs.Run(spark, out), runs.Run(spark, out)
    for run, value in ((one, 1), (two, 2)):
        run.write_aggregate(spark.createDataFrame([(value,)], "n int"), "a")
    two.write_aggregate(spark.createDataFrame([(2,)], "n int"), "b")
    two.publish()
    one.publish()
    assert set(runs.published(spark, out)) == {"a"} and runs.read_published(spark, out, "a").first()["n"] == 1
    with pytest.raises(ValueError, match="ended"):
        one.write_aggregate(spark.createDataFrame([(1,)], "n int"), "c")


def test_a_table_is_written_once(spark, tmp_path):
    run = runs.Run(spark, str(tmp_path))
    run.write_rows(spark.range(1), "a")
    with pytest.raises(ValueError, match="already"):
        run.write_aggregate(spark.range(1), "a")
    with pytest.raises(ValueError, match="stay"):
        runs.prune(spark, str(tmp_path), 0)
