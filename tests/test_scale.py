"""One key holds a third of all rows, or all of them: results stay right and no task gets it whole."""

import contextlib

import pytest
from pyspark.sql import functions as F

from carelens.operators import cross, flags, keys, linkage, spans, summary
from carelens.registry.views import Data


@contextlib.contextmanager
def settings(spark, **values):
    before = {k: spark.conf.get(k, None) for k in values}
    for k, v in values.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


SMALL = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20KB",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20KB",
    "spark.sql.shuffle.partitions": "16",
}


def hot(spark, n=120_000):
    """A third of the rows share one key, another small part has none."""
    key = F.when(F.col("id") % 3 == 0, "hot").when(F.col("id") % 50 != 1, F.concat(F.lit("k"), F.floor(F.col("id") / 2)))
    return spark.range(0, n, 1, 12).select(key.alias("k"), F.col("id"), F.sha2(F.col("id").cast("string"), 256).alias("pad"))


def run(df):
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString()


def final_plan(df):
    text = run(df)
    return text[: text.index("== Initial Plan ==")] if "== Initial Plan ==" in text else text


@pytest.mark.parametrize("what", ["duplicates", "anti"])
def test_hot_key_is_split_in_row_joins(spark, what):
    df = hot(spark)
    with settings(spark, **SMALL):
        if what == "duplicates":
            out = keys.duplicate_rows(df, ["k"])
        else:
            ids = df.select("k").where("k <> 'hot'").distinct()
            out = cross.rows_not_in_reference(df, ids, "k", "k")
        plan = final_plan(out)
        assert "skew=true" in plan, plan
        assert out.where("k = 'hot'").count() == 40_000


def test_duplicate_rows_never_use_a_window(spark):
    df = hot(spark, 1000)
    for out in (keys.duplicate_rows(df, ["k"]), keys.surplus_duplicates(df, ["k"], "x")):
        assert "Window" not in out._jdf.queryExecution().executedPlan().toString()


def one_patient(spark, n):
    """All rows belong to one patient, whose dates fall on 500 days."""
    start = F.date_add(F.lit("2020-01-01"), (F.col("id") * 7919 % 500).cast("int"))
    return spark.range(0, n, 1, 8).select(
        F.concat(F.lit("hot"), F.floor(F.col("id") / n)).alias("patid"), start.alias("enr_start"),
        F.date_add(start, (F.col("id") % 40).cast("int")).alias("enr_end"), F.lit("Y").alias("medcov"),
        F.lit("Y").alias("drugcov"), F.lit("Y").alias("chart"),
    )


def test_one_patient_with_many_spans_and_dates(spark):
    enr = one_patient(spark, 60_000)
    dates = enr.select("patid", F.col("enr_start").alias("d"))
    # 60,000 x 60,000 pairs are counted, not formed
    days = spans.day_coverage(dates, enr, ["patid"], "d").agg(F.count("*"), F.sum("n"), F.max("all_spans")).collect()[0]
    assert tuple(days) == (500, 60_000, 60_000)
    pairs = cross.date_order_pairs(dates, dates, "d", "d", later=True).collect()[0].n_pairs
    assert pairs == 60_000 * 60_000 * 499 // 500 // 2
    assert spans.bridge(enr, ["patid"]).count() == 1
    assert spans.merge_periods(enr, ["patid"], "enr_start", "enr_end").count() == 1
    assert spans.overlaps(enr).count() > 0


def test_ordered_work_on_spans_is_split_by_month(spark):
    """The first window of bridging and merging runs per patient and month."""
    enr = one_patient(spark, 1000)
    for out in (spans.bridge(enr, ["patid"]), spans.merge_periods(enr, ["patid"], "enr_start", "enr_end")):
        plan = out._jdf.queryExecution().executedPlan().toString()
        assert "hashpartitioning(patid" in plan and "month" in plan


def test_hot_mother_in_linkage(spark):
    mil = spark.range(0, 30_000, 1, 8).select(
        F.lit("hot").alias("mpatid"), F.concat(F.lit("C"), F.col("id")).alias("cpatid"), F.lit("E").alias("encounterid"),
        F.lit("2020-01-01").cast("date").alias("adate"), F.lit(2).alias("birth_type"), F.lit(30).alias("age"), F.lit("IP").alias("enctype"),
    )
    assert linkage.birth_type_linkage(mil).collect()[0].crows == 30_000
    assert linkage.delivery_columns(mil).collect()[0].infantslinked == 30_000
    assert [r.linkagerate for r in linkage.linkage_rates(linkage.deliveries(mil)).collect()] == [1.0] * 5


def test_linkage_messages_hold_a_fixed_share_of_rows_in_a_task(spark):
    """Rows that pack well are not put together again, from the lines' join to the counts of messages."""
    who = F.col("id") % 5000
    mil = spark.range(0, 20_000, 1, 8).select(
        F.concat(F.lit("M"), who).alias("mpatid"), F.concat(F.lit("C"), F.col("id") % 10_000).alias("cpatid"), F.concat(F.lit("E"), who).alias("encounterid"),
        F.date_add(F.lit("2020-01-01"), (who % 9).cast("int")).alias("adate"), (3 + who % 3).cast("int").alias("birth_type"),
    )
    found = linkage.birth_type_linkage(mil)
    assert found.rdd.getNumPartitions() == spans.PARTS
    assert found.agg(F.count("*"), F.min("crows"), F.max("crows")).first()[:] == (5000, 2, 2)
    counted = flags.count_messages(found.withColumn("message", F.lit("one")).unionByName(found))
    assert counted.rdd.getNumPartitions() == spans.PARTS
    assert counted.agg(F.count("*"), F.sum("count")).first()[:] == (5003, 10_000)
    with settings(spark, **{"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1"}):
        assert Data(spark, "/root/testdata/sf0.001")("mil").rdd.getNumPartitions() == spans.PARTS


def test_filters_and_columns_reach_the_scan(spark, tmp_path):
    path = str(tmp_path / "dis")
    one_patient(spark, 100).select("patid", F.col("enr_start").alias("rxdate"), F.lit("x").alias("other")).write.parquet(path)
    plan = summary.count_by(spark.read.parquet(path).where("rxdate > DATE '2020-05-01'"), "patid")
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThan(rxdate" in text and "other" not in text
