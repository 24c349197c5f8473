"""Mixing sources to target weights: whole copies plus one drawn copy per document. DataFrame functions only."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from carelens.llm.common import Work, whole_row

#: Weights that the sources take in turn, by code point.
WEIGHTS = (5, 2, 1)
#: No source is repeated more often than this.
MOST = 3
#: Candidate draws; each source takes the one whose words come nearest to its target.
DRAWS = 8
WORD = r"[^\x20\x09-\x0D]+"


def word_count(text: Column) -> Column:
    """Words between the six ASCII white-space characters; null has none."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def draws(key: Column) -> Column:
    """DRAWS numbers in [0, 2**32) from the digests of the key."""
    text = F.coalesce(key.cast("string"), F.lit("null"))
    return F.array(*[
        F.conv(F.substring(F.md5(F.concat(F.lit(f"{k // 4}:"), text)), 1 + 8 * (k % 4), 8), 16, 10).cast("long")
        for k in range(DRAWS)
    ])


def targets(sizes: DataFrame, weights: Sequence[int] = WEIGHTS, most: int = MOST) -> DataFrame:
    """Per source: size and target. One row per source, and one task whose ordered windows see all of these: a source names a
    collection, not a host or a page.

    All sizes are shared by weight. Sources in order of size per weight fill up first; a source is full where its
    share of what the fuller ones leave reaches `most` times its size.
    """
    per = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    turn = (F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1) % len(weights)
    per = per.withColumn("w", F.element_at(F.array(*[F.lit(int(w)) for w in weights]), turn.cast("int") + 1).cast("long"))
    per = per.withColumn("full", F.col("source_size") * most)
    order = Window.orderBy((F.col("full") / F.col("w")).asc(), F.col("source").asc_nulls_last())
    before, every = order.rowsBetween(Window.unboundedPreceding, -1), Window.partitionBy()
    left = F.sum("source_size").over(every) - F.coalesce(F.sum("full").over(before), F.lit(0))
    share = F.sum("w").over(every) - F.coalesce(F.sum("w").over(before), F.lit(0))
    per = per.withColumn("level", left.cast("double") / share.cast("double"))
    free = F.col("full").cast("double") > F.col("level") * F.col("w")
    level = F.max(F.when(free, F.col("level"))).over(every)
    target = F.when(free, level * F.col("w")).otherwise(F.col("full").cast("double"))
    return per.select("source", "source_size", target.alias("target"))


def _copies(k: int) -> Column:
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    whole = F.floor(rate)
    return (whole + (F.col("draw")[k] < (rate - whole) * F.lit(4294967296.0)).cast("long")).cast("long")


def rates(work: Work, sizes: DataFrame, weights: Sequence[int], most: int) -> DataFrame:
    """Per source: source_size, target and k, the draw whose words come nearest to the target; first of equals."""
    per = work.keep(targets(sizes, weights, most), "targets")
    drawn = sizes.withColumn("draw", draws(F.col("doc_id"))).alias("s").join(
        per.alias("t"), F.col("s.source").eqNullSafe(F.col("t.source"))
    ).select("s.source", "s.size", "s.draw", "t.source_size", "t.target")
    sums = drawn.groupBy("source", "source_size", "target").agg(
        *[F.sum(_copies(k) * F.col("size")).alias(f"sum{k}") for k in range(DRAWS)]
    )
    off = [F.struct(F.abs(F.col(f"sum{k}") - F.col("target")).alias("off"), F.lit(k).alias("k")) for k in range(DRAWS)]
    return work.keep(sums.select("source", "source_size", "target", F.array_min(F.array(*off))["k"].alias("k")), "rates")


def _with_copies(rows: DataFrame, rated: DataFrame) -> DataFrame:
    """rows (source, doc_id, ...) with source_size, target and copies; a row per source is all that is joined."""
    joined = rows.withColumn("draw", draws(F.col("doc_id"))).alias("s").join(
        rated.alias("t"), F.col("s.source").eqNullSafe(F.col("t.source"))
    ).select("s.*", "t.source_size", "t.target", "t.k")
    copies = F.element_at(F.array(*[_copies(k) for k in range(DRAWS)]), F.col("k") + 1)
    return joined.withColumn("copies", copies)


def plan(work: Work, docs: DataFrame, weights: Sequence[int] = WEIGHTS, most: int = MOST) -> DataFrame:
    """Per row of docs (doc_id, text, source): doc_id, source, size, source_size, target, copies, taken.

    copies is floor(rate) plus one drawn copy with the fraction as its probability, rate being target by source size.
    The draw depends on doc_id alone, so reruns agree; rows that share a doc_id share it. Of DRAWS independent draws
    each source takes the one whose words come nearest to its target, the first of equals.

    Null source: a source of its own, last. Null doc_id: drawn as the text "null". Null or empty text: size 0, so
    taken 0. No rows: no rows. A source without words: target 0, copies 0. The text is read once.
    """
    sizes = work.keep(docs.select("doc_id", "source", word_count(F.col("text")).alias("size")), "sizes")
    out = _with_copies(sizes, rates(work, sizes, weights, most))
    return out.select(
        "doc_id", "source", "size", "source_size", "target", "copies", (F.col("copies") * F.col("size")).alias("taken")
    )


def mix(work: Work, docs: DataFrame, weights: Sequence[int] = WEIGHTS, most: int = MOST) -> DataFrame:
    """The mixed rows themselves: every row of docs as often as `plan` says, all its columns kept as they are."""
    sizes = work.keep(docs.select("doc_id", "source", word_count(F.col("text")).alias("size")), "sizes")
    rated = rates(work, sizes, weights, most)
    rows = docs.select("doc_id", "source", whole_row(docs).alias("doc"))
    out = _with_copies(rows, rated).where("copies > 0")
    return out.select(F.explode(F.array_repeat("doc", F.col("copies").cast("int"))).alias("doc")).select("doc.*")
