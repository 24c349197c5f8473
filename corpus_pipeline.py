"""From raw documents to packed token sequences: what a training run would read.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; all but the last return the columns of docs.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from carelens.llm import lines, minhash, mixing, packing, toxicity
from carelens.llm.common import Work, quoted, whole_row
from carelens.llm.tokens import vocabulary


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """docs without those whose score reaches the threshold of their language.

    Null or empty text: scored like any other, by the model's constant. Null lang: the threshold of all. Rows that are
    repeated, or tie in score, are treated alike. Without labels of both classes, or without rows, no row is rejected.
    """
    model = toxicity.fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    scored = docs.select(whole_row(docs).alias("doc"), model.score(F.col("text")).alias("score"))
    return scored.where(~model.toxic(F.col("score"), F.col("doc.lang"))).select("doc.*")


def drop_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """docs whose text lost the lines that many documents have; n_chars follows. No document goes.

    Null or empty text: one empty line, which stays, so the text comes out empty. Repeated rows count as documents of
    their own. A text whose lines all go is left empty. Long texts are split in the JVM. No rows: no rows.
    """
    found = lines.line_dedup(Work(spark, "lines"), docs)
    changed = {"text": F.col("kept"), "n_chars": F.char_length("kept").cast("long")}
    return found.select(*[changed.get(c, F.col(f"doc.{quoted(c)}")).alias(c) for c in docs.columns])


def drop_near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """docs with one document of each group linked from a similarity of 0.8: that of the smallest doc_id.

    Every row is a document of its own, also where rows share a doc_id. Null doc_id, null text or a text without words:
    linked with nothing, so the row stays. Of rows that tie, one by a hash of all columns. No rows: no rows.
    """
    return minhash.drop_near(Work(spark, "near"), docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """docs repeated or left out so that sources come near their target words.

    Null source: a source of its own, last. Null or empty text: size 0, so its copies weigh nothing. Rows that share a
    doc_id share their draw. Other columns are kept as they are. No rows: no rows.
    """
    return mixing.mix(Work(spark, "mix"), docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token pieces of docs and their places in sequences.

    Null or empty text: one piece, the closing id alone. Longer texts are cut into pieces of a sequence. Rows that
    repeat a doc_id are packed as often as they stand there, with equal piece numbers. No rows: no rows.
    """
    return packing.pack(Work(spark, "pack"), docs, vocabulary())


STAGES = [
    ("toxicity", drop_toxic),
    ("line_dedup", drop_lines),
    ("near_dedup", drop_near),
    ("mixing", mix_sources),
    ("packing", pack),
]

#: The classifier and the tokenizer cannot be said in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on the documents table, each written and read again before the next."""
    work = Work(spark, "pipeline")
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = work.keep(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
