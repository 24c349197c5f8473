"""Line or paragraph dedup: the earliest occurrence of a unit of text stays, the others go."""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from carelens.llm.common import Work, flat, mix64, split_join, steps, whole_row
from carelens.llm.words import WHITE, hashes, spans

#: Units of fewer words are left alone: short lines recur in clean text (see the README for how many documents with a good
#: label would lose some).
MIN_WORDS = 10
#: Line breaks between words that part units: one for lines, two for paragraphs.
LINE, PARAGRAPH = 1, 2
_SPACE = re.compile(rb"[ \t\n\x0b\x0c\r]*")
_BASE = 0x9E3779B97F4A7C15 | 5
_INVERSE = pow(_BASE, -1, 1 << 64)


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    out[:1] = 1
    return np.multiply.accumulate(out)


def units(data: np.ndarray, offsets: np.ndarray, breaks: int, min_words: int) -> tuple[np.ndarray, ...]:
    """Units of texts: text, start and end byte, words, two hashes. White space around a unit is none of it; inside,
    any run of it is as good as one space, and A-Z as good as a-z."""
    start, end, first = spans(data, offsets, WHITE)
    lines = np.concatenate([[0], np.cumsum(data == 10)])
    text = np.repeat(np.arange(len(offsets) - 1), np.diff(first))
    new = np.ones(len(start), bool)
    new[1:] = (lines[start[1:]] - lines[end[:-1]] >= breaks) | (text[1:] != text[:-1])
    head = np.flatnonzero(new)
    tail = np.append(head[1:], len(start))
    n = tail - head
    long = n >= min_words
    head, tail, n = head[long], tail[long], n[long]
    up, down = _powers(_BASE, len(start)), _powers(_INVERSE, len(start))
    found = []
    for seed in (21, 22):
        sums = np.concatenate([[np.uint64(0)], np.cumsum(hashes(data, start, end, seed) * up)])
        found.append(mix64((sums[tail] - sums[head]) * down[head] + n.astype(np.uint64)).view(np.int64) if len(head) else np.zeros(0, np.int64))
    owner = text[head]
    return owner, start[head] - offsets[owner], end[tail - 1] - offsets[owner], n, *found


def occurrences(rows: DataFrame, breaks: int = LINE, min_words: int = MIN_WORDS) -> DataFrame:
    """Units of rows (r, doc_id, tie, text): r, doc_id, tie, start, end, n_words, digest (a, b)."""
    kind = rows.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, at = flat(batch.column(3))
            for i, j in steps(at):
                owner, *rest = units(data[at[i] : at[j]], at[i : j + 1] - at[i], breaks, min_words)
                back = pa.array(owner + i)
                yield pa.RecordBatch.from_arrays(
                    [*(batch.column(k).take(back) for k in range(3)), *map(pa.array, rest)], names=["r", "doc_id", "tie", "start", "end", "n_words", "a", "b"]
                )

    shape = f"r long, doc_id {kind}, tie long, start long, end long, n_words long, a long, b long"
    return rows.select("r", "doc_id", "tie", "text").mapInArrow(run, shape)


def repeats(work: Work, rows: DataFrame, breaks: int = LINE, min_words: int = MIN_WORDS) -> DataFrame:
    """Units of rows (r, doc_id, tie, text) that stand earlier, too: r, doc_id, start, end, n_words, kept_doc_id, kept_start.

    Occurrences rank by doc_id, null last, then by tie, r and place. Digests of 128 bits are grouped; the first rank of a
    group comes out of the aggregate, so a unit that very many texts have is no more than one row per task there, and
    one key of a join that may split it.
    """
    found = work.keep(occurrences(rows, breaks, min_words), "units")
    rank = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "tie", "r", "start")
    first = found.groupBy("a", "b").agg(F.min(rank).alias("first"), F.count("*").alias("n")).where("n > 1").select("a", "b", "first")
    later = split_join(found, first, ["a", "b"]).where((F.col("r") != F.col("first.r")) | (F.col("start") != F.col("first.start")))
    return later.select("r", "doc_id", "start", "end", "n_words", F.col("first.doc_id").alias("kept_doc_id"), F.col("first.start").alias("kept_start"))


def _cut(text: Column, gone: Column) -> Column:
    """The text without the units that go, each with the white space after it, and the original places of what stays."""

    @F.arrow_udf("kept string, places array<struct<start:long,end:long>>")
    def run(texts: pa.Array, lists: pa.Array) -> pa.Array:
        kept, places = [], []
        for body, found in zip(texts.cast(pa.large_binary()).to_pylist(), lists.to_pylist(), strict=True):
            at, stay = 0, []
            for s in sorted(found or [], key=lambda s: s["start"]):
                if s["start"] > at:
                    stay.append({"start": at, "end": s["start"]})
                at = _SPACE.match(body, s["end"]).end()
            if at < len(body):
                stay.append({"start": at, "end": len(body)})
            kept.append(b"".join(body[s["start"] : s["end"]] for s in stay).decode("utf-8", "replace"))
            places.append(stay)
        shape = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
        return pa.StructArray.from_arrays([pa.array(kept, pa.string()), pa.array(places, shape)], names=["kept", "places"])

    return run(text, gone)


def unit_dedup(work: Work, docs: DataFrame, breaks: int = LINE, min_words: int = MIN_WORDS) -> DataFrame:
    """docs, each row as struct doc, with kept, the text without units that stand earlier, places, the bytes of the
    original text that kept is made of, and gone, the removed units with where their earliest occurrence stands.

    Null or empty text: nothing goes. Rows that repeat a doc_id rank by a hash of their columns; if that is equal, too,
    the rows are, and any may be the first. Null doc_id: ranks last. No rows: no rows.
    """
    rows = work.keep(docs.select(F.monotonically_increasing_id().alias("r"), whole_row(docs).alias("doc")), "rows")
    told = rows.select("r", "doc.doc_id", F.xxhash64("doc").alias("tie"), F.coalesce("doc.text", F.lit("")).alias("text"))
    found = work.keep(repeats(work, told, breaks, min_words), "repeats")
    gone = found.groupBy("r").agg(F.collect_list(F.struct("start", "end", "n_words", "kept_doc_id", "kept_start")).alias("gone"))
    out = rows.join(gone, "r", "left").withColumn("out", _cut(F.coalesce("doc.text", F.lit("")), F.col("gone")))
    return out.select("doc", "out.kept", "out.places", "gone")
