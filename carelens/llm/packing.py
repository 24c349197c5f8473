"""Packing documents into sequences by minimum bin slack over the histogram of piece lengths."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from carelens.llm.common import Work, flat, steps
from carelens.llm.tokens import encoder

#: Tokens in a sequence.
SEQUENCE = 2048
_TEXT_BYTES = 1 << 18


def cut(sizes: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Pieces of documents of so many ids: owner, start and length. All but a document's first piece are full."""
    n = np.maximum(1, -(-sizes // most))
    owner = np.repeat(np.arange(len(sizes)), n)
    nth = np.arange(len(owner)) - np.repeat(np.cumsum(n) - n, n)
    head = sizes - (n - 1) * most
    start = np.where(nth == 0, 0, head[owner] + (nth - 1) * most)
    return owner, start, np.where(nth == 0, head[owner], most)


def pieces(docs: DataFrame, vocabulary: str, most: int = SEQUENCE) -> DataFrame:
    """Per piece of docs (doc_id, text): doc_id, piece, start, length, ids (little-endian 32 bits), part and place.

    part is the task that made it and place its number among that task's pieces of the same length.
    """
    kind = docs.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, part = encoder(vocabulary).encode, TaskContext.get().partitionId()
        seen = np.zeros(most + 1, np.int64)
        for batch in batches:
            data, at = flat(batch.column(1))
            for i, j in steps(at, _TEXT_BYTES):
                ids, bounds = encode(data[at[i] : at[j]], at[i : j + 1] - at[i])
                owner, start, length = cut(np.diff(bounds), most)
                order = np.argsort(length, kind="stable")
                run_start = np.concatenate([[True], np.diff(length[order]) > 0])
                nth = np.arange(len(order)) - np.maximum.accumulate(np.where(run_start, np.arange(len(order)), 0))
                place = np.empty(len(order), np.int64)
                place[order] = nth + seen[length[order]]
                seen += np.bincount(length, minlength=most + 1)
                ends = np.concatenate([[0], np.cumsum(length)]).astype(np.int32) * 4
                body = pa.Array.from_buffers(pa.binary(), len(length), [None, pa.py_buffer(ends.tobytes()), pa.py_buffer(ids.astype("<u4").tobytes())])
                first = np.concatenate([[0], np.cumsum(np.bincount(owner, minlength=j - i))[:-1]])
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(i, j - i).take(pa.array(owner)), pa.array((np.arange(len(owner)) - first[owner]).astype(np.int32)),
                     pa.array(start), pa.array(length), body, pa.array(np.full(len(owner), part, np.int32)), pa.array(place)],
                    names=["doc_id", "piece", "start", "length", "ids", "part", "place"],
                )

    shape = f"doc_id {kind}, piece int, start long, length long, ids binary, part int, place long"
    return docs.select("doc_id", "text").mapInArrow(run, shape)


def fullest(counts: dict[int, int], room: int) -> list[tuple[int, int]]:
    """Lengths, each with how often, out of counts whose sum comes nearest to room without passing it.

    Bit s of `reach` says that some selection sums to s. Longer lengths come first, so short ones are saved for later.
    """
    reach, full = 1, (1 << (room + 1)) - 1
    trail: list[tuple[int, int, int]] = []
    for length in sorted((x for x in counts if x <= room and counts[x]), reverse=True):
        left, take = min(counts[length], room // length), 1
        while left:
            take = min(take, left)
            more = (reach | reach << (length * take)) & full
            if more != reach:
                trail.append((reach, length, take))
                reach = more
            left -= take
            take *= 2
        if reach >> room & 1:
            break
    total, chosen = reach.bit_length() - 1, {}
    for before, length, take in reversed(trail):
        if not before >> total & 1:
            total -= length * take
            chosen[length] = chosen.get(length, 0) + take
    return sorted(chosen.items(), reverse=True)


def bins(histogram: dict[int, int], most: int = SEQUENCE) -> list[tuple[int, list[tuple[int, int]]]]:
    """How often which combination of lengths is packed: the longest length left, filled up as far as can be, as often
    as the lengths last. At most `most` lengths exist, whatever the number of documents."""
    counts = {k: v for k, v in histogram.items() if v}
    out = []
    while counts:
        longest = max(counts)
        counts[longest] -= 1
        parts = dict(fullest(counts, most - longest))
        counts[longest] += 1
        parts[longest] = parts.get(longest, 0) + 1
        times = min(counts[k] // n for k, n in parts.items())
        out.append((times, sorted(parts.items(), reverse=True)))
        for k, n in parts.items():
            counts[k] -= n * times
            if not counts[k]:
                del counts[k]
    return out


class Places:
    """Sequence and offset of the r-th piece of a length, under a list of bins."""

    def __init__(self, plan: list[tuple[int, list[tuple[int, int]]]]):
        rows, used, sequence = [], {}, 0
        for times, parts in plan:
            offset = 0
            for length, n in parts:
                start = used.get(length, 0)
                rows.append((length, start, times, sequence, offset))
                used[length] = start + n * times
                offset += n * length
            sequence += times
        rows.sort()
        table = np.array(rows, np.int64).reshape(-1, 5)
        self.length, self.start, self.times, self.sequence, self.offset = table.T
        self.key = self.length << 48 | self.start

    def __call__(self, length: np.ndarray, rank: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        i = np.searchsorted(self.key, length << 48 | rank, side="right") - 1
        copy = rank - self.start[i]
        return self.sequence[i] + copy % self.times[i], self.offset[i] + copy // self.times[i] * length


def pack(work: Work, docs: DataFrame, vocabulary: str, most: int = SEQUENCE) -> DataFrame:
    """Pieces of docs (doc_id, text) with sequence_id and offset, ids as little-endian 32-bit numbers.

    Lengths alone decide the packing, so the driver sees a histogram of at most `most` rows and makes the bins from
    it. Each piece finds its place by its rank among pieces of its length: tasks number their own pieces, and sums of
    the tasks' counts make these ranks global, so no length needs a task of its own.

    Null or empty text: one piece that holds id 0 alone. A text of more than `most` ids: several pieces, all but the
    first full. Repeated rows and null doc_ids are documents like others. No rows: no pieces.
    """
    made = work.keep(pieces(docs, vocabulary, most), "pieces")
    counts = work.keep(made.groupBy("length", "part").agg(F.count("*").alias("n")), "counts")
    histogram = {r["length"]: r["n"] for r in counts.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    before = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    base = counts.select("length", "part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    places = Places(bins(histogram, most))

    @F.pandas_udf("sequence_id long, offset long")
    def place(length: pd.Series, rank: pd.Series) -> pd.DataFrame:
        sequence, offset = places(length.to_numpy(), rank.to_numpy())
        return pd.DataFrame({"sequence_id": sequence, "offset": offset})

    ranked = made.withColumn("ids_crc32", F.crc32("ids")).join(base, ["length", "part"])
    return ranked.withColumn("at", place("length", F.col("place") + F.col("base"))).select(
        "doc_id", "piece", "start", "length", "ids_crc32", "ids", "at.sequence_id", "at.offset"
    )
