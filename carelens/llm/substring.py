"""Removal of long repeated substrings by a distributed merge sort of suffixes that knows their common prefixes.

Only suffixes that can matter are sorted. A window of `length` bytes names an anchor: of the stretches of ANCHOR bytes
in it the one that hashes least. Equal windows name equal anchors at equal distance, so windows fall into units, runs
of neighbouring windows with one anchor; a text has about two units per `length` bytes. A unit whose anchor occurs
once holds nothing repeated. Of the others, all windows at once are taken for repeated where their joint stretch
hashes like another unit's; else the unit is cut into cells of 64, 8 and 1 windows, and cells whose common core is met
once are let go. What hashes alike is a claim, no more: the claimed strings, suffixes cut at the end of their last
window, are sorted in runs, exchanged front-coded by ranges, and merged by loser trees. A claim holds if the string
shares all its bytes with a neighbour in the merged order. So hashes only leave out strings that differ from all
others, and equality is decided on bytes.
"""

from __future__ import annotations

from bisect import bisect_right
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from carelens.llm import suffixes
from carelens.llm.common import Work, flat, mix64, split_join, steps, whole_groups, whole_row
from carelens.llm.order import numbered
from carelens.llm.words import byte_hashes

#: Bytes of a string that may stand only once; bytes of an anchor; windows of the cells that units are cut into.
LENGTH, ANCHOR, CELLS = 400, 32, (64, 8, 1)
#: Bytes of strings in a sorted run and, about, in a range of the merged order; strings that draw each range's bound.
RUN_BYTES, RANGE_BYTES, BOUND_ROWS = 32 << 20, 32 << 20, 16
_EVERY = 64
_SEED = 77
_SEGMENT = 1 << 22
_A, _B, _C = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F), np.uint64(0x165667B19E3779F9)


def _least(v: np.ndarray, width: int) -> np.ndarray:
    """The least of every `width` neighbours, from running minima within blocks from both ends."""
    n = len(v) - width + 1
    padded = np.full(-(-len(v) // width) * width, np.iinfo(v.dtype).max, v.dtype)
    padded[: len(v)] = v
    blocks = padded.reshape(-1, width)
    head = np.minimum.accumulate(blocks, axis=1).ravel()
    tail = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(tail[:n], head[width - 1 : width - 1 + n])


def units(data: np.ndarray, offsets: np.ndarray, length: int, anchor: int) -> tuple[np.ndarray, ...]:
    """Runs of windows that name one anchor: text, place p of the anchor, its least and greatest distance from the
    windows' starts, its hash. Texts of under 2**24 bytes in all."""
    n = len(data)
    if n < length:
        return tuple(np.zeros(0, np.int64) for _ in range(5))
    roll = byte_hashes(_SEED)
    at = np.arange(n - anchor + 1)
    gram = mix64(roll.of(roll.sums(data), at, at + anchor))
    place = np.uint64((1 << 24) - 1)
    named = (_least(gram & ~place | at.astype(np.uint64), length - anchor + 1) & place).astype(np.int64)
    text = np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))
    window = np.flatnonzero(at[: len(named)] + length <= offsets[1:][text[: len(named)]])
    named = named[window]
    if not len(window):
        return tuple(np.zeros(0, np.int64) for _ in range(5))
    new = np.flatnonzero(np.concatenate([[True], named[1:] != named[:-1]]))
    last = np.append(new[1:], len(named)) - 1
    p = named[new]
    owner = text[p]
    return owner, p - offsets[owner], p - window[last], p - window[new], gram[p].view(np.int64)


def _all_units(data: np.ndarray, offsets: np.ndarray, length: int, anchor: int) -> Iterator[tuple[int, tuple[np.ndarray, ...]]]:
    """`units` of chunks of texts, with the number of the chunk's first text; very long texts in overlapping segments."""
    for i, j in steps(offsets):
        size = int(offsets[j] - offsets[i])
        for start in range(0, max(1, size - length + 1), _SEGMENT) if size > _SEGMENT else (0,):
            if size <= _SEGMENT:
                yield i, units(data[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i], length, anchor)
                continue
            part = data[offsets[i] + start : min(offsets[j], offsets[i] + start + _SEGMENT + length - 1)]
            owner, p, lo, hi, gram = units(part, np.array([0, len(part)]), length, anchor)
            yield i, (owner, p + start, lo, hi, gram)


def _text_key() -> list[Column]:
    return [F.xxhash64("text").alias("k1"), F.xxhash64(F.lit(3), "text").alias("k2")]


def _with_contexts(texts: DataFrame, length: int) -> DataFrame:
    """Per unit of texts (k1, k2, w, text, units): the bytes of all its windows, and their hash with the unit's bounds."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        roll = byte_hashes(_SEED)
        for batch in batches:
            data, at = flat(batch.column("text"))
            listed = batch.column("units")
            bounds = np.concatenate([[0], np.cumsum(listed.value_lengths().to_numpy(zero_copy_only=False))])
            inner = listed.flatten()
            fields = [inner.field(x).to_numpy(zero_copy_only=False) for x in ("p", "lo", "hi", "h")]
            for i, j in steps(at):
                own = slice(bounds[i], bounds[j])
                p, lo, hi, h = (x[own] for x in fields)
                text = np.repeat(np.arange(i, j), np.diff(bounds[i : j + 1]))
                start, end = at[text] - at[i] + p - hi, at[text] - at[i] + p - lo + length
                part = data[at[i] : at[j]]
                joint = mix64(roll.of(roll.sums(part), start, end)) + lo.astype(np.uint64) * _A + hi.astype(np.uint64) * _B
                body = part.tobytes()
                back = pa.array(text)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(c).take(back) for c in ("k1", "k2", "w")] + [pa.array(x) for x in (p, lo, hi, h, mix64(joint).view(np.int64))]
                    + [pa.array([body[a:b] for a, b in zip(start.tolist(), end.tolist(), strict=True)], pa.binary())],
                    names=["k1", "k2", "w", "p", "lo", "hi", "h", "joint", "bytes"],
                )

    return texts.mapInArrow(run, "k1 long, k2 long, w long, p long, lo long, hi long, h long, joint long, bytes binary")


def _cells(live: DataFrame, size: int, length: int) -> DataFrame:
    """Units with the stretches still open in them (a, b, und), cut into cells of `size` windows on a common grid.

    Per cell: its bounds a and b, whether it is undecided, the hash of the core that all windows of the grid's cell
    have in common, and the hash of all its own windows' bytes with the bounds.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        roll = byte_hashes(_SEED)
        for batch in batches:
            data, at = flat(batch.column("bytes"))
            listed = batch.column("open")
            n_open = listed.value_lengths().to_numpy(zero_copy_only=False)
            inner = listed.flatten()
            top, bottom, und = (inner.field(x).to_numpy(zero_copy_only=False) for x in ("b", "a", "und"))
            bounds = np.concatenate([[0], np.cumsum(n_open)])
            hi = batch.column("hi").to_numpy(zero_copy_only=False)
            for i, j in steps(at):
                own = slice(bounds[i], bounds[j])
                unit = np.repeat(np.arange(i, j), n_open[i:j])
                low, high, open_und = bottom[own], top[own], und[own].astype(bool)
                many = high // size - low // size + 1
                row = np.repeat(np.arange(len(unit)), many)
                cell = (low // size)[row] + np.arange(len(row)) - np.repeat(np.cumsum(many) - many, many)
                a, b = np.maximum(cell * size, low[row]), np.minimum(cell * size + size - 1, high[row])
                origin = at[unit[row]] - at[i] + hi[unit[row]]
                sums = roll.sums(data[at[i] : at[j]])
                core = mix64(roll.of(sums, origin - cell * size, origin - cell * size - size + 1 + length)) + cell.astype(np.uint64) * _C
                joint = mix64(roll.of(sums, origin - b, origin - a + length)) + a.astype(np.uint64) * _A + b.astype(np.uint64) * _B
                back = pa.array(unit[row])
                yield pa.RecordBatch.from_arrays(
                    [batch.column(c).take(back) for c in ("k1", "k2", "w", "p", "lo")] + [pa.array(x) for x in (a, b, open_und[row], mix64(core).view(np.int64), mix64(joint).view(np.int64))],
                    names=["k1", "k2", "w", "p", "lo", "a", "b", "und", "h", "joint"],
                )

    return live.mapInArrow(run, "k1 long, k2 long, w long, p long, lo long, a long, b long, und boolean, h long, joint long")


_UNIT = ["k1", "k2", "p", "lo"]


def _shared_cores(cells: DataFrame) -> DataFrame:
    """Cells whose core is met twice or more, once at least in a cell that is undecided."""
    met = cells.groupBy("h").agg(F.sum("w").alias("n"), F.max("und").alias("open")).where("n > 1 AND open").select("h")
    return split_join(cells, met, ["h"])


def _judged(work: Work, cells: DataFrame) -> DataFrame:
    """Cells of four kinds. Claimed: undecided, and another one hashes alike. Witness: one decided before, that claimed
    ones hash like. Going on to the next level: undecided ones that are alone, and of cells that hash alike one, as a
    partner for parts of others."""
    place = F.struct(*_UNIT, "a")
    classes = cells.groupBy("joint").agg(
        F.sum("w").alias("n"), F.min(place).alias("first"), F.min(F.when(~F.col("und"), place)).alias("old"), F.max("und").alias("open")
    )
    judged = split_join(cells, classes.where("n > 1"), ["joint"], "left")
    alone = F.col("n").isNull()
    judged = judged.select(
        *_UNIT, "w", "h", "a", "b", (F.col("und") & ~alone).alias("claimed"), F.coalesce(F.col("open") & (place == F.col("old")), F.lit(False)).alias("witness"),
        (alone | (place == F.col("first"))).alias("on"), (F.col("und") & alone).alias("und"),
    )
    return work.keep(judged, "judged")


def _claimed(judged: DataFrame) -> DataFrame:
    return judged.where("claimed OR witness").select(*_UNIT, "a", "b", F.col("claimed").alias("own"))


def claims(work: Work, docs: DataFrame, length: int = LENGTH, anchor: int = ANCHOR) -> DataFrame:
    """Stretches of texts that seem to occur twice: text key (k1, k2), w rows that have the text, first window x0,
    last window x1, and the bytes that these windows cover. own is false for a string that is there only to be met by
    others: a stretch of one that was claimed as a whole."""
    rows = docs.select(F.coalesce("text", F.lit("")).alias("text")).select("text", *_text_key())

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i, (owner, *found) in _all_units(*flat(batch.column("text")), length, anchor):
                back = pa.array(owner + i)
                yield pa.RecordBatch.from_arrays(
                    [batch.column("k1").take(back), batch.column("k2").take(back), *map(pa.array, found)], names=["k1", "k2", "p", "lo", "hi", "h"]
                )

    found = work.keep(rows.mapInArrow(find, "k1 long, k2 long, p long, lo long, hi long, h long"), "units")
    twice = found.groupBy("h").agg(F.count("*").alias("n")).where("n > 1").select("h")
    per_text = split_join(found, twice, ["h"]).dropDuplicates(["k1", "k2", "p", "lo"]).groupBy("k1", "k2").agg(
        F.collect_list(F.struct("p", "lo", "hi", "h")).alias("units")
    )
    per_text = work.keep(per_text, "anchored")
    # Rows with one text are one from here on: w of them.
    texts = rows.groupBy("k1", "k2").agg(F.first("text").alias("text"), F.count("*").alias("w")).join(per_text, ["k1", "k2"])
    contexts = work.keep(_with_contexts(texts.select("k1", "k2", "w", "text", "units"), length), "contexts")
    work.drop(found, per_text)

    slim = contexts.select(*_UNIT, "w", "h", "joint", F.col("lo").alias("a"), F.col("hi").alias("b"), F.lit(True).alias("und"))
    judged = _judged(work, _shared_cores(slim))
    claimed = _claimed(judged)
    for size in (c for c in CELLS if 4 * c <= length):  # a core has most of the length
        going = judged.where("on")
        met = going.groupBy("h").agg(F.max("und").alias("open")).where("open").select("h")
        going = split_join(going, met, ["h"]).groupBy(*_UNIT).agg(F.collect_list(F.struct("a", "b", "und")).alias("open"))
        live = contexts.select(*_UNIT, "w", "hi", "bytes").join(work.keep(going, "open"), _UNIT)
        cells = work.keep(_cells(live.select(*_UNIT, "w", "hi", "bytes", "open"), size, length), "cells")
        judged = _judged(work, _shared_cores(cells))
        claimed = claimed.unionByName(_claimed(judged))
    listed = work.keep(claimed.groupBy(*_UNIT).agg(F.collect_list(F.struct("a", "b", "own")).alias("open")), "claimed")
    cut = contexts.select(*_UNIT, "w", "hi", "bytes").join(listed, _UNIT).select("k1", "k2", "w", "p", "hi", "bytes", F.explode("open").alias("c"))
    return cut.select(
        "k1", "k2", "w", "c.own", (F.col("p") - F.col("c.b")).alias("x0"), (F.col("p") - F.col("c.a")).alias("x1"),
        F.substring("bytes", (F.col("hi") - F.col("c.b") + 1).cast("int"), (F.col("c.b") - F.col("c.a") + length).cast("int")).alias("bytes"),
    )


def sorted_runs(strings: DataFrame, run_bytes: int = RUN_BYTES) -> DataFrame:
    """Strings sorted in runs of about run_bytes. Two kinds of rows: per string (k1, k2, x0, x1, own) its run, its number
    among the run's distinct strings, and whether the run holds it twice; per run one block with its distinct strings,
    front-coded, their total size, and some of them for drawing ranges."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        name = TaskContext.get().partitionId() << 24
        held: list[tuple] = []
        size = 0

        def closed() -> Iterator[pa.RecordBatch]:
            held.sort(key=lambda e: e[0])
            number, distinct, weight = [], [], []
            for e in held:
                if not distinct or e[0] != distinct[-1]:
                    distinct.append(e[0])
                    weight.append(0)
                weight[-1] += e[1]
                number.append(len(distinct) - 1)
            block = suffixes.encode(list(zip(range(len(distinct)), suffixes.prefixes(distinct), distinct, strict=True)))
            n = len(held)
            nothing = pa.nulls(n, pa.binary())
            yield pa.RecordBatch.from_arrays(
                [pa.array([name] * n), pa.array(number, pa.int64()), pa.array([weight[k] > 1 for k in number]), *[pa.array([e[c] for e in held], pa.int64()) for c in (2, 3, 4, 5)],
                 pa.array([e[6] for e in held], pa.bool_()), nothing, pa.nulls(n, pa.int64()), pa.nulls(n, pa.list_(pa.binary()))], names=names,
            )
            heads = distinct[::_EVERY]
            nulls = [pa.nulls(1, kind) for kind in (pa.int64(), pa.bool_(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.bool_())]
            yield pa.RecordBatch.from_arrays(
                [pa.array([name]), *nulls, pa.array([block], pa.binary()), pa.array([sum(map(len, distinct))]), pa.array([heads], pa.list_(pa.binary()))], names=names
            )

        for batch in batches:
            columns = [batch.column(c).to_pylist() for c in ("bytes", "w", "k1", "k2", "x0", "x1", "own")]
            for e in zip(*columns, strict=True):
                held.append(e)
                size += len(e[0]) + 100
                if size >= run_bytes:
                    yield from closed()
                    held, size, name = [], 0, name + 1
        if held:
            yield from closed()

    names = ["run", "entry", "sure", "k1", "k2", "x0", "x1", "own", "block", "size", "heads"]
    return strings.mapInArrow(run, "run long, entry long, sure boolean, k1 long, k2 long, x0 long, x1 long, own boolean, block binary, size long, heads array<binary>")


def bounds_of(work: Work, blocks: DataFrame, ranges: int, per_range: int = BOUND_ROWS) -> list[bytes]:
    """Bounds that cut the strings of all runs into about `ranges` ranges of like size.

    They are drawn in proportion: about per_range strings a range, chosen by a hash, are sorted by ranges of their own and
    numbered, and every per_range-th is a bound, cut to the bytes that tell it from the one before. A bound is so the
    beginning of a string that is there. All that comes to the driver is these beginnings, a range each.
    """
    heads = blocks.select(F.explode("heads").alias("head")).distinct()
    heads = work.keep(heads, "heads")
    many = heads.count()
    if many > per_range * ranges:
        heads = heads.where(F.pmod(F.xxhash64("head"), F.lit(many)) < per_range * ranges)
    placed = work.keep(numbered(work, heads, [], ["head"], "ordered"), "placed")
    turn = F.floor(F.col("place") * ranges / F.col("n"))
    before = placed.select((F.col("place") + 1).alias("place"), F.col("head").alias("before"))
    drawn = placed.where(turn > F.floor((F.col("place") - 1) * ranges / F.col("n"))).where("place > 0").join(before, "place")

    @F.arrow_udf("binary")
    def beginning(heads: pa.Array, others: pa.Array) -> pa.Array:
        return pa.array([a[: suffixes.common_prefix(a, b, 0) + 1] for a, b in zip(heads.to_pylist(), others.to_pylist(), strict=True)], pa.binary())

    return sorted(bytes(r["b"]) for r in drawn.select(beginning("head", "before").alias("b")).collect())


def confirmed(work: Work, runs: DataFrame, range_bytes: int = RANGE_BYTES) -> DataFrame:
    """The strings (run, entry) that another one begins with or equals.

    Runs are cut at the ranges' bounds and sent there front-coded. Equal strings of a run are sent once, so a string that
    very many rows have comes once per run. A string is met by the one before or after it in the merged order. Where that
    one is in the next range, the bound between them begins with the string; and as the bound is the beginning of a string
    that is there, this is all that the last string of a range needs to know.
    """
    blocks = runs.where("block IS NOT NULL").select("run", "block", "size", "heads")
    total = blocks.agg(F.sum("size")).first()[0] or 0
    ranges = int(-(-total // range_bytes)) or 1
    bounds = bounds_of(work, blocks, ranges) if ranges > 1 else []

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name, block in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                parts: dict[int, list] = {}
                for number, shared, string in suffixes.decode(block):
                    to = bisect_right(bounds, string)
                    if to not in parts:
                        parts[to], shared = [], 0
                    parts[to].append((number, shared, string))
                for to, entries in parts.items():
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([to], pa.int32()), pa.array([name], pa.int64()), pa.array([suffixes.encode(entries)], pa.binary())], names=["to", "run", "block"]
                    )

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table, at in whole_groups(batches, ["to"], 1):
            for start, end in zip(at, at[1:], strict=False):
                names = table["run"].slice(start, end - start).to_pylist()
                streams = [suffixes.decode(b) for b in table["block"].slice(start, end - start).to_pylist()]
                found: list[tuple[int, int]] = []
                last, last_size, last_in, string = None, 0, True, b""
                for stream, number, shared, string in suffixes.merge(streams):
                    if last and not last_in and shared >= last_size:
                        found.append(last)
                    last, last_size = (names[stream], number), len(string)
                    last_in = shared >= last_size
                    if last_in:
                        found.append(last)
                to = table["to"][int(start)].as_py()
                if last and not last_in and to < len(bounds) and bounds[to].startswith(string):
                    found.append(last)
                yield pa.RecordBatch.from_arrays([pa.array([f[0] for f in found], pa.int64()), pa.array([f[1] for f in found], pa.int64())], names=["run", "entry"])

    sent = blocks.select("run", "block").mapInArrow(cut, "to int, run long, block binary").repartition("to").sortWithinPartitions("to")
    return sent.mapInArrow(merge, "run long, entry long")


def repeated(work: Work, docs: DataFrame, length: int = LENGTH, anchor: int = ANCHOR, run_bytes: int = RUN_BYTES, range_bytes: int = RANGE_BYTES) -> DataFrame:
    """Per distinct text with repeats (k1, k2): spans, the stretches [start, end) that other places repeat."""
    runs = work.keep(sorted_runs(claims(work, docs, length, anchor), run_bytes), "runs")
    merged = confirmed(work, runs, range_bytes).withColumn("yes", F.lit(True))
    held = runs.where("block IS NULL AND own").select("run", "entry", "sure", "k1", "k2", "x0", "x1").join(merged, ["run", "entry"], "left").where("sure OR yes")
    spans = held.groupBy("k1", "k2").agg(F.collect_list(F.struct(F.col("x0").alias("start"), (F.col("x1") + length).alias("end"))).alias("spans"))
    return work.keep(spans, "spans")


def _cut_out(text: Column, spans: Column) -> Column:
    """kept bytes, n_removed and n_spans, of a text and the stretches that go."""

    @F.arrow_udf("kept binary, n_removed long, n_spans long")
    def run(texts: pa.Array, lists: pa.Array) -> pa.Array:
        kept, removed, runs = [], [], []
        for body, found in zip(texts.cast(pa.large_binary()).to_pylist(), lists.to_pylist(), strict=True):
            parts, at, n = [], 0, 0
            for s in sorted(found or [], key=lambda s: s["start"]):
                if s["start"] > at or not n:
                    parts.append(body[at : s["start"]])
                    n += 1
                at = max(at, s["end"])
            parts.append(body[at:])
            kept.append(b"".join(parts))
            removed.append(len(body) - len(kept[-1]))
            runs.append(n)
        return pa.StructArray.from_arrays([pa.array(kept, pa.binary()), pa.array(removed, pa.int64()), pa.array(runs, pa.int64())], names=["kept", "n_removed", "n_spans"])

    return run(text, spans)


def substring_dedup(work: Work, docs: DataFrame, length: int = LENGTH, **sizes: int) -> DataFrame:
    """docs, each row as struct doc, without every byte of text that a string of `length` bytes covers which also
    starts at another place of the table, same text included: kept (bytes), spans, n_bytes, n_removed, n_spans.

    Strings are judged on the input. Null or empty text: nothing to remove. Rows with the same text repeat each other:
    from `length` bytes on all of it goes, in every row. Null or repeated doc_ids are of no account. No rows: no rows.
    """
    spans = repeated(work, docs, length, **sizes)
    rows = docs.select(whole_row(docs).alias("doc"), F.coalesce("text", F.lit("")).alias("text"))
    rows = rows.select("doc", "text", *_text_key()).join(spans, ["k1", "k2"], "left")
    out = rows.withColumn("out", _cut_out(F.col("text"), F.col("spans"))).select("doc", "out.kept", "spans", "out.n_removed", "out.n_spans")
    return out.withColumn("n_bytes", F.octet_length(F.coalesce("doc.text", F.lit(""))).cast("long"))
