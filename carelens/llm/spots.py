"""Fingerprints by spot signatures: chains of content words that follow common words, compared by pruned Jaccard."""

from __future__ import annotations

import base64
import hashlib
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from carelens.llm.common import CHUNK_BYTES, Work, mix64
from carelens.llm.words import NOT_ALNUM, hashes, spans

# The commonest function words of English, German, French and Spanish.
COMMON = (
    "the of and to a in is that for it as was with be by on not he his but at are this have from or had an they which you were all"
    " der die und das von zu den mit sich des auf für ist im dem nicht ein eine auch es werden aus dass sie nach wird bei"
    " de la le et les un du une que est pour qui dans par plus pas au sur se ce il sont avec aux ne son en"
    " el y los del las por con para no su al lo como pero sus o este sí porque entre".split()
)
#: Content words of a chain; content words without a common one before them after which a word may stand in for it, and
#: how many words do so.
CHAIN, DROUGHT, STAND_IN = 3, 16, 8
_SEED, _START, _TEXT = 31, np.uint64(0x51), np.uint64(0x7E)
_ODD = np.uint64(0x9E3779B97F4A7C15)


def _hashes_of(words: list[str]) -> np.ndarray:
    body = [w.encode() for w in words]
    ends = np.cumsum([len(w) for w in body])
    return hashes(np.frombuffer(b"".join(body), np.uint8), np.concatenate([[0], ends[:-1]]), ends, _SEED)


_COMMON = np.sort(_hashes_of(sorted(set(COMMON))))


def signatures(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """The sets of signatures of texts: all of them, 32 bits each and ascending in a text, and where each text's start.

    Words are runs of ASCII letters, digits and other than ASCII, A-Z as a-z. Each common word signs with the next CHAIN
    content words; so does the start of a text, with as many as there are, and, so that texts without listed words are
    covered, one in STAND_IN content words before which no common word stands within DROUGHT words. A text without
    content words signs with all its bytes, an empty one with nothing.
    """
    sizes = np.array([len(t) for t in texts], np.int64)
    offsets = np.concatenate([[0], np.cumsum(sizes)])
    data = np.frombuffer(b"".join(texts), np.uint8)
    start, end, first = spans(data, offsets, NOT_ALNUM) if len(data) else (np.zeros(0, np.int64),) * 2 + (np.zeros(len(offsets), np.int64),)
    word = hashes(data, start, end, _SEED) if len(start) else np.zeros(0, np.uint64)
    owner = np.repeat(np.arange(len(texts)), np.diff(first))
    place = np.searchsorted(_COMMON, word)
    common = _COMMON[np.minimum(place, len(_COMMON) - 1)] == word
    content = np.flatnonzero(~common)
    till = np.searchsorted(content, first)  # content words before each text
    last = np.maximum.accumulate(np.where(common, np.arange(len(word)), -1)) if len(word) else np.zeros(0, np.int64)
    last = np.maximum(last, first[owner])
    stands_in = ~common & (np.arange(len(word)) - last >= DROUGHT) & (word % np.uint64(STAND_IN) == 0)
    anchor = np.flatnonzero(common | stands_in)
    at = np.searchsorted(content, anchor, side="right")
    whole = at + CHAIN <= till[owner[anchor] + 1]
    anchor, at = anchor[whole], at[whole]
    signed = word[anchor] * _ODD
    for k in range(CHAIN):
        signed = mix64(signed + word[content[at + k]])
    begun = np.flatnonzero(sizes > 0)
    opening = np.full(len(begun), _START)
    for k in range(CHAIN):
        there = till[begun] + k < till[begun + 1]
        opening[there] = mix64(opening[there] + word[content[till[begun][there] + k]])
    for i in np.flatnonzero(till[begun] == till[begun + 1]):
        opening[i] = mix64(_TEXT + np.frombuffer(hashlib.sha256(texts[begun[i]]).digest()[:8], np.uint64))[0]
    who = np.concatenate([owner[anchor], begun]).astype(np.uint64)
    keys = np.unique(who << np.uint64(32) | np.concatenate([signed, opening]) >> np.uint64(32))
    return keys, np.searchsorted(keys >> np.uint64(32), np.arange(len(texts) + 1, dtype=np.uint64))


def fingerprints(keys: np.ndarray, starts: np.ndarray) -> list[str]:
    """Each set's signatures, ascending, big-endian, in base64."""
    body = (keys & np.uint64(0xFFFFFFFF)).astype(">u4")
    return [base64.b64encode(body[i:j].tobytes()).decode() for i, j in zip(starts[:-1], starts[1:], strict=True)]


def parsed(prints: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """The sets that fingerprints stand for, as `signatures` gives them."""
    sets = [np.frombuffer(base64.b64decode(p), ">u4").astype(np.uint64) | np.uint64(i) << np.uint64(32) for i, p in enumerate(prints)]
    starts = np.concatenate([[0], np.cumsum([len(s) for s in sets])]).astype(np.int64)
    return np.concatenate(sets) if sets else np.zeros(0, np.uint64), starts


def likeness(keys: np.ndarray, starts: np.ndarray, a: np.ndarray, b: np.ndarray, least: float = 0.0) -> np.ndarray:
    """The Jaccard similarity of the sets a[i] and b[i]; 0 where it is below `least`. Two empty sets are alike.

    Pairs are partitioned by the length of their smaller set. A pair whose lengths alone keep it below `least` is not
    compared; the others are, an eighth of the smaller set at a time, until what is left can't lift them to `least` or
    holds nothing within the other set's range.
    """
    sizes = np.diff(starts)
    small, large = np.where(sizes[a] <= sizes[b], a, b), np.where(sizes[a] <= sizes[b], b, a)
    n, m = sizes[small], sizes[large]
    out = np.where(m == 0, 1.0, 0.0)
    low, high = np.uint64(32), np.uint64(0xFFFFFFFF)
    partition = np.frexp(n)[1]
    for part in np.unique(partition[(n > 0) & (n >= least * m)]):
        pairs = np.flatnonzero((partition == part) & (n > 0) & (n >= least * m))
        found = np.zeros(len(pairs), np.int64)
        width = 1 << int(part)
        step = max(1, width // 8)
        live = np.arange(len(pairs))
        for at in range(0, width, step):
            p = pairs[live]
            rest = np.maximum(n[p] - at, 0)
            bound = found[live] + rest
            more = (rest > 0) & (bound >= least * (n[p] + m[p] - bound))
            # the set is ascending: beyond the other's greatest signature nothing is shared
            next_ = keys[np.minimum(starts[small[p]] + at, len(keys) - 1)] & high
            more &= next_ <= keys[starts[large[p] + 1] - 1] & high
            live, p = live[more], p[more]
            if not len(live):
                break
            take = np.minimum(step, n[p] - at)
            row = np.repeat(np.arange(len(p)), take)
            place = np.arange(len(row)) - np.repeat(np.cumsum(take) - take, take) + starts[small[p]][row] + at
            sought = keys[place] & high | large[p][row].astype(np.uint64) << low
            hit = keys[np.minimum(np.searchsorted(keys, sought), len(keys) - 1)] == sought
            found[live] += np.bincount(row[hit], minlength=len(p))
        value = found / (n[pairs] + m[pairs] - found)
        out[pairs] = np.where(value >= least, value, 0.0)
    return out


def _edit(text: str, other: str) -> str:
    """text with its last third replaced by as much of the start of another."""
    k = len(text) // 3
    return text[: len(text) - k] + other[:k]


def _rows(ids: list, texts: list[str]) -> pa.RecordBatch:
    """Fingerprints of all texts but the last, of their edited forms, and how alike both and the next texts are."""
    n = len(ids)
    edited = [_edit(t, f).encode() for t, f in zip(texts, texts[1:], strict=False)]
    keys, starts = signatures([*(t.encode() for t in texts), *edited])
    own = np.arange(n)
    prints = fingerprints(keys, starts)
    columns = {
        "doc_id": pa.array(ids, pa.int64()), "n_chars": pa.array([len(t) for t in texts[:n]], pa.int64()),
        "edited_sha256": pa.array([hashlib.sha256(t).hexdigest() for t in edited]),
        "fingerprint": pa.array(prints[:n], pa.string()), "edited_fingerprint": pa.array(prints[n + 1 :], pa.string()),
        "near_edited": pa.array(likeness(keys, starts, own, own + n + 1)), "near_next": pa.array(likeness(keys, starts, own, own + 1)),
    }
    return pa.RecordBatch.from_pydict(columns)


_SHAPE = "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"
_EDGE = "edge int, range int, text string, " + _SHAPE
_HEAD, _TAIL = 1, 2


def _chunks(sizes: list[int]) -> Iterator[tuple[int, int]]:
    """Ranges of rows of about CHUNK_BYTES in all, or of one row."""
    i, held = 0, 0
    for j, size in enumerate(sizes):
        if held and held + size > CHUNK_BYTES:
            yield i, j
            i, held = j, 0
        held += size
    if i < len(sizes):
        yield i, len(sizes)


def _packed(text: Column) -> Column:
    @F.arrow_udf("binary")
    def run(texts: pa.Array) -> pa.Array:
        return pa.array([zlib.compress(t.encode(), 1) for t in texts.to_pylist()], pa.binary())

    return run(text)


def _in_order(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (doc_id, packed text, range) of a range in order: results of all but the last, whose follower is in a later range;
    that one and the first come with their texts, as edges."""

    def edge(kind: int, place: int, doc_id: int | None, text: str) -> pa.RecordBatch:
        found = {f.name: pa.nulls(1, f.type) for f in shape} | {"edge": pa.array([kind], pa.int32()), "range": pa.array([place], pa.int32())}
        return pa.RecordBatch.from_pydict(found | {"text": pa.array([text], pa.string()), "doc_id": pa.array([doc_id], pa.int64())}, schema=shape)

    shape = pa.schema(
        [("edge", pa.int32()), ("range", pa.int32()), ("text", pa.string()), ("doc_id", pa.int64()), ("n_chars", pa.int64())]
        + [(x, pa.string()) for x in ("edited_sha256", "fingerprint", "edited_fingerprint")] + [(x, pa.float64()) for x in ("near_edited", "near_next")]
    )
    held: tuple | None = None
    for batch in batches:
        sizes = pc.binary_length(batch.column(1)).to_pylist()
        for i, j in _chunks([3 * size for size in sizes]):
            part = batch.slice(i, j - i)
            ids, place = part.column(0).to_pylist(), part.column(2)[0].as_py()
            texts = [zlib.decompress(t).decode() for t in part.column(1).to_pylist()]
            if held is None:
                yield edge(_HEAD, place, ids[0], texts[0])
            else:
                ids, texts = [held[0], *ids], [held[1], *texts]
            held = ids[-1], texts[-1], place
            if len(ids) > 1:
                done = _rows(ids[:-1], texts)
                blank = [pa.nulls(done.num_rows, shape.field(x).type) for x in ("edge", "range", "text")]
                yield pa.RecordBatch.from_arrays([*blank, *done.columns], schema=shape)
    if held is not None:
        yield edge(_TAIL, held[2], held[0], held[1])


def _pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for i in range(batch.num_rows):
            ids, text, following = (batch.column(k)[i].as_py() for k in range(3))
            yield _rows([ids], [text, following])


def fingerprint_docs(work: Work, docs: DataFrame) -> DataFrame:
    """Per row of docs: doc_id, n_chars (code points), fingerprint, and how alike it is (0 to 1) to the fingerprints of
    its edited text, near_edited, and of the next text, near_next; edited_sha256, edited_fingerprint.

    Rows are next to each other by descending doc_id (null last, rows that repeat a doc_id by a hash of the text); after
    the last comes the first, so a single row is next to itself. The edited text has the last third of the code points
    replaced by the first as many, or all, of the next text. Null text: empty; its fingerprint is empty, too, and alike
    to none but an empty one. Other columns take no part. No rows: no rows.

    Texts move once, packed, in a range sort. A task reads its range in order and holds one text and a piece of a batch; only a
    range's first and last texts are written, to be brought together with the last and first of the ranges beside it.
    """
    order = [F.desc_nulls_last("doc_id"), F.asc("_hash"), F.asc("_read")]
    rows = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    rows = rows.select("doc_id", _packed(F.col("text")).alias("packed"), F.xxhash64("text").alias("_hash"), F.monotonically_increasing_id().alias("_read"))
    rows = rows.repartitionByRange(*order).sortWithinPartitions(*order).select("doc_id", "packed", F.spark_partition_id().alias("range"))
    found = work.keep(rows.mapInArrow(_in_order, _EDGE), "fingerprints")
    ranges = found.where(F.col("edge") == _TAIL).select("range")
    wide = Window.orderBy("range")  # a number per range
    after = ranges.select("range", F.coalesce(F.lead("range").over(wide), F.min("range").over(wide)).alias("after"))
    tails = found.where(F.col("edge") == _TAIL).select("range", "doc_id", "text").join(after, "range")
    heads = found.where(F.col("edge") == _HEAD).select(F.col("range").alias("after"), F.col("text").alias("following"))
    across = tails.join(heads, "after").select("doc_id", "text", "following").mapInArrow(_pairs, _SHAPE)
    return found.where("edge IS NULL").drop("edge", "range", "text").unionByName(across)
