"""Near-duplicate documents: MinHash bands propose, odd sketches screen, full shingle sets decide."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from carelens.llm.common import Work, components, flat, local_components, mix64, split_join, steps, whole_groups, whole_row
from carelens.llm.words import WHITE, hashes, spans

#: Words in a shingle; a link needs 100 * intersection >= PERCENT * union.
SHINGLE, PERCENT = 5, 85
#: 32 bands of 4 of 128 samples: two sets of similarity 0.85 share no band with a probability of 6e-11.
BANDS, ROWS = 32, 4
SAMPLES = BANDS * ROWS
#: Bits of an odd sketch, and the estimated similarity from which a pair is looked at: more than six standard
#: deviations of the estimate below 0.85.
BITS, SCREEN = 256, 0.55
#: Where near-duplicates are dropped: links from 0.8, which no band shows with a probability of 5e-8, and a screen that
#: misses one with 8e-8.
NEAR_PERCENT, NEAR_SCREEN = 80, 0.5
#: Rows of a bucket, and bytes of a cluster's texts, that are compared in one piece; larger ones are compared in pairs of pieces.
BUCKET_BLOCK, TEXT_BLOCK = 1024, 4 << 20
_CHUNK = 4 << 20
_STEP = 8192
_Q = np.uint64(0x9E3779B97F4A7C15)
_FACTORS = np.random.default_rng(6).integers(1 << 62, 1 << 63, SAMPLES, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def shingle_sets(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The distinct shingles of each text as sorted 64-bit hashes, and where each text's set starts.

    A text of fewer words than a shingle has one, of all its words; a text without words has none.
    """
    start, end, first = spans(data, offsets, WHITE)
    word = hashes(data, start, end, 66)
    n = np.diff(first)
    owners, values = [], []
    total = np.zeros(len(word), np.uint64)
    factor = np.uint64(1)
    place = np.arange(len(word)) - np.repeat(first[:-1], n)
    text = np.repeat(np.arange(len(n)), n)
    for size in range(1, SHINGLE + 1):
        total[: max(0, len(word) - size + 1)] += word[size - 1 :] * factor
        factor = np.uint64(int(factor) * int(_Q) & (1 << 64) - 1)
        own = (n[text] == size) & (place == 0) if size < SHINGLE else place <= n[text] - SHINGLE
        owners.append(text[own])
        values.append(mix64(total[own] + np.uint64(size)))
    owner, value = np.concatenate(owners), np.concatenate(values)
    order = np.lexsort((value, owner))
    owner, value = owner[order], value[order]
    new = np.ones(len(value), bool)
    new[1:] = (value[1:] != value[:-1]) | (owner[1:] != owner[:-1])
    owner, value = owner[new], value[new]
    return value, np.searchsorted(owner, np.arange(len(n) + 1))


def minima(value: np.ndarray, at: np.ndarray) -> np.ndarray:
    """MinHash samples of each set, a row per set; of an empty set the greatest number."""
    out = np.full((len(at) - 1, SAMPLES), np.iinfo(np.uint64).max, np.uint64)
    owner = np.repeat(np.arange(len(at) - 1), np.diff(at))
    for lo in range(0, len(value), _STEP):
        part = owner[lo : lo + _STEP]
        heads = np.concatenate([[0], np.flatnonzero(np.diff(part)) + 1])
        least = np.minimum.reduceat(value[lo : lo + _STEP, None] * _FACTORS, heads, axis=0)
        out[part[heads]] = np.minimum(out[part[heads]], least)
    return out


def odd_sketches(samples: np.ndarray) -> np.ndarray:
    """Each sample, with its number, flips one of BITS bits: rows of BITS / 64 words."""
    bit = mix64(samples + np.arange(1, SAMPLES + 1, dtype=np.uint64) * _Q) % np.uint64(BITS)
    flat_bit = bit.astype(np.int64) + BITS * np.arange(len(samples))[:, None]
    odd = np.bincount(flat_bit.ravel(), minlength=BITS * len(samples)) & 1
    return np.packbits(odd.astype(np.uint8).reshape(-1, BITS), axis=1).view(np.uint64)


def most_bits(similarity: float) -> int:
    """The greatest number of differing bits at which an estimate still reaches the similarity."""
    differing = 2 * SAMPLES * (1 - similarity)
    return int(BITS / 2 * (1 - np.exp(-2 * differing / BITS)))


def band_keys(samples: np.ndarray) -> np.ndarray:
    total = np.zeros((len(samples), BANDS), np.uint64)
    for r in range(ROWS):
        total = mix64(total + samples[:, r::ROWS] * _Q)
    return mix64(total + np.arange(BANDS, dtype=np.uint64)).view(np.int64)


def signatures(docs: DataFrame) -> DataFrame:
    """Per row of docs (doc_id, text): doc_id, n_shingles, a digest of the set (s1, s2), odd sketch and band keys."""
    kind = docs.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, at = flat(batch.column(1))
            for i, j in steps(at):
                value, bounds = shingle_sets(data[at[i] : at[j]], at[i : j + 1] - at[i])
                samples = minima(value, bounds)
                digest = [np.concatenate([[np.uint64(0)], np.cumsum(mix64(value ^ np.uint64(s)))]) for s in (1, 2)]
                keys = band_keys(samples)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(i, j - i), pa.array(np.diff(bounds)), *[pa.array((d[bounds[1:]] - d[bounds[:-1]]).view(np.int64)) for d in digest],
                     pa.array([x.tobytes() for x in odd_sketches(samples)], pa.binary()), pa.ListArray.from_arrays(pa.array(np.arange(0, keys.size + 1, BANDS, dtype=np.int32)), pa.array(keys.ravel()))],
                    names=["doc_id", "n_shingles", "s1", "s2", "odd", "bands"],
                )

    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {kind}, n_shingles long, s1 long, s2 long, odd binary, bands array<long>")


def _blocks(n_blocks: str, spread: str) -> list:
    """A row's block, and every other block that it is compared with."""
    return [F.pmod(F.xxhash64(spread), F.col(n_blocks)).cast("int").alias("b"), F.explode(F.sequence(F.lit(0), F.col(n_blocks) - 1)).alias("o")]


def _star(ids: np.ndarray, a: np.ndarray, b: np.ndarray) -> pa.RecordBatch:
    """Edges that join what the pairs join: from each row to the first row of its component."""
    label = local_components(len(ids), a, b)
    own = np.flatnonzero(label != np.arange(len(ids)))
    return pa.RecordBatch.from_arrays([pa.array(ids[own]), pa.array(ids[label[own]])], names=["a", "b"])


def close_pairs(odd: np.ndarray, at: np.ndarray, block: np.ndarray, crossed: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of rows of one group whose sketches differ in at most `most` bits; in crossed groups, of different blocks."""
    found = []
    size = np.diff(at)
    for m in np.unique(size[size > 1]).tolist():
        groups = np.flatnonzero(size == m)
        if m <= 64:
            i, j = np.triu_indices(m, 1)
            per = max(1, (1 << 18) // len(i))
            for lo in range(0, len(groups), per):
                head = at[groups[lo : lo + per]][:, None]
                a, b = (head + i).ravel(), (head + j).ravel()
                near = np.bitwise_count(odd[a] ^ odd[b]).sum(axis=1) <= most
                found.append((a[near], b[near]))
        else:
            for g in groups.tolist():
                own = odd[at[g] : at[g + 1]]
                for lo in range(0, m, 128):
                    near = np.bitwise_count(own[lo : lo + 128, None] ^ own[None]).sum(axis=2) <= most
                    a, b = np.nonzero(near)
                    up = a + lo < b
                    found.append((a[up] + lo + at[g], b[up] + at[g]))
    if not found:
        return np.zeros(0, int), np.zeros(0, int)
    a, b = np.concatenate([x for x, _ in found]), np.concatenate([y for _, y in found])
    both = ~crossed[a] | (block[a] != block[b])
    return a[both], b[both]


def similar_pairs(value: np.ndarray, at: np.ndarray, group: np.ndarray, percent: int) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of sets of one group with 100 * intersection >= percent * union, by lists of the sets that hold a shingle."""
    size = np.diff(at)
    owner = np.repeat(np.arange(len(size)), size)
    value = value ^ mix64(group[owner].astype(np.uint64) + np.uint64(1))  # groups share no shingles
    order = np.argsort(value, kind="stable")
    sorted_value, holders = value[order], owner[order]
    new = np.concatenate([[True], sorted_value[1:] != sorted_value[:-1]]) if len(value) else np.zeros(0, bool)
    number = np.cumsum(new) - 1
    starts = np.append(np.flatnonzero(new), len(value))
    ident = np.empty(len(value), np.int64)
    ident[order] = number
    held = np.diff(starts)
    a, b = [], []
    for i in range(len(size)):
        own = ident[at[i] : at[i + 1]]
        own = own[held[own] > 1]
        if len(own) * 100 < percent * size[i]:  # too few shingles that any other set has
            continue
        n = held[own]
        spot = np.repeat(starts[own] - np.cumsum(n) + n, n) + np.arange(n.sum())
        shared = np.bincount(holders[spot], minlength=0)
        j = np.flatnonzero(shared)
        j = j[j > i]
        inter = shared[j]
        j = j[100 * inter >= percent * (size[i] + size[j] - inter)]
        a.append(np.full(len(j), i))
        b.append(j)
    return (np.concatenate(a), np.concatenate(b)) if a else (np.zeros(0, int), np.zeros(0, int))


def near_documents(work: Work, docs: DataFrame, percent: int = PERCENT, screen: float = SCREEN, bucket_block: int = BUCKET_BLOCK, text_block: int = TEXT_BLOCK) -> DataFrame:
    """Per row of docs (doc_id, text): doc_id, n_shingles, component_id, kept.

    Documents with equal shingle sets are one class, its smallest doc_id stands for it. Classes that share a band
    bucket are compared by odd sketches, all pairs, in memory; each bucket hands on a star of edges per group of close
    ones. What these edges join is a cluster; a cluster's full sets are compared exactly, and stars of true links give
    the components. Large buckets and clusters are compared in pairs of pieces, so none needs to fit one task.

    A text without words, or null: no shingles, no links. Null doc_id: no links, component_id null, kept. Rows that
    repeat a doc_id are one node, linked with whatever any of them is linked with. No rows: no rows.
    """
    signed = work.keep(signatures(docs), "signatures")
    sets = signed.where("doc_id IS NOT NULL AND n_shingles > 0")
    classes = work.keep(
        sets.groupBy("s1", "s2", "n_shingles").agg(F.min("doc_id").alias("rep"), F.first("odd").alias("odd"), F.first("bands").alias("bands")), "classes"
    )
    banded = classes.select("rep", F.explode("bands").alias("key"))
    shared = work.keep(banded.groupBy("key").agg(F.count("*").alias("n")).where("n > 1"), "buckets")
    shared = shared.select("key", F.ceil(F.col("n") / bucket_block).cast("int").alias("nb"))
    # Few buckets are shared, so sketches follow only then.
    member = work.keep(banded.join(shared, "key"), "members").join(classes.select("rep", "odd"), "rep")
    member = member.select("key", "rep", "odd", "nb", *_blocks("nb", "rep")).select("key", F.least("b", "o").alias("bi"), F.greatest("b", "o").alias("bj"), "b", "rep", "odd")
    most = most_bits(screen)
    kind = docs.schema["doc_id"].dataType.simpleString()

    def screened(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table, at in whole_groups(batches, ["key", "bi", "bj"], _CHUNK):
            odd = flat(table["odd"])[0].view(np.uint64).reshape(-1, BITS // 64)
            crossed = table["bi"].to_numpy() != table["bj"].to_numpy()
            a, b = close_pairs(odd, at, table["b"].to_numpy(), crossed, most)
            yield _star(table["rep"].to_numpy(), a, b)

    dealt = member.repartition("key", "bi", "bj").sortWithinPartitions("key", "bi", "bj")
    edges = dealt.mapInArrow(screened, f"a {kind}, b {kind}")
    cluster = work.keep(components(work, edges), "clusters")

    texts = docs.select("doc_id", "text").where("text IS NOT NULL").join(cluster.withColumnRenamed("node", "doc_id"), "doc_id")
    texts = work.keep(texts.select("component", "doc_id", "text", F.octet_length("text").alias("bytes")), "texts")
    sizes = texts.groupBy("component").agg(F.ceil(F.sum("bytes") / text_block).cast("int").alias("nb")).select("component", F.greatest("nb", F.lit(1)).alias("nb"))
    pieces = split_join(texts, sizes, ["component"]).select("component", "doc_id", "text", *_blocks("nb", "doc_id"))
    pieces = pieces.select("component", F.least("b", "o").alias("bi"), F.greatest("b", "o").alias("bj"), "b", "doc_id", "text")

    def confirmed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table, at in whole_groups(batches, ["component", "bi", "bj"], _CHUNK):
            value, bounds = _sets_of(table["text"])
            group = np.repeat(np.arange(len(at) - 1), np.diff(at))
            a, b = similar_pairs(value, bounds, group, percent)
            block, crossed = table["b"].to_numpy(), table["bi"].to_numpy() != table["bj"].to_numpy()
            both = ~crossed[a] | (block[a] != block[b])
            yield _star(table["doc_id"].to_numpy(), a[both], b[both])

    dealt = pieces.repartition("component", "bi", "bj").sortWithinPartitions("component", "bi", "bj")
    links = dealt.mapInArrow(confirmed, f"a {kind}, b {kind}")
    same = sets.join(classes.select("s1", "s2", "n_shingles", "rep"), ["s1", "s2", "n_shingles"]).select(F.col("doc_id").alias("a"), F.col("rep").alias("b"))
    joined = components(work, links.unionByName(same.where("a <> b")))
    out = signed.select("doc_id", "n_shingles").join(joined.withColumnRenamed("node", "doc_id"), "doc_id", "left")
    component = F.coalesce("component", "doc_id")
    return out.select("doc_id", "n_shingles", component.alias("component_id"), F.coalesce(F.col("doc_id") == component, F.lit(True)).alias("kept"))


def _sets_of(texts: pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    data, at = flat(texts)
    values, sizes = [], []
    for i, j in steps(at):
        value, bounds = shingle_sets(data[at[i] : at[j]], at[i : j + 1] - at[i])
        values.append(value)
        sizes.append(np.diff(bounds))
    return np.concatenate(values), np.concatenate([[0], np.cumsum(np.concatenate(sizes))])


def drop_near(work: Work, docs: DataFrame, percent: int = NEAR_PERCENT, screen: float = NEAR_SCREEN) -> DataFrame:
    """docs, all columns, with one row of each component of links from percent: that of the smallest doc_id.

    Every row is a node, so rows that share a doc_id are near each other only if their texts are. Of rows with the
    smallest doc_id the one whose columns hash least stays. Rows without doc_id stay. No rows: no rows.
    """
    rows = work.keep(docs.select(F.monotonically_increasing_id().alias("r"), whole_row(docs).alias("doc")), "rows")
    nodes = rows.where("doc.doc_id IS NOT NULL").select(F.col("r").alias("doc_id"), "doc.text")
    near = near_documents(work, nodes, percent, screen)
    moved = work.keep(near.where("NOT kept").select(F.col("component_id").alias("c"), F.col("doc_id").alias("r")), "near")
    linked = moved.unionByName(moved.select("c", F.col("c").alias("r")).distinct())
    # What a component's rows come to is one row each by then, combined before the shuffle.
    linked = work.keep(linked.join(rows.select("r", F.struct("doc.doc_id", F.xxhash64("doc"), "r").alias("rank")), "r"), "linked")
    first = linked.groupBy("c").agg(F.min("rank").alias("first"))
    gone = split_join(linked, first, ["c"]).where(F.col("r") != F.col("first.r")).select("r")
    return rows.join(gone, "r", "left_anti").select("doc.*")
