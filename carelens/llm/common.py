"""What the operators share: the shared work folder, flat text buffers in Arrow tasks, connected components."""

from __future__ import annotations

import re
import time
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from carelens.sources.work import shared_dir

#: Bytes of text that one numpy step handles; longer single texts form a step of their own.
CHUNK_BYTES = 1 << 19


class Work:
    """Tables written between steps, so that lineage ends there and a lost executor repeats one step only."""

    def __init__(self, spark: SparkSession, name: str):
        self.spark = spark
        self.root = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
        self._n = 0

    def keep(self, df: DataFrame, name: str) -> DataFrame:
        """Write df and read it again."""
        self._n += 1
        path = f"{self.root}/{self._n:03d}-{name}"
        cleanup = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"  # what the step shuffled goes with it
        before = self.spark.conf.get(cleanup, None)
        self.spark.conf.set(cleanup, "true")
        try:
            df.write.option("compression", "zstd").parquet(path)
        finally:
            self.spark.conf.unset(cleanup) if before is None else self.spark.conf.set(cleanup, before)
        back = self.spark.read.schema(df.schema).parquet(path)
        back._kept_at = path
        return back

    def drop(self, *kept: DataFrame) -> None:
        """Remove tables that no later step reads."""
        jvm = self.spark._jvm
        for df in kept:
            path = jvm.org.apache.hadoop.fs.Path(df._kept_at)
            path.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(path, True)


def sweep(spark: SparkSession, hours: float = 24.0) -> list[str]:
    """Remove the work tables of runs that wrote nothing for so many hours, and tell their folders' names.

    A query's result may read tables that its `Work` has kept, so these stay when it returns. Only folders that are named
    as `Work` names them, a name and 32 hexadecimal digits, are looked at.
    """
    jvm, top = spark._jvm, spark._jvm.org.apache.hadoop.fs.Path(shared_dir(spark))
    store = top.getFileSystem(spark._jsc.hadoopConfiguration())
    before = (time.time() - 3600 * hours) * 1000
    gone = []
    for folder in store.listStatus(top) if store.exists(top) else []:
        name = folder.getPath().getName()
        if folder.isDirectory() and re.fullmatch(r".+-[0-9a-f]{32}", name):
            newest = max([folder.getModificationTime(), *(f.getModificationTime() for f in store.listStatus(folder.getPath()))])
            if newest < before and store.delete(jvm.org.apache.hadoop.fs.Path(folder.getPath().toString()), True):
                gone.append(name)
    return sorted(gone)


def flat(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a string or binary column as one array, and where each row starts; null rows are empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    _, offsets, data = column.buffers()
    n = len(column)
    if n == 0 or offsets is None:
        return np.zeros(0, np.uint8), np.zeros(n + 1, np.int64)
    at = np.frombuffer(offsets, np.int64 if wide else np.int32)[column.offset : column.offset + n + 1].astype(np.int64)
    body = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return body[at[0] : at[-1]], at - at[0]


def steps(offsets: np.ndarray, limit: int = CHUNK_BYTES) -> Iterator[tuple[int, int]]:
    """Row ranges of at most `limit` bytes each, or of one row."""
    n, i = len(offsets) - 1, 0
    while i < n:
        j = int(np.searchsorted(offsets, offsets[i] + limit, side="right")) - 1
        j = min(max(j, i + 1), n)
        yield i, j
        i = j


def mix64(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


class Rolling:
    """Hashes of any stretch of an array of symbols, by prefix sums modulo 2**64.

    The power of the odd base at a place is undone by its inverse, so equal stretches hash alike wherever they stand.
    """

    def __init__(self, symbols: int, seed: int):
        draw = np.random.default_rng(seed)
        self.values = draw.integers(1, 1 << 63, symbols, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
        self.base = int(draw.integers(1 << 58, 1 << 60)) * 8 + 5
        self.inverse = pow(self.base, -1, 1 << 64)
        self._up = self._powers(self.base, 1024)
        self._down = self._powers(self.inverse, 1024)

    @staticmethod
    def _powers(base: int, n: int) -> np.ndarray:
        out = np.ones(n, np.uint64)
        out[1:] = np.uint64(base)
        return np.multiply.accumulate(out)

    def _grow(self, n: int) -> None:
        if n > len(self._up):
            n = max(n, 2 * len(self._up))
            self._up, self._down = self._powers(self.base, n), self._powers(self.inverse, n)

    def sums(self, symbols: np.ndarray) -> np.ndarray:
        self._grow(len(symbols) + 1)
        out = np.zeros(len(symbols) + 1, np.uint64)
        np.cumsum(self.values[symbols] * self._up[: len(symbols)], out=out[1:])
        return out

    def of(self, sums: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        """The unmixed hash of each stretch [start, end)."""
        return (sums[end] - sums[start]) * self._down[start]


def local_components(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """For nodes 0..n-1 and edges a-b: the smallest node of each node's component."""
    label = np.arange(n)
    while len(a):
        low = np.minimum(label[a], label[b])
        before = label.copy()
        np.minimum.at(label, label[a], low)
        np.minimum.at(label, label[b], low)
        while True:
            jumped = label[label]
            if (jumped == label).all():
                break
            label = jumped
        if (label == before).all():
            break
    return label


def quoted(name: str) -> str:
    """A column's name as it is, whatever characters it has."""
    return f"`{name.replace('`', '``')}`"


def whole_row(df: DataFrame) -> Column:
    """All columns of a row as one struct."""
    return F.struct(*[F.col(quoted(c)).alias(c) for c in df.columns])


def split_join(left: DataFrame, right: DataFrame, keys: list[str], how: str = "inner") -> DataFrame:
    """Join by keys that are unique on the right, so that a key which very many rows of the left share may be split.

    The adaptive planner splits a partition only where both sides come straight from a shuffle. An aggregate by the same
    keys would be joined in place; null-safe equality gives both sides a shuffle of their own.
    """
    other = right.select(*[F.col(k).alias(f"_{k}") for k in keys], *[c for c in right.columns if c not in keys])
    same = [F.col(k).eqNullSafe(F.col(f"_{k}")) for k in keys]
    return left.join(other, same, how).drop(*[f"_{k}" for k in keys])


def components(work: Work, edges: DataFrame) -> DataFrame:
    """Connected components of edges (a, b): rows (node, component), the smallest node being the component's name.

    Alternates hooking the larger and the smaller neighbours of every node to its least neighbour until nothing moves.
    Each round is two aggregates and two joins on a node; a node with very many edges is one key of a join whose
    partitions the adaptive planner may split. Nodes without an edge to another node are not returned.
    """
    now = work.keep(
        edges.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), "edges"
    )
    mark = None
    while True:
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = (
            split_join(both.where("v > u"), least, ["u"]).select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()
        )
        large = work.keep(large, "large")
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = split_join(large, least, ["u"]).select(
            F.explode(F.array(F.struct(F.col("u").alias("u"), F.col("m").alias("v")), F.struct(F.col("v").alias("u"), F.col("m").alias("v")))).alias("e")
        ).select("e.u", "e.v").where("u <> v").distinct()
        small = work.keep(small, "small")
        seen = small.agg(
            F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")), F.min("u"), F.max("v")
        ).first()
        work.drop(now, large)
        now = small
        if seen == mark:
            break
        mark = seen
    stars = now.select(F.col("u").alias("node"), F.col("v").alias("component"))
    return stars.unionByName(stars.select(F.col("component").alias("node"), "component").distinct())


def as_batch(columns: dict, schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(columns[f.name], f.type) if not isinstance(columns[f.name], pa.Array) else columns[f.name].cast(f.type) for f in schema], schema=schema)


def whole_groups(batches: Iterator[pa.RecordBatch], keys: list[str], limit: int) -> Iterator[tuple[pa.Table, np.ndarray]]:
    """Cut rows that come sorted by integer keys into tables of about `limit` bytes, or of one group if that is more.

    No group is cut in two. With each table comes the row where each of its groups starts, and the number of rows.
    """

    def bounds(table: pa.Table) -> np.ndarray:
        new = np.zeros(table.num_rows, bool)
        for key in keys:
            value = table[key].to_numpy()
            new[1:] |= value[1:] != value[:-1]
        return np.concatenate([[0], np.flatnonzero(new), [table.num_rows]])

    held: list[pa.RecordBatch] = []
    size = 0
    for batch in batches:
        if not batch.num_rows:
            continue
        held.append(batch)
        size += batch.nbytes
        if size >= limit:
            table = pa.Table.from_batches(held)
            at = bounds(table)
            if len(at) > 2:
                yield table.slice(0, at[-2]), at[:-1]
                held = pa.Table.from_batches(table.slice(at[-2]).to_batches()).combine_chunks().to_batches()
                size = sum(b.nbytes for b in held)
    if held:
        table = pa.Table.from_batches(held)
        yield table, bounds(table)
