"""Nearest neighbours by int8 tiles: bounded distances first, exact ones for the pairs that the bounds leave."""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from carelens.llm.common import Work

#: Nearest rows per query.
NEAREST = 10
#: Rows in a block of queries and in a block of candidates; a tile holds one of each, some MB.
QUERY_BLOCK, CANDIDATE_BLOCK = 2048, 16384
_STEP = 2048


def usable(vector: Column) -> Column:
    """Neither null nor zero, no null or non-finite component."""
    odd = F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return vector.isNotNull() & (F.size(vector) > 0) & ~odd & F.exists(vector, lambda x: x != 0)


def matrix(column: pd.Series) -> np.ndarray:
    """Vectors of one length as rows in double precision."""
    return np.stack(column.to_list()).astype(np.float64) if len(column) else np.zeros((0, 0))


class Quantised:
    """Rows as int8 with a scale each; `lost` is the length of what rounding took from a row."""

    def __init__(self, rows: np.ndarray):
        top = np.abs(rows).max(axis=1, initial=0.0)
        self.scale = np.where(top > 0, top, 1.0) / 127.0
        self.q = np.rint(rows / self.scale[:, None]).astype(np.int8)
        near = self.q * self.scale[:, None]
        # Rounding errors of these very computations stay far below this addition.
        self.lost = np.sqrt(((rows - near) ** 2).sum(axis=1)) + 1e-9 * np.sqrt((rows**2).sum(axis=1)) + 1e-300
        self.norm2 = (self.q.astype(np.int64) ** 2).sum(axis=1) * self.scale**2

    def distances(self, other: Quantised, a: slice, b: slice) -> tuple[np.ndarray, np.ndarray]:
        """Least and greatest possible distance of rows a to rows b of other.

        Products of int8 numbers are added as whole numbers: in 32-bit floats while sums stay below 2**24.
        """
        exact = np.float32 if self.q.shape[1] * 127 * 127 < 1 << 24 else np.float64
        dot = self.q[a].astype(exact) @ other.q[b].astype(exact).T
        square = self.norm2[a, None] + other.norm2[None, b] - 2.0 * dot * self.scale[a, None] * other.scale[None, b]
        slack = 1e-12 * (self.norm2[a, None] + other.norm2[None, b])
        err = self.lost[a, None] + other.lost[None, b]
        return np.sqrt(np.maximum(square - slack, 0)) - err, np.sqrt(np.maximum(square + slack, 0)) + err


def exact_distance(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Euclidean distances of paired rows, squares added component by component."""
    total = np.zeros(len(x))
    for d in range(x.shape[1]):
        total += (x[:, d] - y[:, d]) ** 2
    return np.sqrt(total)


def tile(queries: np.ndarray, query_ids: np.ndarray, rows: np.ndarray, ids: np.ndarray, k: int) -> list[list[tuple[float, int]]]:
    """For each query the k nearest rows of the tile, other ids only, as (distance, id) in order."""
    q, c = Quantised(queries), Quantised(rows)
    heaps: list[list[tuple[float, int]]] = [[] for _ in query_ids]
    reach = np.full(len(queries), np.inf)  # no row of the final k lies farther than this
    for start in range(0, len(rows), _STEP):
        part = slice(start, min(start + _STEP, len(rows)))
        low, high = q.distances(c, slice(None), part)
        own = query_ids[:, None] == ids[None, part]
        high[own] = np.inf
        low[own] = np.inf
        if high.shape[1] >= k:
            reach = np.minimum(reach, np.partition(high, k - 1, axis=1)[:, k - 1])
        i, j = np.nonzero((low <= reach[:, None]) & ~own)
        far = exact_distance(queries[i], rows[start + j])
        for a, d, b in zip(i.tolist(), far.tolist(), ids[start + j].tolist(), strict=True):
            entry = (-d, -b)
            if len(heaps[a]) < k:
                heapq.heappush(heaps[a], entry)
            elif entry > heaps[a][0]:
                heapq.heapreplace(heaps[a], entry)
        full = [a for a in range(len(heaps)) if len(heaps[a]) == k]
        reach[full] = np.minimum(reach[full], [-heaps[a][0][0] for a in full])
    return [sorted((-d, -b) for d, b in h) for h in heaps]


def nearest(work: Work, vectors: DataFrame, is_query: Column, k: int = NEAREST, query_block: int = QUERY_BLOCK, candidate_block: int = CANDIDATE_BLOCK) -> DataFrame:
    """The k rows of vectors (vec_id, embedding) nearest to each row that is_query says: query_id, rank, vec_id, score.

    Euclidean distance in double precision on the vectors given; nearest first, ties to the smaller vec_id. Queries
    and candidates are dealt into blocks by a hash; each pair of a query block and a candidate block is a tile. In a
    tile int8 products bound every distance from both sides; pairs whose least distance does not pass the k-th of the
    greatest ones are computed again in double precision. Heaps merge the tiles' rows, first within a tile, then per
    query; a query meets k rows of each candidate block there.

    Rows without vec_id, and vectors that are null, empty, zero or hold null or non-finite components, take no part,
    as query or as candidate. Vectors of another length than the query's are no candidates. A candidate with the
    query's own vec_id is the query itself; other rows that repeat a vec_id each count. Fewer than k candidates: all.
    """
    good = vectors.select("vec_id", "embedding", is_query.alias("q")).where(F.col("vec_id").isNotNull() & usable(F.col("embedding")))
    good = work.keep(good.withColumn("dim", F.size("embedding")).withColumn("q", F.coalesce("q", F.lit(False))), "vectors")
    # How many blocks each length of vector needs: a row per length.
    sizes = good.groupBy("dim").agg(F.count("*").alias("n"), F.sum(F.col("q").cast("long")).alias("n_q")).where("n_q > 0").select(
        "dim", F.ceil(F.col("n") / candidate_block).cast("int").alias("cs"), F.ceil(F.col("n_q") / query_block).cast("int").alias("qs")
    )
    rows = good.join(sizes, "dim")
    spread = F.xxhash64("vec_id", "embedding")
    candidates = rows.select("dim", "vec_id", "embedding", F.pmod(spread, "cs").cast("int").alias("c"), F.explode(F.sequence(F.lit(0), F.col("qs") - 1)).alias("qb"))
    queries = rows.where("q").select("dim", "vec_id", "embedding", F.pmod(spread, "qs").cast("int").alias("qb"), F.explode(F.sequence(F.lit(0), F.col("cs") - 1)).alias("c"))
    queries = queries.toDF("q_dim", "vec_id", "embedding", "q_qb", "q_c")  # columns of their own beside the candidates'

    def run(a: pd.DataFrame, b: pd.DataFrame) -> pd.DataFrame:
        found = []
        if len(a) and len(b):
            query_ids = a["vec_id"].to_numpy()
            found = [
                (qid, d, vid)
                for qid, best in zip(query_ids.tolist(), tile(matrix(a["embedding"]), query_ids, matrix(b["embedding"]), b["vec_id"].to_numpy(), k), strict=True)
                for d, vid in best
            ]
        return pd.DataFrame(found, columns=["query_id", "score", "vec_id"]).astype({"query_id": "int64", "score": "float64", "vec_id": "int64"})

    found = queries.groupBy("q_dim", "q_qb", "q_c").cogroup(candidates.groupBy("dim", "qb", "c")).applyInPandas(run, "query_id long, score double, vec_id long")

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows come by query, so one heap is open at a time."""
        open_id, heap = None, []

        def closed() -> pa.RecordBatch:
            best = sorted((-d, -b) for d, b in heap)
            return pa.RecordBatch.from_arrays(
                [pa.array([open_id] * len(best), pa.int64()), pa.array(range(1, len(best) + 1), pa.int32()), pa.array([b for _, b in best], pa.int64()), pa.array([d for d, _ in best], pa.float64())],
                names=["query_id", "rank", "vec_id", "score"],
            )

        for batch in batches:
            for qid, d, vid in zip(*(batch.column(i).to_pylist() for i in range(3)), strict=True):
                if qid != open_id:
                    if heap:
                        yield closed()
                    open_id, heap = qid, []
                if len(heap) < k:
                    heapq.heappush(heap, (-d, -vid))
                elif (-d, -vid) > heap[0]:
                    heapq.heapreplace(heap, (-d, -vid))
        if heap:
            yield closed()

    return found.repartition("query_id").sortWithinPartitions("query_id").mapInArrow(merge, "query_id long, rank int, vec_id long, score double")
