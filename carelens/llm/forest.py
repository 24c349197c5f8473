"""Near-duplicate vectors: dense groups are compared whole, the rest by random-projection trees whose splits overlap."""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from carelens.llm.common import Work, components, local_components, mix64, split_join
from carelens.llm.vectors import usable

#: Least cosine of a link.
COSINE = 0.9
TREES = 8
#: Both children get the rows within this share of the rows on either side of the median.
SPILL = 0.05
#: Nodes of more rows are split; so many rows draw the splits of all trees.
LEAF, FIT_ROWS = 1024, 32_768
#: Leaves of more rows, such as those of one vector that very many rows repeat, are compared block by block.
BLOCK = 2048
_LEAST_FIT = 32
#: A leaf with more than twice LEAF rows is split anew by about so many rows of its own; so many of its rows meet these
#: splits in one task.
FRESH, PIECE = 2048, 8192
#: The number of a leaf holds its tree above so many bits; the trees are followed by the dense groups.
_TREE = 48
#: A row of the sample is dense if it stands for links to a leaf's fourth of rows, and has so many in the sample; rows
#: whose cosine to a group's centre reaches CORE are the group's own.
DENSE_SHARE, _LEAST_DENSE, CORE = 0.25, 8, 0.92


class Tree:
    """Splits drawn from a sample: every node projects on a direction of its own, cut at the median of its rows."""

    def __init__(self, sample: np.ndarray, rows: float, seed: tuple[int, ...], spill: float, leaf: int):
        self.seed, self.splits, self.dim = seed, {}, sample.shape[1]
        open_nodes = [(1, sample)]
        while open_nodes:
            node, part = open_nodes.pop()
            if len(part) < _LEAST_FIT or len(part) / len(sample) * rows <= leaf:
                continue
            centre = part.mean(axis=0)
            if (part @ centre >= CORE * np.sqrt((centre**2).sum())).mean() > 0.5:  # mostly one group
                continue
            at = part @ self.direction(node)
            low, high = np.quantile(at, [0.5 - spill, 0.5 + spill])
            left, right = at <= high, at >= low
            if max(left.sum(), right.sum()) > 0.9 * len(part):  # alike rows, which no plane parts
                continue
            self.splits[node] = (float(low), float(high))
            open_nodes += [(2 * node, part[left]), (2 * node + 1, part[right])]
        self._number()

    @classmethod
    def of(cls, splits: dict[int, tuple[float, float]], dim: int, seed: tuple[int, ...]) -> Tree:
        """A tree with given splits."""
        tree = cls.__new__(cls)
        tree.seed, tree.splits, tree.dim = seed, splits, dim
        tree._number()
        return tree

    def _number(self) -> None:
        parents = set(self.splits)
        ends = sorted({c for p in parents for c in (2 * p, 2 * p + 1)} - parents) or [1]
        self.leaves = {node: i for i, node in enumerate(ends)}

    def direction(self, node: int) -> np.ndarray:
        """Drawn from the node's name, so that it need not be sent."""
        drawn = np.random.default_rng((*self.seed, node)).standard_normal(self.dim)
        return drawn / np.sqrt((drawn**2).sum())

    def descend(self, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Pairs of row number and leaf; a row near a cut goes both ways."""
        out, todo = [], [(1, np.arange(len(rows)))]
        while todo:
            node, own = todo.pop()
            if not len(own):
                continue
            if node not in self.splits:
                out.append((own, np.full(len(own), self.leaves[node])))
                continue
            low, high = self.splits[node]
            at = rows[own] @ self.direction(node)
            todo += [(2 * node, own[at <= high]), (2 * node + 1, own[at >= low])]
        if not out:
            return np.zeros(0, int), np.zeros(0, int)
        return np.concatenate([a for a, _ in out]), np.concatenate([b for _, b in out])


def dense_centres(sample: np.ndarray, rows: int, least: float, leaf: int) -> np.ndarray:
    """Centres of groups that the trees would cut: every dense row of the sample is near one, the densest come first."""
    if rows <= leaf:
        return sample[:0]
    low = sample.astype(np.float32)
    links = np.concatenate([[0], *[(low[i : i + 256] @ low.T >= least).sum(axis=1) - 1 for i in range(0, len(low), 256)]])[1:]
    bound = max(_LEAST_DENSE, DENSE_SHARE * leaf * len(sample) / rows)
    open_rows, centres = links >= bound, []
    while open_rows.any():
        first = int(np.argmax(np.where(open_rows, links, -1)))
        centre = sample[sample @ sample[first] >= least - 1e-6].mean(axis=0)
        centre /= np.sqrt((centre**2).sum())
        if centre @ sample[first] < CORE:
            centre = sample[first]
        centres.append(centre)
        open_rows &= sample @ centre < CORE
        open_rows[first] = False
    return np.array(centres).reshape(-1, sample.shape[1])


def gather(rows: np.ndarray, centres: np.ndarray, least: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Each row's own group or -1, and pairs of row number and group to which the row is sent besides.

    A row's own group has the nearest centre, if its cosine reaches CORE. By the triangle inequality of angles all that
    links to a row of a group lies within the two angles' sum of the centre, and is sent there; a row that has a group
    itself only to groups before it, so that two groups' rows meet once.
    """
    own = np.full(len(rows), -1)
    reach = CORE * least - np.sqrt((1 - CORE**2) * (1 - least**2)) - 1e-9
    near, to = [np.zeros(0, int)], [np.zeros(0, int)]
    step = max(1, (1 << 21) // max(1, len(centres)))
    for start in range(0, len(rows) if len(centres) else 0, step):
        cosine = rows[start : start + step] @ centres.T
        best = cosine.argmax(axis=1)
        own[start : start + step] = np.where(cosine.max(axis=1) >= CORE, best, -1)
        i, j = np.nonzero(cosine >= reach)
        mine = own[start + i]
        sent = (mine < 0) | (j < mine)
        near.append(start + i[sent])
        to.append(j[sent])
    return own, np.concatenate(near), np.concatenate(to)


def unit(rows: np.ndarray) -> np.ndarray:
    """Rows of length one, in double precision."""
    rows = rows / np.abs(rows).max(axis=1, keepdims=True)
    return rows / np.sqrt((rows**2).sum(axis=1, keepdims=True))


def _dense(column: pa.Array, dim: int) -> np.ndarray:
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, dim)


def _pairs(x: np.ndarray, y: np.ndarray | None, least: float) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of rows whose cosine reaches least. Single precision decides unless it comes close."""
    near = x.astype(np.float32) @ (x if y is None else y).astype(np.float32).T
    i, j = np.nonzero(near >= least - 1e-4)
    if y is None:
        up = i < j
        i, j = i[up], j[up]
    sure = near[i, j] >= least + 1e-4
    for start in range(0, len(i), 1 << 16):
        part = slice(start, start + (1 << 16))
        doubt = np.flatnonzero(~sure[part]) + start
        sure[doubt] = (x[i[doubt]] * (x if y is None else y)[j[doubt]]).sum(axis=1) >= least
    return i[sure], j[sure]


def _met_before(tables: list[np.ndarray], i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Whether each pair of rows shares one of the leaves listed in the tables, one per tree, filled up with -1."""
    out = np.zeros(len(i), bool)
    for start in range(0, len(i), 1 << 18):
        part = slice(start, start + (1 << 18))
        for table in tables:
            for s in range(table.shape[1]):
                left = table[i[part], s]
                left[left < 0] = -2  # never the same as a filling on the other side
                for t in range(table.shape[1]):
                    out[part] |= left == table[j[part], t]
    return out


def _padded(lists: list[np.ndarray]) -> np.ndarray:
    out = np.full((len(lists), max([1, *map(len, lists)])), -1, np.int64)
    for k, x in enumerate(lists):
        out[k, : len(x)] = x
    return out


def _split_wide(work: Work, placed: DataFrame, trees: int, spill: float, leaf: int, seed: int, fresh: int, piece: int) -> DataFrame:
    """placed with every leaf of more than twice `leaf` rows split anew, by splits drawn from its own rows, until none is
    left that can be split; `leaves` then lists what each row is in.

    All wide leaves are split at once, about fresh / 32 parts a round, so the rounds are a logarithm of the rows. A leaf's
    draw is about `fresh` rows, chosen by a hash; its rows meet the splits in pieces. A leaf whose rows are mostly one
    group is not cut; like any large leaf it is compared block by block.
    """
    done: list[DataFrame] = []
    now, round_ = placed, 0
    one_leaf = ["dim", "leaf"]
    shape = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in placed.schema)
    while True:
        in_trees = now.where(F.col("leaf") < (trees << _TREE))
        wide = work.keep(in_trees.groupBy(*one_leaf).agg(F.count("*").alias("rows")).where(F.col("rows") > 2 * leaf), "wide")
        if wide.isEmpty():
            break
        round_ += 1
        drawn = split_join(now, wide, one_leaf).where(F.pmod(F.xxhash64("r", F.lit(round_)), "rows") < fresh).select("dim", "leaf", "rows", "embedding")

        def draw(found: pd.DataFrame) -> pd.DataFrame:
            dim, at, rows = int(found["dim"].iloc[0]), int(found["leaf"].iloc[0]), int(found["rows"].iloc[0])
            tree = Tree(unit(np.stack(found["embedding"].to_list()).astype(np.float64)), rows, (seed, dim, at), spill, leaf)
            low, high = zip(*tree.splits.values(), strict=True) if tree.splits else ((), ())
            return pd.DataFrame({"dim": [dim], "leaf": [at], "rows": [rows], "nodes": [list(tree.splits)], "low": [list(low)], "high": [list(high)]})

        cuts = drawn.groupBy(*one_leaf).applyInPandas(draw, "dim int, leaf long, rows long, nodes array<long>, low array<double>, high array<double>")
        cuts = work.keep(cuts.where("size(nodes) > 0"), "cuts")
        if cuts.isEmpty():
            break
        done.append(now.join(cuts.select(*one_leaf), one_leaf, "left_anti"))
        pieces = F.ceil(F.col("rows") / piece).cast("int")
        each = cuts.withColumn("piece", F.explode(F.sequence(F.lit(0), pieces - 1)))
        sent = split_join(now, cuts.select(*one_leaf, pieces.alias("pieces")), one_leaf).withColumn("piece", F.pmod(F.xxhash64("r"), "pieces").cast("int"))

        def send(found: pd.DataFrame, cut: pd.DataFrame) -> pd.DataFrame:
            if not len(found) or not len(cut):
                return found.drop(columns=["pieces", "piece"], errors="ignore").iloc[:0]
            dim, at = int(found["dim"].iloc[0]), int(found["leaf"].iloc[0])
            splits = {int(n): (a, b) for n, a, b in zip(cut["nodes"].iloc[0], cut["low"].iloc[0], cut["high"].iloc[0], strict=True)}
            row, to = Tree.of(splits, dim, (seed, dim, at)).descend(unit(np.stack(found["embedding"].to_list()).astype(np.float64)))
            out = found.iloc[row].drop(columns=["pieces", "piece"])
            under = mix64(np.uint64(at) * np.uint64(1 << 20) + to.astype(np.uint64)) & np.uint64((1 << _TREE) - 1)
            out["leaf"] = (at >> _TREE << _TREE) + under.astype(np.int64)
            return out

        key = [*one_leaf, "piece"]
        now = work.keep(sent.groupBy(*key).cogroup(each.groupBy(*key)).applyInPandas(send, shape), "split")
    if not done:
        return placed
    every = work.keep(reduce(DataFrame.unionByName, [*done, now]).drop("leaves"), "placed")
    lists = every.where(F.col("leaf") < (trees << _TREE)).groupBy("r").agg(F.sort_array(F.collect_list("leaf")).alias("leaves"))
    none = F.array().cast("array<bigint>")
    return work.keep(every.join(lists, "r", "left").withColumn("leaves", F.coalesce("leaves", none)).select(placed.columns), "leaves")


def near_vectors(work: Work, vectors: DataFrame, least: float = COSINE, trees: int = TREES, spill: float = SPILL, leaf: int = LEAF, fit_rows: int = FIT_ROWS, block: int = BLOCK, seed: int = 9, fresh: int = FRESH, piece: int = PIECE) -> DataFrame:
    """Per row of vectors (vec_id, embedding): vec_id, n_links, component_id, kept.

    Rows with equal vectors are one class, which counts as often as it has rows. The trees' cuts come from at most
    fit_rows classes, chosen by a hash. Where that sample is dense, any cut would part links, so a dense group's classes
    go down no tree: they are compared with each other and with all classes that can link to them, so all their links
    are found. Every other class goes down every tree; leaves that are still wide are split again from rows of their own
    (`_split_wide`), so a leaf's rows do not grow with the input. Classes of a leaf are compared with each other, so a pair is
    found if any tree leaves it together. A pair counts in the first of the leaves that it shares: rows carry their
    leaves of all trees, so links are counted without being listed. Groups and leaves hand on counts per row and a star
    of edges per group of linked rows; these stars are joined up.

    Null vec_id: no links, component_id null, kept. A vector that is null, empty, zero or holds a null or non-finite
    component: no links, a component of its own. Vectors of different lengths never link. Rows that repeat a vec_id
    are vectors of their own, each counts its links, and they belong to one component. No rows: no rows.
    """
    rows = work.keep(vectors.select("vec_id", "embedding", F.monotonically_increasing_id().alias("r")), "rows")
    good = rows.where(F.col("vec_id").isNotNull() & usable(F.col("embedding"))).withColumn("dim", F.size("embedding"))
    good = good.withColumns({"e1": F.xxhash64("embedding"), "e2": F.xxhash64(F.lit(9), "embedding")})
    whole = good
    good = good.groupBy("dim", "e1", "e2").agg(
        F.first("embedding").alias("embedding"), F.count("*").alias("w"), F.min("vec_id").alias("vec_id"), F.min("r").alias("r")
    )
    good = work.keep(good, "classes")
    sizes = {r["dim"]: r["n"] for r in good.groupBy("dim").agg(F.count("*").alias("n")).collect()}
    drawn = good.orderBy(F.xxhash64("vec_id", "r")).limit(fit_rows).select("dim", "embedding").toArrow()
    forests: dict[int, list[Tree]] = {}
    centres: dict[int, np.ndarray] = {}
    for dim, n in sizes.items():
        own = drawn.filter(pa.compute.equal(drawn["dim"], dim))["embedding"].combine_chunks()
        sample = unit(_dense(own, dim)) if len(own) else np.zeros((0, dim))
        centres[dim] = dense_centres(sample, n, least, leaf)
        rest = sample[gather(sample, centres[dim], least)[0] < 0]
        forests[dim] = [Tree(rest, n * len(rest) / max(1, len(sample)), (seed, dim, t), spill, leaf) for t in range(trees)]

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            dims = batch.column("dim").to_numpy(zero_copy_only=False)
            for dim in np.unique(dims).tolist():
                own = batch.filter(pa.array(dims == dim))
                x = unit(_dense(own.column("embedding"), dim))
                group, near, to = gather(x, centres[dim], least)
                core, free = np.flatnonzero(group >= 0), np.flatnonzero(group < 0)
                at = [tree.descend(x[free]) for tree in forests[dim]]
                row = np.concatenate([free[a] for a, _ in at])
                spot = np.concatenate([(t << _TREE) + b.astype(np.int64) for t, (_, b) in enumerate(at)])
                order = np.lexsort((spot, row))
                row, spot = row[order], spot[order]
                bounds = np.concatenate([[0], np.cumsum(np.bincount(row, minlength=len(x)))])
                spots = pa.ListArray.from_arrays(pa.array(bounds.astype(np.int32)), pa.array(spot.astype(np.int64)))
                guest = np.repeat([False, True], [len(row) + len(core), len(near)])
                spot = np.concatenate([spot, (trees << _TREE) + group[core], (trees << _TREE) + to])
                back = pa.array(np.concatenate([row, core, near]))
                yield pa.RecordBatch.from_arrays(
                    [*[own.column(c).take(back) for c in ("r", "vec_id", "w", "embedding", "dim")], pa.array(spot.astype(np.int64)), spots.take(back), pa.array(guest)],
                    names=["r", "vec_id", "w", "embedding", "dim", "leaf", "leaves", "guest"],
                )

    kinds = {f.name: f.dataType.simpleString() for f in good.schema}
    shape = f"r long, vec_id {kinds['vec_id']}, w long, embedding {kinds['embedding']}, dim int, leaf long, leaves array<long>, guest boolean"
    placed = work.keep(good.select("r", "vec_id", "w", "embedding", "dim").mapInArrow(place, shape), "leaves")
    placed = _split_wide(work, placed, trees, spill, leaf, seed, fresh, piece)
    # Own rows have the first nb blocks, guests the ng after them; guests of a group are not compared with each other.
    number = [F.ceil(F.count_if(kind) / block).cast("int").alias(name) for kind, name in ((~F.col("guest"), "nb"), (F.col("guest"), "ng"))]
    blocks = placed.groupBy("dim", "leaf").agg(*number).where("nb > 0")
    spread = F.xxhash64("r")
    units = split_join(placed, blocks, ["dim", "leaf"])
    units = units.withColumn("b", F.when(F.col("guest"), F.col("nb") + F.pmod(spread, F.greatest("ng", F.lit(1)))).otherwise(F.pmod(spread, F.greatest("nb", F.lit(1)))).cast("int"))
    units = units.withColumn("o", F.explode(F.sequence(F.lit(0), F.col("nb") + F.when(F.col("guest"), 0).otherwise(F.col("ng")) - 1)))
    units = units.select("dim", "leaf", F.least("b", "o").alias("bi"), F.greatest("b", "o").alias("bj"), "b", "r", "vec_id", "w", "embedding", "leaves")

    def compare(found: pd.DataFrame) -> pd.DataFrame:
        leaf = int(found["leaf"].iloc[0])
        first = (found["b"] == found["bi"]).to_numpy()
        x = unit(np.stack(found["embedding"].to_list()).astype(np.float64))
        lists = [np.asarray(v) for v in found["leaves"]]
        earlier = [_padded([v[(v >> _TREE == t) & (v < leaf)] for v in lists]) for t in range((leaf >> _TREE) + 1)]
        if found["bi"].iloc[0] == found["bj"].iloc[0]:
            i, j = _pairs(x, None, least)
        else:
            one, two = np.flatnonzero(first), np.flatnonzero(~first)
            i, j = _pairs(x[one], x[two], least)
            i, j = one[i], two[j]
        new = ~_met_before(earlier, i, j)
        w = found["w"].to_numpy()
        n = np.zeros(len(x), np.int64)
        np.add.at(n, i[new], w[j[new]])
        np.add.at(n, j[new], w[i[new]])
        ids = found["vec_id"].to_numpy()
        order = np.argsort(ids, kind="stable")  # so that a group is named by its smallest id
        back = np.empty(len(ids), int)
        back[order] = np.arange(len(ids))
        label = ids[order[local_components(len(ids), back[i], back[j])[back]]]
        out = pd.DataFrame({"r": found["r"], "vec_id": ids, "n": n, "low": label})
        return out[(out["n"] > 0) | (out["vec_id"] != out["low"])]

    links = units.groupBy("dim", "leaf", "bi", "bj").applyInPandas(compare, f"r long, vec_id {kinds['vec_id']}, n long, low {kinds['vec_id']}")
    links = work.keep(links, "links")
    member = work.keep(whole.select("r", "vec_id", "e1", "e2", "dim").join(good.select("dim", "e1", "e2", "w", F.col("vec_id").alias("low"), F.col("r").alias("first")), ["dim", "e1", "e2"]), "members")
    edges = links.select(F.col("vec_id").alias("a"), F.col("low").alias("b")).unionByName(member.select(F.col("vec_id").alias("a"), F.col("low").alias("b")))
    joined = components(work, edges)
    counts = links.groupBy(F.col("r").alias("first")).agg(F.sum("n").alias("n"))
    counts = member.join(counts, "first", "left").select("r", (F.coalesce("n", F.lit(0)) + F.col("w") - 1).alias("n_links"))
    out = rows.select("r", "vec_id").join(counts, "r", "left").join(joined.withColumnRenamed("node", "vec_id"), "vec_id", "left")
    component = F.coalesce("component", "vec_id")
    return out.select(
        "vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), component.alias("component_id"),
        F.coalesce(F.col("vec_id") == component, F.lit(True)).alias("kept"),
    )
