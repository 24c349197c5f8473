"""Nearest neighbours against brute force, the forest's links against all pairs."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from carelens.llm import forest, vectors
from carelens.llm.queries import QUERIES

SF = "/root/testdata/sf0.01"


def brute_nearest(rows, k, by):
    good = [(i, np.array(v, float)) for i, v in rows if i is not None and v and None not in v and np.isfinite(np.array(v, float)).all() and np.any(v)]
    out = []
    for q, x in good:
        if q % by == 0:
            far = sorted((float(np.sqrt(((x - y) ** 2).sum())), i) for i, y in good if i != q and len(y) == len(x))
            out += [(q, r + 1, i, d) for r, (d, i) in enumerate(far[:k])]
    return out


def same(got, want):
    got, want = sorted(got), sorted(want)
    assert [g[:3] for g in got] == [w[:3] for w in want]
    assert np.allclose([g[3] for g in got], [w[3] for w in want], rtol=1e-12, atol=0)


ODD = [
    (0, [1.0, 0.0, 0.0]), (1, [1.0, 0.0, 0.0]), (2, [0.0, 1.0, 0.0]), (3, [0.0, 0.0, 0.0]), (4, None), (5, [1.0, None, 0.0]), (6, [float("nan"), 1.0, 0.0]),
    (7, [float("inf"), 1.0, 0.0]), (8, []), (None, [1.0, 0.0, 0.0]), (10, [1.0, 0.1, 0.0]), (20, [1.0, 2.0]), (30, [2.0, 1.0]), (11, [1e-30, 0.0, 0.0]), (12, [0.0, 1.0, 0.0]),
    (13, [1.0, 0.0, 0.0]),
]
SHAPE = "vec_id long, embedding array<float>, label int, score double, rank int"


def odd(spark, rows=ODD):
    return spark.createDataFrame([(i, v, 1, 0.5, 3) for i, v in rows], SHAPE)


@pytest.mark.parametrize("blocks", [(2048, 16384), (2, 3)])
def test_nearest_of_odd_rows(spark, work, blocks):
    out = vectors.nearest(work, odd(spark), F.col("vec_id") % 10 == 0, 4, *blocks)
    floats = [(i, None if v is None else [None if x is None else float(np.float32(x)) for x in v]) for i, v in ODD]
    same([tuple(r) for r in out.collect()], brute_nearest(floats, 4, 10))
    assert vectors.nearest(work, odd(spark).where("false"), F.col("vec_id") % 10 == 0).count() == 0


def test_nearest_in_many_blocks(spark, work):
    table = spark.read.parquet(f"{SF}/embeddings.parquet")
    rows = [(r.vec_id, r.embedding) for r in table.collect()]
    out = vectors.nearest(work, table, F.col("vec_id") % 20 == 0, 10, 7, 60)
    same([tuple(r) for r in out.collect()], brute_nearest(rows, 10, 20))


def test_bounds_hold():
    rng = np.random.default_rng(1)
    for scale in (1e-20, 1.0, 1e15):
        x, y = rng.standard_normal((40, 64)) * scale, rng.standard_normal((50, 64)) * scale * 3
        low, high = vectors.Quantised(x).distances(vectors.Quantised(y), slice(None), slice(None))
        true = np.sqrt(((x[:, None] - y[None]) ** 2).sum(axis=2))
        assert (low <= true).all() and (true <= high).all()


def brute_links(rows, least):
    out = {}
    x = [(i, np.array(v, float)) if i is not None and v and None not in v and np.isfinite(np.array(v, float)).all() and np.any(v) else (i, None) for i, v in rows]
    link = [[k for k, (j, b) in enumerate(x) if k != m and a is not None and b is not None and len(a) == len(b) and a @ b / np.sqrt((a @ a) * (b @ b)) >= least] for m, (i, a) in enumerate(x)]
    low = {i: i for i, _ in x if i is not None}
    for _ in range(len(x)):
        for m, others in enumerate(link):
            for k in others:
                a, b = x[m][0], x[k][0]
                low[a] = low[b] = min(low[a], low[b])
    for m, (i, _) in enumerate(x):
        out.setdefault(i, []).append((len(link[m]), low.get(i), i is None or low[i] == i))
    return sorted((repr(i), v) for i, vs in out.items() for v in vs)


def got_links(df):
    return sorted((repr(r.vec_id), (r.n_links, r.component_id, r.kept)) for r in df.select("vec_id", "n_links", "component_id", "kept").collect())


@pytest.mark.parametrize("sizes", [(1024, 2048), (4, 3)])
def test_links_of_odd_rows(spark, work, sizes):
    rows = ODD + [(1, [1.0, 0.05, 0.0]), (0, [1.0, 0.0, 0.0])]
    floats = [(i, None if v is None else [None if x is None else float(np.float32(x)) for x in v]) for i, v in rows]
    got = got_links(forest.near_vectors(work, odd(spark, rows), leaf=sizes[0], block=sizes[1]))
    assert got == brute_links(floats, 0.9)
    assert forest.near_vectors(work, odd(spark).where("false")).count() == 0


def test_links_against_all_pairs(spark):
    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{SF}/embeddings.parquet").collect()]
    assert got_links(QUERIES["op9_near_vectors"](spark, SF)) == brute_links(rows, 0.9)


def test_a_deep_forest_finds_the_links(spark, work):
    """Small leaves and blocks: of the links at any cosine from 0.9, hardly one is missed, none is made up."""
    rng = np.random.default_rng(4)
    base = rng.standard_normal((300, 64))
    x = np.concatenate([base, base[:150] + rng.standard_normal((150, 64)) * 0.45, np.repeat(base[:1], 60, 0) + rng.standard_normal((60, 64)) * 0.1])
    table = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<double>")
    got = forest.near_vectors(work, table, leaf=40, block=30)
    unit = x / np.linalg.norm(x, axis=1, keepdims=True)
    true = (unit @ unit.T >= 0.9).sum(axis=1) - 1
    mine = np.array([r.n_links for r in got.orderBy("vec_id").collect()])
    assert (mine <= true).all() and mine.sum() >= 0.99 * true.sum()


def near_group(rng, n, spread, dim=64):
    """Rows around one centre; at spread 0.23 two of them have a cosine of about 0.95, at 0.34 of about 0.9."""
    centre = rng.standard_normal(dim)
    noise = rng.standard_normal((n, dim)) / np.sqrt(dim)
    return centre / np.linalg.norm(centre) + noise * spread


@pytest.mark.parametrize("spreads", [(0.23,), (0.34,), (0.23, 0.34, 0.28)])
def test_a_near_group_of_several_leaves_keeps_all_its_links(spark, work, spreads):
    """Groups of alike but unequal vectors, each far larger than a leaf, among others: no link is lost, none counts twice."""
    rng = np.random.default_rng(5)
    x = np.concatenate([rng.standard_normal((1500, 64)), *[near_group(rng, 700, s) for s in spreads]])
    table = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<double>")
    got = forest.near_vectors(work, table, leaf=100, block=90).orderBy("vec_id").collect()
    unit = x / np.linalg.norm(x, axis=1, keepdims=True)
    link = unit @ unit.T >= 0.9
    assert [r.n_links for r in got] == (link.sum(axis=1) - 1).tolist()
    i, j = np.nonzero(np.triu(link, 1))
    label = forest.local_components(len(x), i, j)
    assert [r.component_id for r in got] == label.tolist()


def test_groups_whose_rows_reach_into_each_other(spark, work):
    """A dense arc, longer than any link: its groups overlap, every pair still counts once."""
    angle = np.random.default_rng(6).uniform(0, 2, 1500)
    x = np.stack([np.cos(angle), np.sin(angle), np.full(1500, 0.1)], axis=1)
    table = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<double>")
    got = forest.near_vectors(work, table, leaf=60, block=100, fit_rows=400).orderBy("vec_id").collect()
    unit = x / np.linalg.norm(x, axis=1, keepdims=True)
    assert [r.n_links for r in got] == ((unit @ unit.T >= 0.9).sum(axis=1) - 1).tolist()


def test_leaves_stay_small_whatever_the_sample(spark, work):
    """8,000 rows, splits from 100 of them: leaves are split again from rows of their own, and links still found."""
    rng = np.random.default_rng(12)
    centres = rng.standard_normal((400, 64))
    x = np.repeat(centres, 20, axis=0) + 0.2 * rng.standard_normal((8000, 64))
    table = spark.createDataFrame([(i, v) for i, v in enumerate(x.tolist())], "vec_id long, embedding array<double>")
    given = dict(leaf=64, block=50, fit_rows=100, fresh=300, piece=200)
    seen = {}

    def watched(*args, plain=forest._split_wide):
        found = plain(*args)
        seen["sizes"] = [[r["n"] for r in df.groupBy("leaf").count().withColumnRenamed("count", "n").collect()] for df in (args[1], found)]
        seen["lists"] = found.select("r", "leaf", "leaves").collect()
        return found

    with pytest.MonkeyPatch.context() as patch:
        patch.setattr(forest, "_split_wide", watched)
        got = forest.near_vectors(work, table, **given).orderBy("vec_id").collect()
    before, after = seen["sizes"]
    assert max(before) > 1000 and max(after) <= 128
    assert all(r.leaf in r.leaves and r.leaves == sorted(set(r.leaves)) for r in seen["lists"])
    y = x / np.sqrt((x**2).sum(axis=1, keepdims=True))
    near = y @ y.T >= 0.9
    np.fill_diagonal(near, False)
    n = np.array([r.n_links for r in got])
    assert (n <= near.sum(axis=1)).all() and n.sum() >= 0.99 * near.sum()


def test_a_wide_leaf_of_one_group_stays_whole(spark, work):
    """A near group that the sample misses is not cut where most of a leaf is its rows."""
    rng = np.random.default_rng(3)
    x = np.concatenate([rng.standard_normal((600, 64)), near_group(rng, 500, 0.1)])
    table = spark.createDataFrame([(i, v) for i, v in enumerate(x.tolist())], "vec_id long, embedding array<double>")
    got = forest.near_vectors(work, table, leaf=32, block=60, fit_rows=12, fresh=200, piece=100).orderBy("vec_id").collect()
    y = x / np.sqrt((x**2).sum(axis=1, keepdims=True))
    near = y @ y.T >= 0.9
    np.fill_diagonal(near, False)
    n = np.array([r.n_links for r in got])
    assert (n <= near.sum(axis=1)).all() and n.sum() >= 0.99 * near.sum()
