"""Helpers: components, whole groups, flat texts, rolling hashes."""

import os
import pathlib
import random
import time

import numpy as np
import pyarrow as pa
import pytest

from carelens.llm import common


def brute(edges):
    low = {}
    for a, b in edges:
        low.setdefault(a, a)
        low.setdefault(b, b)
    moved = True
    while moved:
        moved = False
        for a, b in edges:
            least = min(low[a], low[b])
            moved |= low[a] != least or low[b] != least
            low[a] = low[b] = least
    linked = {x for a, b in edges if a != b for x in (a, b)}
    return {k: v for k, v in low.items() if k in linked}


@pytest.mark.parametrize("seed", range(3))
def test_components(spark, work, seed):
    rng = random.Random(seed)
    shapes = [
        [(i, i + 1) for i in range(60)],  # a chain
        [(100, 200 + i) for i in range(300)],  # a star around one node
        [(rng.randrange(1000, 1100), rng.randrange(1000, 1100)) for _ in range(70)],
        [(5000, 5000), (6000, 6001), (6001, 6000)],
    ]
    edges = [e if rng.random() < 0.5 else e[::-1] for shape in shapes for e in shape]
    rng.shuffle(edges)
    got = common.components(work, spark.createDataFrame(edges, "a long, b long")).collect()
    assert {r.node: r.component for r in got} == brute(edges) and len(got) == len(brute(edges))


def test_components_of_nothing(spark, work):
    assert common.components(work, spark.createDataFrame([], "a long, b long")).count() == 0


def test_local_components():
    rng = np.random.default_rng(0)
    a, b = rng.integers(0, 200, (2, 150))
    want = brute(list(zip(a.tolist(), b.tolist(), strict=True)))
    label = common.local_components(200, a, b)
    assert all(label[i] == want.get(i, i) for i in range(200))


@pytest.mark.parametrize("limit", [1, 200, 10_000])
def test_whole_groups_cuts_between_groups(limit):
    rng = np.random.default_rng(1)
    key = np.sort(rng.integers(0, 30, 400))
    table = pa.table({"k": key, "l": key // 3, "x": np.arange(400)})
    batches = table.to_batches(max_chunksize=7)
    seen, rows = set(), []
    for part, at in common.whole_groups(iter(batches), ["k", "l"], limit):
        got = part["k"].to_numpy()
        assert at[-1] == len(got) and not seen & set(got)
        seen |= set(got)
        for a, b in zip(at, at[1:], strict=False):
            assert len(set(got[a:b])) == 1
        assert len(at) - 1 == len(set(got))
        rows += part["x"].to_pylist()
    assert rows == list(range(400))
    assert list(common.whole_groups(iter([]), ["k"], 5)) == []


def test_flat_texts_with_nulls_and_slices():
    column = pa.array(["ab", None, "", "é"])
    for part, want in ((column, [b"ab", b"", b"", "é".encode()]), (column.slice(1, 3), [b"", b"", "é".encode()]), (column.slice(4), [])):
        for kind in (part, part.cast(pa.large_string())):
            data, at = common.flat(kind)
            assert [data[a:b].tobytes() for a, b in zip(at, at[1:], strict=False)] == want


def test_steps_cover_all_rows():
    offsets = np.array([0, 5, 5, 900, 901, 902, 2000, 2000])
    for limit in (1, 10, 100, 5000):
        got = list(common.steps(offsets, limit))
        assert [i for i, _ in got] == [0, *[j for _, j in got[:-1]]] and got[-1][1] == 7
        assert all(j - i == 1 or offsets[j] - offsets[i] <= limit for i, j in got)


def test_equal_stretches_hash_alike():
    data = np.frombuffer(b"abcabcxabc" * 300, np.uint8)
    roll = common.Rolling(256, 1)
    sums = roll.sums(data)
    start = np.arange(0, 2990)
    found = roll.of(sums, start, start + 3)
    strings = [data[i : i + 3].tobytes() for i in start]
    assert len(set(found.tolist())) == len(set(strings)) == len(set(zip(found.tolist(), strings, strict=True)))


def test_a_cluster_needs_a_shared_folder(spark, monkeypatch):
    class Conf:
        def get(self, key, default=None):
            return default

    class Session:
        conf = Conf()

        class sparkContext:
            master = "spark://host:7077"

    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        common.shared_dir(Session())
    Session.sparkContext.master = "local-cluster[2,1,1024]"
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        common.shared_dir(Session())


def test_sweep_removes_old_work_tables_only(spark):
    old, new = common.Work(spark, "swept"), common.Work(spark, "swept")
    kept = old.keep(spark.range(3), "t"), new.keep(spark.range(4), "t")
    folder = common.shared_dir(spark).removeprefix("file://")
    other = pathlib.Path(folder, "not-a-work-folder")
    other.mkdir(exist_ok=True)
    past = time.time() - 7200
    for path in [pathlib.Path(old.root.removeprefix("file://")), *pathlib.Path(old.root.removeprefix("file://")).iterdir(), other]:
        os.utime(path, (past, past))
    gone = common.sweep(spark, 1.5)
    assert old.root.rsplit("/", 1)[1] in gone and new.root.rsplit("/", 1)[1] not in gone
    assert kept[1].count() == 4 and other.exists() and not pathlib.Path(old.root.removeprefix("file://")).exists()
