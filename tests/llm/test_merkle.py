"""The Merkle manifest against a tree built node by node, and tampering."""

import hashlib
import random
import zlib

import pytest
from pyspark.sql import functions as F

from carelens.llm import merkle

SHAPE = "doc_id long, source string, lang string, n_chars long, text string, place long, node string, `a.b` string"


def sha(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf(row):
    doc_id, source, lang, n_chars, text = row
    return sha(*("-" if v is None else f"{len(str(v).encode())}:{v}" for v in (doc_id, source, lang, n_chars, text)))


def levels(nodes):
    """All levels of one tree and, per leaf, the siblings on its way."""
    ways = [[] for _ in nodes]
    at = list(range(len(nodes)))
    while len(nodes) > 1:
        for way, i in zip(ways, range(len(ways)), strict=True):
            k = at[i]
            other = k ^ 1
            way.append((k % 2, nodes[other] if other < len(nodes) else ""))
            at[i] = k // 2
        nodes = [sha(*nodes[i : i + 2]) for i in range(0, len(nodes), 2)]
    return nodes[0], ways


def brute(rows):
    by_lang = {}
    for row in rows:
        by_lang.setdefault(row[2], []).append(row)
    langs = sorted(by_lang, key=lambda x: (x is not None, (x or "").encode()))
    trees = {}
    for lang in langs:
        mine = sorted(by_lang[lang], key=lambda r: (r[0] is not None, r[0] or 0, leaf(r)))
        trees[lang] = (mine, *levels([leaf(r) for r in mine]))
    if not langs:
        return []
    root, upper = levels([trees[x][1] for x in langs])
    out = []
    for lang, above in zip(langs, upper, strict=True):
        mine, subroot, ways = trees[lang]
        for row, way in zip(mine, ways, strict=True):
            shown = row
            if row[0] is not None and zlib.crc32(str(row[0]).encode()) % 7 == 0 and row[3] is not None:
                shown = (*row[:3], row[3] + 1, row[4])
            node = leaf(shown)
            for slot, other in way + above:
                node = sha(other, node) if slot else sha(node, other)
            out.append((row[0], leaf(row), subroot, root, sha(*(o for _, o in way + above)), node, node == root))
    return out


def run(spark, work, rows, bits):
    docs = spark.createDataFrame([(*r, 5, "n", "x") for r in rows], SHAPE).repartition(3)
    tampered = F.crc32(F.col("doc_id").cast("string")) % 7 == 0
    out = merkle.manifest(work, docs, tampered, bits)
    return [tuple(r) for r in out.select("doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified").collect()]


def table(n, langs, seed):
    rng = random.Random(seed)
    return [(i, rng.choice(["a", None, "ü"]), rng.choice(langs), rng.choice([None, 3, -4]), rng.choice(["", None, "é" * 3, f"t{i}", "x" * 5000])) for i in range(n)]


@pytest.mark.parametrize(("bits", "n"), [(1, 9), (2, 17), (10, 1), (10, 2), (10, 23)])
def test_small_trees(spark, work, bits, n):
    rows = table(n, ["de", None, "en"], n)
    assert sorted(run(spark, work, rows, bits), key=repr) == sorted(brute(rows), key=repr)


@pytest.mark.parametrize("bits", [2, 4])
def test_hot_group_repeats_and_nulls(spark, work, bits):
    rows = table(60, ["de"] * 8 + [None, "", "-", "é"], 5)
    rows += [rows[3]] * 9 + [(None, None, None, None, None)] * 2 + [(7, "s", "de", 9223372036854775807, "other text")]
    assert sorted(run(spark, work, rows, bits), key=repr) == sorted(brute(rows), key=repr)


def test_many_langs(spark, work):
    rows = [(i, "s", f"l{i:03d}", i, "t") for i in range(40)]
    assert sorted(run(spark, work, rows, 2)) == sorted(brute(rows))


def test_no_rows(spark, work):
    assert run(spark, work, [], 2) == []


def test_only_tampered_rows_fail(spark, work):
    rows = [(i, "s", "de", i, "t") for i in range(50)]
    failed = {r[0] for r in run(spark, work, rows, 3) if not r[6]}
    assert failed == {i for i in range(50) if zlib.crc32(str(i).encode()) % 7 == 0} and failed
