"""Substring removal against a table of all strings, and the sorted runs it rests on."""

import hashlib
import random
from collections import Counter

import numpy as np
import pytest

from carelens.llm import substring, suffixes
from carelens.llm.queries import QUERIES


def brute(texts, length):
    """(bytes, removed, runs, digest of the rest) per text."""
    bodies = [(t or "").encode() for t in texts]
    seen = Counter(b[i : i + length] for b in bodies for i in range(len(b) - length + 1))
    out = []
    for b in bodies:
        gone = np.zeros(len(b) + 1, np.int64)
        for i in range(len(b) - length + 1):
            if seen[b[i : i + length]] > 1:
                gone[i] += 1
                gone[min(i + length, len(b))] -= 1
        gone = np.cumsum(gone)[:-1] > 0
        runs = int((np.diff(np.concatenate([[0], gone.astype(int)])) == 1).sum())
        kept = bytes(np.frombuffer(b, np.uint8)[~gone])
        out.append((len(b), int(gone.sum()), runs, hashlib.sha256(kept).hexdigest()))
    return out


def got(df):
    return sorted((repr(r.doc.doc_id), r.n_bytes, r.n_removed, r.n_spans, hashlib.sha256(r.kept).hexdigest()) for r in df.collect())


def test_the_query_against_brute_force(spark):
    sf = "/root/testdata/sf0.001"
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    want = sorted((i, *w) for (i, _), w in zip(rows, brute([t for _, t in rows], 400), strict=True))
    assert sorted(tuple(r) for r in QUERIES["op1_substring_dedup"](spark, sf).collect()) == want
    assert any(w[2] for w in want)


def family(seed):
    """Texts that share stretches just over and just under the least length, in many copies with edits, and periods."""
    rng = random.Random(seed)
    some = lambda n: "".join(rng.choice("ab é\n") for _ in range(n))
    base = some(300)
    out = [None, "", "ab", "a" * 200, "ab" * 150, "a" * 39, base, base, some(60) + base[50:89] + some(40), some(30) + base[50:90] + some(20)]
    for _ in range(25):
        words = list(base)
        for _ in range(rng.randint(1, 6)):
            words[rng.randrange(len(words))] = rng.choice("xyz")
        out.append("".join(words[rng.randint(0, 30) :]))
    for _ in range(10):
        a, n = rng.randrange(250), rng.randint(30, 120)
        out.append(some(rng.randint(0, 50)) + base[a : a + n] + some(rng.randint(0, 50)))
    rng.shuffle(out)
    return out


@pytest.mark.parametrize(("seed", "length", "sizes"), [(1, 40, {}), (2, 40, {"run_bytes": 3000, "range_bytes": 4000}), (3, 100, {"run_bytes": 500, "range_bytes": 900})])
def test_families_against_brute_force(work, frame, seed, length, sizes):
    texts = family(seed)
    docs = frame([(i % 7 or None, t, None) for i, t in enumerate(texts)])
    want = sorted((repr(i % 7 or None), *w) for i, w in enumerate(brute(texts, length)))
    assert got(substring.substring_dedup(work, docs, length, anchor=8, **sizes)) == want
    assert any(w[2] for w in want)


def test_many_ranges_against_brute_force(work, frame, monkeypatch):
    """Every string draws a bound, so ranges part strings that begin alike for more than the least length."""
    monkeypatch.setattr(substring, "_EVERY", 1)
    monkeypatch.setattr(substring, "BOUND_ROWS", 2)
    monkeypatch.setattr(suffixes, "PART_BYTES", 64)
    texts = family(4) + ["q" * n for n in range(35, 60)]
    seen = []
    with monkeypatch.context() as patch:
        patch.setattr(substring, "bounds_of", lambda *a, plain=substring.bounds_of: seen.append(plain(*a, 2)) or seen[-1])
        docs = frame([(i, t, None) for i, t in enumerate(texts)])
        want = sorted((repr(i), *w) for i, w in enumerate(brute(texts, 40)))
        assert got(substring.substring_dedup(work, docs, 40, anchor=8, run_bytes=400, range_bytes=60)) == want
    bounds = seen[0]
    assert len(bounds) > 50 and bounds == sorted(set(bounds)) and max(map(len, bounds)) > 40


@pytest.mark.parametrize("range_bytes", [1, 30, 1 << 20])
def test_strings_that_another_one_begins_with(spark, work, monkeypatch, range_bytes):
    monkeypatch.setattr(substring, "_EVERY", 1)
    rng = random.Random(range_bytes)
    strings = ["".join(rng.choice("ab") for _ in range(rng.randint(1, 9))) for _ in range(120)] + ["b" * n for n in range(10, 40)] + ["a" * 50] * 5
    rows = [(bytes(s, "ascii"), 1, i, 0, 0, 0, True) for i, s in enumerate(strings)]
    table = spark.createDataFrame(rows, "bytes binary, w long, k1 long, k2 long, x0 long, x1 long, own boolean").repartition(4)
    runs = work.keep(substring.sorted_runs(table, 300), "runs")
    met = {(r.run, r.entry) for r in substring.confirmed(work, runs, range_bytes).collect()}
    found = {r.k1 for r in runs.where("block IS NULL").collect() if r.sure or (r.run, r.entry) in met}
    assert found == {i for i, s in enumerate(strings) if any(k != i and t.startswith(s) for k, t in enumerate(strings))}


def test_a_packed_run_is_read_in_parts(monkeypatch):
    monkeypatch.setattr(suffixes, "PART_BYTES", 50)
    run = sorted(f"{i % 7}-{i}".encode() * 4 for i in range(200))
    entries = list(zip(range(200), suffixes.prefixes(run), run, strict=True))
    assert list(suffixes.decode(suffixes.encode(entries))) == entries and list(suffixes.decode(suffixes.encode([]))) == []


def test_empty(work, frame):
    docs = frame([(1, "x", None)])
    assert substring.substring_dedup(work, docs.where("false")).count() == 0
    assert got(substring.substring_dedup(work, docs)) == [("1", 1, 0, 0, hashlib.sha256(b"x").hexdigest())]


def test_long_texts_are_read_in_segments(monkeypatch):
    monkeypatch.setattr(substring, "_SEGMENT", 1000)
    rng = np.random.default_rng(2)
    data = rng.integers(97, 123, 5000).astype(np.uint8)
    covered = []
    for _, (owner, p, lo, hi, _) in substring._all_units(data, np.array([0, 5000]), 100, 8):
        assert not owner.any()
        covered += [x for a, b, c in zip(p, lo, hi, strict=True) for x in range(a - c, a - b + 1)]
    assert sorted(covered) == list(range(4901))


@pytest.mark.parametrize("seed", range(40))
def test_merge_knows_the_common_prefixes(seed):
    rng = random.Random(seed)
    runs = [sorted(bytes(rng.choice(b"ab") for _ in range(rng.randint(0, 40))) for _ in range(rng.randint(0, 9))) for _ in range(rng.randint(0, 9))]
    blocks = [suffixes.encode(list(zip(range(len(r)), suffixes.prefixes(r), r, strict=True))) for r in runs]
    merged = list(suffixes.merge([suffixes.decode(b) for b in blocks]))
    assert [m[3] for m in merged] == sorted(s for r in runs for s in r)
    assert all(runs[r][k] == s for r, k, _, s in merged)
    for before, after in zip(merged, merged[1:], strict=False):
        shared = after[2]
        assert before[3][:shared] == after[3][:shared] and before[3][shared : shared + 1] != after[3][shared : shared + 1] or shared == len(before[3]) == len(after[3])
