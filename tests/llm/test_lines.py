"""Line dedup against a plain count of keys, and an index that documents come into and leave."""

import random
import re
from collections import Counter

import numpy as np
import pytest

from carelens.llm import lines

SPACE = " \t\n\x0b\x0c\r"


def key(line):
    return re.sub("[A-Z]", lambda m: m[0].lower(), line.strip(SPACE))


def brute(texts, least):
    """(lines, dropped, kept text) per text."""
    split = [(t or "").split("\n") for t in texts]
    seen = Counter(k for ls in split for k in {key(x) for x in ls} if k)
    out = []
    for ls in split:
        stay = [x for x in ls if seen[key(x)] < least or not key(x)]
        out.append((len(ls), len(ls) - len(stay), "\n".join(stay)))
    return out


def some_texts(seed, n=60):
    rng = random.Random(seed)
    common = ["Released under a license.", "  RELEASED under a license.\t", "\x0bé", "É", "", "  ", "x", "a\rb", "menu", "MENU \r"]
    out = [None, "", "\n", "\n\n", "x", "x\nx", "\nx\n"]
    out += ["\n".join(rng.choice(common) if rng.random() < 0.5 else str(rng.random()) for _ in range(rng.randint(0, 6))) for _ in range(n)]
    return out


def got(df):
    return sorted((repr(r.doc.doc_id), r.n_lines, r.n_dropped, r.kept) for r in df.collect())


@pytest.mark.parametrize(("seed", "least"), [(1, 10), (2, 2), (3, 1)])
def test_against_counts(work, frame, seed, least):
    texts = some_texts(seed)
    texts += texts[-5:]
    docs = frame([(i % 50 or None, t, None) for i, t in enumerate(texts)])
    want = sorted((repr(i % 50 or None), *w) for i, w in enumerate(brute(texts, least)))
    assert got(lines.line_dedup(work, docs, least, shards=3)) == want


def test_empty(work, frame):
    assert lines.line_dedup(work, frame([(1, "x", None)]).where("false")).count() == 0


def test_deleting_undoes_inserting(work, frame):
    first, second = some_texts(4), some_texts(5)
    one = frame([(i, t, None) for i, t in enumerate(first)])
    two = frame([(1000 + i, t, None) for i, t in enumerate(second)])
    index = lines.LineIndex(work, 20, shards=4)
    a, b = work.keep(lines.occurrences(one), "a"), work.keep(lines.occurrences(two), "b")
    index.insert(a)
    alone = {tuple(r) for r in index.frequent(a).collect()}
    index.insert(b)
    both = {tuple(r) for r in index.frequent(a.unionByName(b)).collect()}
    texts = got(lines.strip(one, a, index.frequent(a)))
    want = brute(first + second, 20)[: len(first)]
    assert texts == sorted((repr(i), *w) for i, w in enumerate(want))
    index.delete(b)
    assert {tuple(r) for r in index.frequent(a).collect()} == alone
    assert alone < both
    index.delete(a)
    assert index.counts.count() == 0 and index.frequent(a).count() == 0


def test_filter_holds_what_it_was_given():
    rng = np.random.default_rng(1)
    a, b = rng.integers(-(1 << 63), 1 << 63, (2, 5000))
    held = lines.CuckooFilter(64)
    held.add(a, b)
    assert len(held.tables) > 1
    held = lines.CuckooFilter.from_bytes(held.to_bytes())
    assert held.contains(a, b).all()
    other = rng.integers(-(1 << 63), 1 << 63, (2, 5000))
    assert held.contains(*other).sum() < 5
    held.remove(a[:2500], b[:2500])
    assert held.contains(a[2500:], b[2500:]).all() and held.contains(a[:2500], b[:2500]).sum() < 5
    held.add(a[:2500], b[:2500])
    assert held.contains(a, b).all()


def test_shards_grow_with_the_lines(work, frame, monkeypatch):
    """No shard is meant for more than SHARD_LINES lines, and the result does not depend on it."""
    made = []

    class Seen(lines.LineIndex):
        def __init__(self, work, min_docs, shards):
            made.append(shards)
            super().__init__(work, min_docs, shards)

    monkeypatch.setattr(lines, "LineIndex", Seen)
    monkeypatch.setattr(lines, "SHARD_LINES", 5, raising=False)
    texts = [f"common\nown {i}\nmore {i}\ncommon" for i in range(200)]
    out = lines.line_dedup(work, frame([(i, t, None) for i, t in enumerate(texts)]), 10).collect()
    assert sorted(r.kept for r in out) == sorted(t.replace("common\n", "").replace("\ncommon", "") for t in texts)
    assert made == [120]
