"""Mixing against water filling step by step, and what the mix holds."""

import hashlib
import re
from collections import Counter

from carelens.llm import mixing

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def targets(size):
    """source: target, by sharing again and again until none is above three times its size."""
    order = sorted(size, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(order)}
    full, left = {}, sum(size.values())
    while True:
        open_ = [s for s in order if s not in full]
        share = {s: left * weight[s] / sum(weight[x] for x in open_) for s in open_}
        over = [s for s in open_ if share[s] >= 3 * size[s]]
        if not over:
            return {**share, **full}
        for s in over:
            full[s] = 3 * size[s]
            left -= full[s]


def draw(doc_id, k):
    text = f"{k // 4}:{'null' if doc_id is None else doc_id}"
    return int(hashlib.md5(text.encode()).hexdigest()[8 * (k % 4) : 8 * (k % 4) + 8], 16)


def brute(rows):
    """Copies of each row (doc_id, text, lang, source, ...)."""
    sizes = [len(WORD.findall(r[1] or "")) for r in rows]
    size = Counter()
    for r, n in zip(rows, sizes, strict=True):
        size[r[3]] += n
    target = targets(size)
    rate = {s: target[s] / size[s] if size[s] else 0 for s in size}
    copies = [[int(rate[r[3]]) + (draw(r[0], k) < (rate[r[3]] - int(rate[r[3]])) * 2**32) for k in range(mixing.DRAWS)] for r in rows]
    best = {s: min(range(mixing.DRAWS), key=lambda k: (round(abs(sum(c[k] * n for c, n, r in zip(copies, sizes, rows, strict=True) if r[3] == s) - target[s]), 6), k)) for s in size}
    return [c[best[r[3]]] for c, r in zip(copies, rows, strict=True)]


def some_rows():
    rows = [(i, "w " * (i % 17 + 1), ["a", "b", "é", None, "Z"][i % 5] if i % 3 else "a") for i in range(400)]
    return rows + [(400, None, "a"), (401, "", "empty"), (None, "x y", "b"), (3, "again and again", "b"), (3, "again and again", "b"), (402, "\x0bx\xa0y z\n", "tiny")]


def test_plan_against_brute_force(work, frame):
    rows = some_rows()
    docs = frame(rows)
    full = [(i, t, "en", s) for i, t, s in rows]
    copies = brute(full)
    sizes = [len(WORD.findall(t or "")) for _, t, _ in rows]
    size = Counter()
    for (_, _, s), n in zip(rows, sizes, strict=True):
        size[s] += n
    target = targets(size)
    want = sorted((repr(i), s or "", n, size[s], round(target[s], 6), c * n) for (i, _, s), n, c in zip(rows, sizes, copies, strict=True))
    out = mixing.plan(work, docs).collect()
    assert sorted((repr(r.doc_id), r.source or "", r["size"], r.source_size, round(r.target, 6), r.taken) for r in out) == want
    assert abs(sum(target.values()) - sum(size.values())) < 1e-6
    taken = Counter()
    for r in out:
        taken[r.source] += r.taken
    assert all(abs(taken[s] - target[s]) <= 0.1 * target[s] + 20 for s in size)


def test_mix_repeats_whole_rows(work, frame):
    rows = some_rows()
    docs = frame(rows)
    copies = brute([(i, t, "en", s) for i, t, s in rows])
    got = Counter(map(tuple, mixing.mix(work, docs).collect()))
    want = Counter()
    for r, n in zip(docs.collect(), copies, strict=True):
        want[tuple(r)] += n
    assert got == +want
    assert mixing.mix(work, docs).columns == docs.columns


def test_edges(work, frame):
    assert mixing.plan(work, frame([(1, "x", None)]).where("false")).count() == 0
    lone = mixing.plan(work, frame([(1, "x y", None), (2, None, None)])).collect()
    assert sorted((r["size"], r.source_size, r.target, r.taken) for r in lone) == [(0, 2, 2.0, 0), (2, 2, 2.0, 2)]
    none = mixing.plan(work, frame([(1, None, "a"), (2, "", "b")])).collect()
    assert {(r["size"], r.target, r.taken) for r in none} == {(0, 0.0, 0)}
