"""Near-duplicate documents against all pairs of full shingle sets."""

import random
import re

import numpy as np
import pyarrow as pa
import pytest

from carelens.llm import minhash
from carelens.llm.common import flat
from carelens.llm.queries import QUERIES

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def shingles(text):
    words = [w.translate({c: c + 32 for c in range(65, 91)}) for w in WORD.findall(text or "")]
    if len(words) < 5:
        return {tuple(words)} if words else set()
    return {tuple(words[i : i + 5]) for i in range(len(words) - 4)}


def brute(rows, percent=85):
    sets = [(i, shingles(t)) for i, t in rows]
    low = {i: i for i, _ in rows if i is not None}
    index = {}
    for k, (i, s) in enumerate(sets):
        for x in s if i is not None else ():
            index.setdefault(x, []).append(k)
    links = set()
    for k, (i, s) in enumerate(sets):
        shared = {}
        for x in s if i is not None else ():
            for m in index[x]:
                shared[m] = shared.get(m, 0) + 1
        links |= {(k, m) for m, n in shared.items() if m > k and 100 * n >= percent * (len(s) + len(sets[m][1]) - n)}
    moved = True
    while moved:
        moved = False
        for k, m in links:
            a, b = sets[k][0], sets[m][0]
            if low[a] != low[b]:
                low[a] = low[b] = min(low[a], low[b])
                moved = True
    return sorted((repr(i), len(s), low.get(i), i is None or low[i] == i) for i, s in sets)


def got(df):
    return sorted((repr(r.doc_id), r.n_shingles, r.component_id, r.kept) for r in df.select("doc_id", "n_shingles", "component_id", "kept").collect())


def families(seed, n=12, copies=8):
    """Texts in families whose members differ in a few words, near the least similarity of a link."""
    rng = random.Random(seed)
    out = []
    for _ in range(n):
        base = ["".join(rng.choice("aeiou") for _ in range(6)) for _ in range(rng.randint(30, 150))]
        for _ in range(copies):
            words = list(base)
            for _ in range(rng.randint(0, 4)):
                words[rng.randrange(len(words))] = str(rng.random())
            out.append(" ".join(words))
    rng.shuffle(out)
    return list(enumerate(out, 100))


def test_the_query_finds_all_links(spark):
    sf = "/root/testdata/sf0.01"
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    assert got(QUERIES["op6_near_documents"](spark, sf)) == brute(rows)


@pytest.mark.parametrize("blocks", [(1024, 4 << 20), (3, 2000)])
def test_families_in_one_piece_and_in_pairs_of_pieces(work, frame, blocks):
    rows = families(1)
    docs = frame([(i, t, None) for i, t in rows])
    assert got(minhash.near_documents(work, docs, bucket_block=blocks[0], text_block=blocks[1])) == brute(rows)


def test_edges(work, frame):
    five = "A b c d e"
    rows = [(0, None), (1, ""), (2, " \n"), (3, "one two"), (4, "ONE\ttwo "), (5, "two one"), (6, five), (7, "a b c d E"), (8, five + " f"), (None, five), (None, None), (9, "x"), (10, "x")]
    rows += [(6, five), (11, "p q r s t u v"), (11, "one two"), (12, "é É"), (13, "É É")]
    docs = frame([(i, t, None) for i, t in rows])
    assert got(minhash.near_documents(work, docs)) == brute(rows)
    assert minhash.near_documents(work, docs.where("false")).count() == 0
    left = minhash.drop_near(work, docs)
    assert left.columns == docs.columns
    assert sorted(repr(r.doc_id) for r in left.collect()) == sorted(repr(i) for i in (0, 1, 2, 3, 5, 6, 8, 9, 11, 12, 13, None, None))


def test_sketches_estimate_similarity():
    rng = np.random.default_rng(0)
    words = [f"w{i}" for i in range(2000)]
    for keep in (0.0, 0.7, 0.9, 0.97, 1.0):
        a = list(rng.choice(words, 400))
        b = [w if rng.random() < keep else f"n{rng.integers(1 << 40)}" for w in a]
        value, at = minhash.shingle_sets(*flat(pa.array([" ".join(a), " ".join(b)])))
        one, two = set(value[at[0] : at[1]].tolist()), set(value[at[1] : at[2]].tolist())
        true = len(one & two) / len(one | two)
        odd = minhash.odd_sketches(minhash.minima(value, at))
        z = int(np.bitwise_count(odd[0] ^ odd[1]).sum())
        estimate = 1 + minhash.BITS / (4 * minhash.SAMPLES) * np.log(max(1e-9, 1 - 2 * z / minhash.BITS))
        assert true < 0.5 or abs(estimate - true) < 0.15
        assert (z <= minhash.most_bits(minhash.SCREEN)) == (true > 0.55) or 0.4 < true < 0.7


def test_a_long_text_is_read_in_parts():
    text = " ".join(str(i) for i in range(30_000))
    value, at = minhash.shingle_sets(*flat(pa.array([text, "a", text])))
    assert np.diff(at).tolist() == [29_996, 1, 29_996]
    samples = minhash.minima(value, at)
    assert (samples[0] == samples[2]).all() and (samples[0] == (value[at[0] : at[1], None] * minhash._FACTORS).min(axis=0)).all()


def kept_by_all_pairs(rows, percent):
    """Ids that name their component when all pairs from percent are linked."""
    sets, low = [(i, shingles(t)) for i, t in rows], {i: i for i, _ in rows}
    links = [(a, b) for a, s in sets for b, t in sets if a < b and s and t and 100 * len(s & t) >= percent * len(s | t)]
    for _ in rows:
        for a, b in links:
            low[a] = low[b] = min(low[a], low[b])
    return sorted(i for i in low if low[i] == i)


def test_drop_near_at_another_percent(work, frame):
    """At 80, with a screen of 0.5, the copies of similarity 0.80 to 0.85 go that 85 leaves."""
    rows = families(2)
    docs = frame([(i, t, None) for i, t in rows])
    left = {p: sorted(r.doc_id for r in minhash.drop_near(work, docs, p, s).collect()) for p, s in ((minhash.NEAR_PERCENT, minhash.NEAR_SCREEN), (85, minhash.SCREEN))}
    assert left == {p: kept_by_all_pairs(rows, p) for p in left}
    assert len(left[80]) < len(left[85])


def test_rows_of_one_doc_id_are_documents_of_their_own(work, frame):
    """20 unrelated texts under one doc_id stay; copies of one of them, under that id or another, go."""
    rng = random.Random(4)
    texts = [" ".join("".join(rng.choice("aeiou") for _ in range(6)) for _ in range(40)) for _ in range(20)]
    rows = [(5, t, "s") for t in texts] + [(5, texts[0], "s"), (5, texts[1] + " end", "s"), (9, texts[2], "s"), (3, texts[3], "s")]
    left = minhash.drop_near(work, frame(rows)).collect()
    assert len(left) == 20 and {r.text.removesuffix(" end") for r in left} == set(texts)
    assert sorted(r.doc_id for r in left) == [3] + [5] * 19


def test_a_doc_id_that_very_many_rows_have(work, frame):
    rows = [(1, f"{i} b c d e {i}", "s") for i in range(3000)]
    assert minhash.drop_near(work, frame(rows)).count() == 3000
