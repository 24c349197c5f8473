"""Spot signatures against sets built word by word; edited and following texts against the whole table in order."""

import hashlib
import random
import re
import zlib
from bisect import bisect_right

import numpy as np
import pytest

from carelens.llm import spots

SHAPE = "doc_id long, text string, range int, fingerprint string, `a.b` string"
COMMON = set(spots.COMMON)


def words_of(text):
    return [w.decode("utf-8", "replace") for w in re.findall(rb"[0-9A-Za-z\x80-\xff]+", text.encode())]


def lower(word):
    return word.translate({c: c + 32 for c in range(65, 91)})


def brute(text):
    """Signatures as tuples; words that may stand in for common ones are told by the operator's own hash."""
    words = [lower(w) for w in words_of(text)]
    content = [i for i, w in enumerate(words) if w not in COMMON]
    out, last = set(), 0
    for i, w in enumerate(words):
        if w in COMMON:
            last = i
        elif not (i - last >= spots.DROUGHT and int(spots._hashes_of([w])[0]) % spots.STAND_IN == 0):
            continue
        k = bisect_right(content, i)
        chain = [words[c] for c in content[k : k + spots.CHAIN]]
        if len(chain) == spots.CHAIN:
            out.add((w, *chain))
    if text:
        out.add(("start", *[words[k] for k in content[: spots.CHAIN]]) if content else ("text", text))
    return out


def jaccard(a, b):
    return len(a & b) / len(a | b) if a | b else 1.0


def texts(seed, n=40):
    rng = random.Random(seed)
    vocabulary = ["the", "of", "für", "que", "Haus", "ñ", "x1", "Über"] + [f"w{i}" for i in range(60)]
    made = [" ".join(rng.choice(vocabulary) for _ in range(rng.choice([0, 1, 2, 5, 40, 300]))) for _ in range(n)]
    return [*made, "", "the of", "THE Of", "!!!", " \n", "é", "a b c d", "w1 " * 50 + "the end of it all comes", " ".join(f"z{i}" for i in range(400)), made[3]]


def test_sets_and_likeness(spark):
    many = texts(1)
    sets = [brute(t) for t in many]
    keys, starts = spots.signatures([t.encode() for t in many])
    assert np.diff(starts).tolist() == [len(s) for s in sets]
    a, b = (x.ravel() for x in np.meshgrid(np.arange(len(many)), np.arange(len(many))))
    found = spots.likeness(keys, starts, a, b)
    wanted = np.array([jaccard(sets[i], sets[j]) for i, j in zip(a, b, strict=True)])
    assert np.allclose(found, wanted)
    for least in (0.3, 0.8):
        assert np.allclose(spots.likeness(keys, starts, a, b, least), np.where(wanted >= least, wanted, 0))
    back = spots.parsed(spots.fingerprints(keys, starts))
    assert (back[0] == keys).all() and (back[1] == starts).all()


def test_a_long_set_close_to_a_short_one():
    words = [f"the q{i} r{i} s{i}" for i in range(5000)]
    many = [" ".join(words).encode(), " ".join(words[:4900]).encode(), " ".join(words[:7]).encode()]
    keys, starts = spots.signatures(many)
    found = spots.likeness(keys, starts, np.array([0, 0, 1]), np.array([1, 2, 2]), 0.8)
    assert found[0] > 0.97 and found[1] == found[2] == 0


def check(spark, work, rows, parts):
    docs = spark.createDataFrame([(i, t, 7, "x", "y") for i, t in rows], SHAPE).repartition(parts)
    out = [tuple(r) for r in spots.fingerprint_docs(work, docs).select("doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next").collect()]
    order = sorted(rows, key=lambda r: (r[0] is None, -(r[0] or 0)))
    wanted = []
    for (doc_id, text), (_, next_) in zip(order, [*order[1:], *order[:1]], strict=True):
        text, next_ = text or "", next_ or ""
        k = len(text) // 3
        edited = text[: len(text) - k] + next_[:k]
        keys, starts = spots.signatures([text.encode(), edited.encode()])
        mine = brute(text)
        near = (round(jaccard(mine, brute(x)), 9) for x in (edited, next_))
        wanted.append((doc_id, len(text), hashlib.sha256(edited.encode()).hexdigest(), *spots.fingerprints(keys, starts), *near))
    assert sorted(((*r[:5], round(r[5], 9), round(r[6], 9)) for r in out), key=repr) == sorted(wanted, key=repr)
    return out


@pytest.mark.parametrize("parts", [1, 7])
def test_table(spark, work, parts):
    many = texts(2, 150)
    ids = random.Random(3).sample(range(-50, 1000), len(many) - 1)
    rows = list(zip([*ids, None], many, strict=True))
    check(spark, work, rows, parts)


def test_pieces_of_batches(spark, work, monkeypatch):
    many = texts(4, 60)
    monkeypatch.setattr(spots, "CHUNK_BYTES", 50)
    ids, bodies = list(range(len(many)))[::-1], sorted(many)
    batches = [spots.pa.record_batch([spots.pa.array(ids[i : i + 9], spots.pa.int64()), spots.pa.array([zlib.compress(t.encode()) for t in bodies[i : i + 9]]), spots.pa.array([4] * len(ids[i : i + 9]), spots.pa.int32())], names=["doc_id", "text", "range"]) for i in range(0, len(ids), 9)]
    out = [r for b in spots._in_order(iter(batches)) for r in b.to_pylist()]
    done = [r for r in out if r["edge"] is None]
    assert [(r["edge"], r["doc_id"]) for r in out if r["edge"]] == [(1, ids[0]), (2, ids[-1])]
    whole = spots._rows(ids[:-1], bodies).to_pylist()
    assert [{k: r[k] for k in whole[0]} for r in done] == whole


def test_repeats_a_single_row_and_none(spark, work):
    same = "the quick brown fox of an old house and a long road"
    out = check(spark, work, [(5, same)] * 4, 3)
    assert {(r[5] > 0, r[6]) for r in out} == {(True, 1.0)} and len({r[3] for r in out}) == 1
    check(spark, work, [(5, same + " to the end")], 1)
    check(spark, work, [(1, None), (2, "")], 2)
    assert check(spark, work, [(3, None)], 1)[0][5:] == (1.0, 1.0)
    assert check(spark, work, [], 1) == []


def test_very_long_text(spark, work):
    long = " ".join(f"the w{i} x{i} y{i}" for i in range(60_000))
    out = check(spark, work, [(1, long), (2, "short"), (3, long + " more of it")], 2)
    assert all(0 <= r[5] <= 1 for r in out)
