"""The prefix trie against one built turn by turn."""

import hashlib
import random
import re
import zlib

import pytest

from carelens.llm import order, trie

SHAPE = "conv_id long, turn long, role string, text string, node long, depth string, `a.b` string"
COLUMNS = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


def own_turns(rows):
    convs = {}
    for c, turn, role, text in rows:
        if c is not None:
            convs.setdefault(c, []).append((turn is not None, turn or 0, role or "", text or ""))
    for c, found in convs.items():
        key = lambda t: (t[0], t[1], hashlib.md5(f"{len(t[2].encode())}:{t[2]}{t[3]}".encode()).digest())
        convs[c] = [t[2:] for t in sorted(found, key=key)]
    return convs


def rebuilt(convs):
    out = {}
    for c, own in convs.items():
        rest = c % 20 if c >= 0 else -(-c % 20)
        h = zlib.crc32(str(c).encode()) % 4
        out[c] = convs.get(c - rest, [])[:h] + own[h:]
    return out


def brute(convs):
    members = {}
    for c, turns in convs.items():
        for d in range(len(turns) + 1):
            members.setdefault(tuple(turns[:d]), []).append(c)
    below = {k: [0, 0] for k in members}
    children = {}
    for k in members:
        if k:
            children.setdefault(k[:-1], []).append(k)
    for k, who in members.items():
        saved = (len(who) - 1) * len(re.findall(r"[^\x20\x09-\x0D]+", k[-1][1])) if k else 0
        for d in range(len(k) + 1):
            below[k[:d]][0] += k not in children
            below[k[:d]][1] += saved
    out = []
    for k, who in members.items():
        ends = ",".join(map(str, sorted(c for c in who if len(convs[c]) == len(k))))
        parent = min(members[k[:-1]]) if k else None
        out.append((min(who), len(k), parent, len(who), len(children.get(k, [])), *below[k], hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out, key=repr)


def frame(spark, rows):
    return spark.createDataFrame([(*r, 1, "d", "x") for r in rows], SHAPE).repartition(3)


def run(spark, work, rows, height=16, share=True):
    turns = trie.turns(work, frame(spark, rows))
    given = trie.share_starts(work, turns) if share else (turns, trie.conversations_of(turns))
    out = trie.trie(work, *given, height)
    assert set(COLUMNS) <= set(out.columns)
    return sorted((tuple(r) for r in out.select(COLUMNS).collect()), key=repr)


def table(seed, convs=45, most=9):
    rng = random.Random(seed)
    ids = rng.sample(range(-30, 200), convs)
    return [(c, t, rng.choice(["user", None, "a"]), rng.choice(["", None, "one", "two  words", "ä b\tc"])) for c in ids for t in range(rng.randint(1, most))]


@pytest.mark.parametrize("height", [2, 3, 16])
def test_against_brute_force(spark, work, height):
    rows = table(height)
    assert run(spark, work, rows, height) == brute(rebuilt(own_turns(rows)))


def test_long_conversation_is_cut(spark, work, monkeypatch):
    monkeypatch.setattr(trie, "STRETCH", 4)
    rows = table(9) + [(40, t, "user", "same") for t in range(70)] + [(41, t, "user", "same") for t in range(70)] + [(500, 3, None, "same")] * 30
    assert run(spark, work, rows, 2) == brute(rebuilt(own_turns(rows)))
    assert run(spark, work, rows, 3, share=False) == brute(own_turns(rows))


def test_ties_nulls_and_copies(spark, work):
    rows = [(c, t, "user", x) for c in range(30) for t, x in [(None, "b"), (None, "a"), (1, "c" * 9000), (1, "c")]]
    rows += [(None, 1, "user", "of none")] + [(95, 0, None, None)] * 5
    assert run(spark, work, rows) == brute(rebuilt(own_turns(rows)))


def test_turnless_conversations_are_of_the_root_alone(spark, work):
    turns = trie.turns(work, frame(spark, [(c, 0, "user", "x") for c in (21, 23, 25, 27, 29)]))
    _, conversations = trie.share_starts(work, turns)
    rows = [(c, 0, "user", "x") for c in (21, 23, 25, 27, 29)]
    assert {r.n for r in conversations.collect()} >= {0}
    assert run(spark, work, rows) == brute(rebuilt(own_turns(rows)))


def test_no_rows(spark, work):
    assert run(spark, work, []) == []


def test_ids_are_joined_in_pieces(spark, work, monkeypatch):
    monkeypatch.setattr(trie, "ID_BYTES", 100)
    rows = [(c, 0, "user", "x") for c in range(0, 4000, 20)]
    assert run(spark, work, rows) == brute(own_turns(rows))


def test_places(spark, work):
    rows = [(g, v) for g in ("a", None, "b") for v in [3, 1, 1, 1, None, 2]] + [("hot", i % 7) for i in range(500)]
    out = order.numbered(work, spark.createDataFrame(rows, "g string, v long").repartition(5), ["g"], ["v"], "t").collect()
    found = {}
    for r in out:
        found.setdefault(r.g, []).append((r.place, r.v, r.n))
    for g, mine in found.items():
        values = sorted((v for k, v in rows if k == g), key=lambda v: (v is not None, v or 0))
        assert sorted(mine, key=lambda x: x[0]) == [(i, v, len(values)) for i, v in enumerate(values)]
