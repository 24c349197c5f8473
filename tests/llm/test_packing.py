"""Packing: exact ids, gapless sequences, and as few of them as can be."""

import random
import zlib
from collections import defaultdict

import numpy as np
import pyarrow as pa
import pytest

from carelens.llm import packing
from carelens.llm.common import flat
from carelens.llm.queries import QUERIES, vocabulary
from carelens.llm.tokens import Encoder

ODD = ["", " ", "\n", "  a  b\n\n c \n", "don't 's it's\n's", "héllo 123abc ½", "日本語 x", "a b", "x  \n", "!!'s", "<|endoftext|>", "a\r\nb", "%%% &&& ab12"]


def brute(texts):
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(vocabulary())
    t.encode_special_tokens = True
    return [t.encode(x or "", add_special_tokens=False).ids + [0] for x in texts]


def test_ids_are_the_tokenizers():
    rng = random.Random(3)
    texts = ODD + ["".join(rng.choice(" \n\t  ab1é!' .%日ñß ") for _ in range(rng.randint(0, 40))) for _ in range(400)]
    texts += ["".join(rng.choice(" \n\t  ab1é! .%ñß ") for _ in range(rng.randint(0, 40))) for _ in range(800)]
    ids, at = Encoder(vocabulary()).encode(*flat(pa.array(texts)))
    assert [ids[a:b].tolist() for a, b in zip(at, at[1:], strict=False)] == brute(texts)


def test_a_full_cache_starts_anew():
    encode = Encoder(vocabulary(), most=3)
    for text in ("one two three four five", "one two six", "seven one"):
        ids, _ = encode.encode(*flat(pa.array([text])))
        assert ids.tolist() == brute([text])[0]


def check(rows, texts, most=packing.SEQUENCE):
    """rows: (doc_id, piece, start, length, crc, sequence, offset) of documents 0..n-1."""
    ids = brute(texts)
    per, seqs = defaultdict(list), defaultdict(list)
    for r in rows:
        per[r[0]].append(r)
        seqs[r[5]].append(r)
    assert set(per) == set(range(len(texts)))
    for d, got in per.items():
        got.sort(key=lambda r: r[1])
        assert [r[1] for r in got] == list(range(len(got)))
        assert [r[2] for r in got] == np.cumsum([0] + [r[3] for r in got])[:-1].tolist()
        assert sum(r[3] for r in got) == len(ids[d])
        assert all(r[3] == most for r in got[1:]) and (len(got) == 1 or len(ids[d]) > most)
        for r in got:
            assert r[4] == zlib.crc32(np.array(ids[d][r[2] : r[2] + r[3]], "<u4").tobytes())
    for got in seqs.values():
        got.sort(key=lambda r: r[6])
        assert [r[6] for r in got] == np.cumsum([0] + [r[3] for r in got])[:-1].tolist()
        assert sum(r[3] for r in got) <= most
    return len(seqs), sum(map(len, ids))


def test_the_query_packs_whole_documents(spark):
    sf = "/root/testdata/sf0.001"
    rows = [tuple(r) for r in QUERIES["op5_pack_sequences"](spark, sf).collect()]
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    order = sorted(docs)
    back = {d: i for i, d in enumerate(order)}
    used, total = check([(back[r[0]], *r[1:]) for r in rows], [docs[d] for d in order])
    assert used <= -(-total // packing.SEQUENCE) * 1.02 + 1


def test_edges(work, frame):
    texts = [None, "", "word " * 5000, "same text", "same text", "x"]
    docs = frame([(i, t, None) for i, t in enumerate(texts)])
    out = packing.pack(work, docs, vocabulary(), 64).select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")
    check([tuple(r) for r in out.collect()], texts, 64)
    assert packing.pack(work, docs.where("false"), vocabulary(), 64).count() == 0
    null_id = docs.selectExpr("CAST(NULL AS BIGINT) AS doc_id", "text").where("text = 'same text'")
    assert [r.doc_id for r in packing.pack(work, null_id, vocabulary()).collect()] == [None, None]


@pytest.mark.parametrize("seed", range(20))
def test_fullest_is_the_best_sum(seed):
    rng = random.Random(seed)
    counts = {rng.randint(1, 40): rng.randint(1, 3) for _ in range(rng.randint(0, 6))}
    room = rng.randint(0, 60)
    sums = {0}
    for length, n in counts.items():
        sums = {s + k * length for s in sums for k in range(n + 1) if s + k * length <= room}
    got = packing.fullest(counts, room)
    assert sum(k * n for k, n in got) == max(sums) and all(n <= counts[k] for k, n in got)
