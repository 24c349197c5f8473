"""Every stage of the pipeline against a brute-force version, on the rows that its predecessor kept."""

import sys
from collections import Counter
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).parent))

import corpus_pipeline  # noqa: E402
import test_lines as plain_lines  # noqa: E402
import test_minhash as plain_near  # noqa: E402
import test_mixing as plain_mixing  # noqa: E402
import test_packing as plain_packing  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402

from carelens.llm import toxicity  # noqa: E402

SF = "/root/testdata/sf0.001"
COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


@pytest.fixture(scope="module")
def steps(spark):
    """What every stage was given, and what the last one returned."""
    from carelens.llm.common import Work

    work, docs = Work(spark, "steps"), spark.read.parquet(f"{SF}/documents.parquet")
    out = {}
    for name, stage in corpus_pipeline.STAGES:
        out[name] = docs
        docs = work.keep(stage(spark, docs, SF), name)
    out["end"] = docs
    return out


def rows(df):
    return sorted((tuple(r) for r in df.select(*COLUMNS).collect()), key=repr)


def test_stages_keep_the_columns(steps):
    assert [n for n, _ in corpus_pipeline.STAGES] == ["toxicity", "line_dedup", "near_dedup", "mixing", "packing"]
    for name in ("line_dedup", "near_dedup", "mixing", "packing"):
        assert steps[name].columns == COLUMNS


def test_toxicity(spark, steps):
    docs = steps["toxicity"]
    model = toxicity.fit(docs, spark.read.parquet(f"{SF}/labels.parquet"))
    scored = docs.withColumn("score", model.score(F.col("text"))).collect()
    kept = [r for r in scored if r.score < model.thresholds.get(r.lang, model.threshold)]
    assert rows(steps["line_dedup"]) == sorted((tuple(r)[:5] for r in kept), key=repr)
    assert 0 < len(kept) < len(scored)


def test_lines(steps):
    given = rows(steps["line_dedup"])
    texts = plain_lines.brute([r[1] for r in given], 10)
    want = [(r[0], t, r[2], r[3], len(t)) for r, (_, _, t) in zip(given, texts, strict=True)]
    assert rows(steps["near_dedup"]) == sorted(want, key=repr)


def test_near(steps):
    given = rows(steps["near_dedup"])
    kept = Counter(i for i, _, _, stays in plain_near.brute([(r[0], r[1]) for r in given], 80) if stays)
    assert rows(steps["mixing"]) == [r for r in given if kept[repr(r[0])]]


def test_mixing(steps):
    given = rows(steps["mixing"])
    copies = plain_mixing.brute(given)
    assert rows(steps["packing"]) == sorted((r for r, n in zip(given, copies, strict=True) for _ in range(n)), key=repr)


def test_packing(steps):
    given = sorted((r.doc_id, r.text) for r in steps["packing"].collect())
    out = steps["end"].select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset").collect()
    # Copies of a document have equal pieces; tell them apart by taking each piece's places in order.
    copy = Counter(i for i, _ in given)
    number = {}
    for n, (i, _) in enumerate(given):
        number.setdefault(i, []).append(n)
    seen = Counter()
    told = []
    for r in sorted(map(tuple, out)):
        told.append((number[r[0]][seen[r[:2]] % copy[r[0]]], *r[1:]))
        seen[r[:2]] += 1
    used, total = plain_packing.check(told, [t for _, t in given])
    assert used <= -(-total // 2048) * 1.05 + 1


def test_run_is_the_stages(spark, steps):
    some = ["doc_id", "piece", "start", "length", "ids_crc32"]
    got = corpus_pipeline.run(spark, SF).select(*some).collect()
    assert Counter(map(tuple, got)) == Counter(map(tuple, steps["end"].select(*some).collect()))
