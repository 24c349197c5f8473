"""Every stage of the pipeline on odd rows: nulls, empty and long texts, repeated rows, no rows, clashing columns."""

from collections import Counter

import corpus_pipeline
import pytest

STAGES = dict(corpus_pipeline.STAGES)
LONG = " ".join(f"w{i}" for i in range(60_000))
ROWS = [
    (1, None, None), (2, "", "s"), (3, "a b c d e f", "s"), (3, "a b c d e f", "s"), (None, "a b c d e f", None), (None, None, "t"),
    (4, LONG, "t"), (5, LONG + " x", "t"), (6, "\n\n", "u"), (7, "é \x0b ß", "u"),
]
# As size, kept, a come with the fixture; these are the names that the operators use themselves.
EXTRA = {"doc": "1", "copies": "2", "r": "3", "n_lines": "4", "score": "0.5", "k1": "7", "component_id": "8", "piece": "9", "n": "10", "id": "11", "line_no": "12", "draw": "13", "`a.b`": "14", "`c``d`": "15", "tie": "16"}


@pytest.fixture
def labels(spark, tmp_path):
    rows = [(i, 1, int(i == 3)) for i in (2, 3, 4, 7)] + [(None, 1, 1), (5, 1, None)]
    spark.createDataFrame(rows, "doc_id long, quality int, toxic int").write.parquet(str(tmp_path / "labels.parquet"))
    return str(tmp_path)


@pytest.fixture
def docs(frame):
    return frame(ROWS).selectExpr("*", *[f"{v} AS {k}" for k, v in EXTRA.items()])


def rows(df, docs):
    assert df.columns == docs.columns
    return Counter(tuple(r) for r in df.collect())


@pytest.mark.parametrize("name", [n for n in STAGES if n != "packing"])
def test_a_stage_keeps_columns_and_odd_rows(spark, labels, docs, name):
    got = STAGES[name](spark, docs, labels)
    assert got.columns == docs.columns
    assert [t for _, t in got.dtypes] == [t for _, t in docs.dtypes]
    have, given = rows(got, docs), Counter(tuple(r) for r in docs.collect())
    if name == "near_dedup":  # 5 is near 4; one of the rows of 3 stays; rows without doc_id stay
        assert Counter(r[0] for r in have.elements()) == Counter([1, 2, 3, 4, 6, 7, None, None])
    elif name == "mixing":  # all texts are whole copies of given rows
        assert set(have) <= set(given)
    elif name == "line_dedup":  # no line is in ten documents
        assert Counter(r[0] for r in have.elements()) == Counter(r[0] for r in given.elements())
        assert Counter(r[1] for r in have.elements()) == Counter(r[1] or "" for r in given.elements())
    else:
        assert not have - given


@pytest.mark.parametrize("name", list(STAGES))
def test_a_stage_takes_no_rows(spark, labels, docs, name):
    assert STAGES[name](spark, docs.where("false"), labels).count() == 0


def test_packing_takes_odd_rows(spark, labels, docs):
    got = STAGES["packing"](spark, docs, labels).collect()
    assert Counter(r.doc_id for r in got if r.piece == 0) == Counter(r[0] for r in ROWS)
    assert max(r.offset + r.length for r in got) <= 2048


def test_without_two_classes_nothing_is_rejected(spark, docs, tmp_path):
    spark.createDataFrame([(3, 1, 1), (4, 1, 1)], "doc_id long, quality int, toxic int").write.parquet(str(tmp_path / "labels.parquet"))
    assert STAGES["toxicity"](spark, docs, str(tmp_path)).count() == len(ROWS)
