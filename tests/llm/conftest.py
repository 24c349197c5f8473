"""Fixtures of the operators' tests: small hand-made documents and a work folder."""

import pytest

from carelens.llm.common import Work


@pytest.fixture
def work(spark):
    return Work(spark, "test")


@pytest.fixture
def frame(spark):
    """A table (doc_id, text, source, lang, n_chars), with extra columns named like the operators' own."""

    def make(rows, extra=""):
        shape = "doc_id long, text string, lang string, source string, n_chars long, size long, kept string, a long"
        full = [(i, t, "en", s, len(t or ""), 1, "x", 2) for i, t, s in rows]
        return spark.createDataFrame(full, shape)

    return make
