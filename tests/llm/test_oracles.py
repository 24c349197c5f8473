"""Queries that SQL can express, against their SQL, on whole tables."""

import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from carelens.llm.queries import ORACLES, QUERIES  # noqa: E402
from oracle import compare, connect  # noqa: E402


@pytest.mark.parametrize("name", list(ORACLES))
@pytest.mark.parametrize("sf", ["/root/testdata/sf0.001", "/root/testdata/sf0.01"])
def test_same_as_sql(spark, name, sf):
    assert compare(spark, connect(sf), name, sf).startswith("ok")


def test_every_operator_has_its_query():
    assert [sum(q.startswith(f"op{n}_") for q in QUERIES) for n in range(1, 14)] == [1] * 13
    assert "pipeline" in QUERIES
