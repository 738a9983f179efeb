"""Registered text queries against their oracle SQL, on whole tables at the smallest scale."""

import pytest

import __spark_entry__ as entry
from cellspark.llm import queries
from tests.compare import compare

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_query_matches_oracle(spark, name):
    ok, message = compare(spark, name, SF)
    assert ok, message


def test_every_operator_and_the_pipeline_are_registered():
    names = entry.queries()
    assert [sum(n.startswith(f"op{k}_") for n in names) for k in range(1, 14)] == [1] * 13
    assert "pipeline" in names
