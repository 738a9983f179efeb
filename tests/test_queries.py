"""Every registered query of the core against its oracle SQL, on whole tables at the smallest scale."""

import pytest

import __spark_entry__ as entry
from queries.catalog import QUERIES, lineitem
from oracle import ORACLES
from tests.compare import compare
from tests.programs import PROGRAMS, SQL

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, name):
    assert name in ORACLES
    ok, message = compare(spark, name, SF)
    assert ok, message


@pytest.mark.parametrize("name", sorted(PROGRAMS))
def test_protocol_over_programs_matches_its_sql(spark, name):
    ok, message = compare(spark, name, SF, PROGRAMS, SQL)
    assert ok, message


def test_entry(spark):
    assert entry.entry(spark).count() > 0


def test_every_cell_is_in_the_merged_and_the_existing_rows(spark):
    cells = {r[0] for r in lineitem(spark, SF, "RPT").select("cell_no").distinct().collect()}
    for name in ("result_upsert_all_lineitem", "existing_results_all_lineitem"):
        assert {r["cell"] for r in QUERIES[name](spark, SF).collect()} == cells
