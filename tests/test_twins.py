"""Every registered query against its DuckDB twin on the smallest tables."""

import check
import pytest
from conftest import SMALL

import __spark_entry__ as contract


@pytest.fixture(scope="module")
def con():
    return check.connect(SMALL)


@pytest.mark.parametrize("name", sorted(contract.queries()))
def test_query_matches_its_twin(spark, con, name):
    verdict, n = check.compare(spark, con, name, SMALL)
    assert verdict in ("ok", "no twin", "ok (EMPTY)"), verdict
    assert n > 0 or verdict == "ok (EMPTY)"


def test_entry_runs(spark):
    assert contract.entry(spark).count() > 0


def test_twins_belong_to_queries():
    assert set(contract.oracle_sql()) <= set(contract.queries())
