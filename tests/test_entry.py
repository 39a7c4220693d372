"""Every registered query against its oracle."""

import pytest

import __spark_entry__ as entry_point
import check_oracles
import oracles

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return check_oracles.connect(SF)


def test_every_query_has_an_oracle():
    registered = set(entry_point.queries()) - set(entry_point.LLM_QUERIES)
    assert registered == set(oracles.ORACLES)


@pytest.mark.parametrize("name", list(oracles.ORACLES))
def test_matches_oracle(spark, con, name):
    outcome = check_oracles.compare(spark, con, SF, name)
    assert isinstance(outcome, int), outcome


def test_entry(spark):
    assert entry_point.entry(spark).count() > 0
