"""Every query against its SQL counterpart on the smallest tables."""

from __future__ import annotations

import pytest
from check import compare, connect

import __spark_entry__ as contract
from sheafwork.oracles import ORACLES
from sheafwork.queries import QUERIES

SF_DIR = "/root/testdata/sf0.001"
# No supplier of the smallest tables is in that country.
MAY_BE_EMPTY = {"q_country_filter"}


@pytest.fixture(scope="module")
def con():
    return connect(SF_DIR)


@pytest.mark.parametrize("name", list(QUERIES))
def test_query_agrees_with_sql(spark, con, name):
    problem = compare(spark, con, name, SF_DIR)
    assert not problem or (name in MAY_BE_EMPTY and problem == "both sides empty")


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLES)
    assert set(QUERIES) <= set(contract.queries()) and set(ORACLES) <= set(contract.oracle_sql())


def test_entry(spark):
    assert contract.entry(spark).count() > 0
