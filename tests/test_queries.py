"""Every registered query against its SQL twin on the given tables."""

from __future__ import annotations

import os

import pytest

import __spark_entry__ as entry_points
from tests.oracle import connect, differences

SF_DIR = os.environ.get("ORACLE_SF_DIR", "/root/testdata/sf0.001")
QUERIES, ORACLES = entry_points.queries(), entry_points.oracle_sql()


@pytest.fixture(scope="module")
def con():
    return connect(SF_DIR)


def test_oracles_belong_to_queries():
    assert set(ORACLES) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_sql(spark, con, name):
    assert differences(QUERIES[name](spark, SF_DIR), con, ORACLES[name]) == []


def test_entry(spark):
    result = entry_points.entry(spark)
    assert result.columns[:2] == ["region", "annee"] and result.count() > 0
