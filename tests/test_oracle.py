"""Every registered query against its SQL in DuckDB."""

from __future__ import annotations

import pytest

import __spark_entry__ as contract
from cuadre.catalog.oracle import ORACLE
from cuadre.catalog.queries import QUERIES
from tests.compare import difference, duck

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return duck(SF_DIR)


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLE)
    assert set(QUERIES) <= set(contract.queries()) and set(ORACLE) <= set(contract.oracle_sql())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, con, name):
    assert difference(QUERIES[name](spark, SF_DIR), con, ORACLE[name]) == ""


def test_entry(spark):
    assert contract.entry(spark).limit(1).count() == 1
