"""Every registered query against its DuckDB twin on the smallest tables.

`ORACLE_SF=sf0.01 python -m pytest tests/test_oracle.py` runs the larger set.
"""

import os

import pytest

import __spark_entry__ as contract
from tests.compare import ROOT, difference, duck

SF = os.environ.get("ORACLE_SF", "sf0.001")
QUERIES, SQL = contract.registry.all_queries(), contract.registry.all_oracles()


@pytest.fixture(scope="module")
def con():
    return duck(f"{ROOT}/{SF}")


def test_every_query_has_a_twin():
    assert set(QUERIES) == set(SQL)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_same_rows(spark, con, name):
    assert difference(QUERIES[name](spark, f"{ROOT}/{SF}"), con, SQL[name]) is None


def test_entry(spark):
    assert contract.entry(spark).limit(1).count() == 1
