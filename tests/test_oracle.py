"""Every registered query of the library against its DuckDB oracle on the smallest driver tables."""

from __future__ import annotations

import os

import pytest

import __spark_entry__ as E
from tidemark import catalog
from tools.oracle_check import compare, open_oracle

SF = "/root/testdata/sf0.001"
KEYS = list(catalog.QUERIES)


@pytest.fixture(scope="module")
def con():
    if not os.path.exists(SF):
        pytest.skip("test data not available")
    return open_oracle(SF)


@pytest.mark.parametrize("name", KEYS)
def test_query_matches_oracle(spark, con, name):
    problems, _, _ = compare(spark, con, SF, name, E.queries()[name], E.oracle_sql().get(name))
    assert not problems, problems


def test_every_query_has_an_oracle():
    assert set(catalog.QUERIES) <= set(E.oracle_sql())


def test_entry_smoke(spark):
    df = E.entry(spark)
    rows = df.collect()
    assert len(rows) > 0 and "position" in df.columns
