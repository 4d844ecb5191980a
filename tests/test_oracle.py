"""Every registered query that has DuckDB SQL against it, on the smallest tables."""

from __future__ import annotations

import pytest
from conftest import SF_SMALL
from oracle_harness import check, duck

from __spark_entry__ import entry, oracle_sql, queries

from corpusmill.plans.catalog import QUERIES
from corpusmill.plans.oracle import ORACLE

NAMES = sorted(oracle_sql())


@pytest.fixture(scope="module")
def con():
    return duck(SF_SMALL)


def test_every_query_of_the_library_has_an_oracle():
    assert set(ORACLE) == set(QUERIES)
    assert set(QUERIES) <= set(queries()) and set(oracle_sql()) <= set(queries())


def test_entry_smoke(spark):
    df = entry(spark)
    assert df.columns == ["conv_id", "split", "n_tokens", "text"]
    assert df.count() >= 0


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_oracle(spark, con, name):
    _, status, n, detail, _ = check(spark, con, SF_SMALL, name, queries()[name], oracle_sql().get(name))
    assert status == "match", detail
