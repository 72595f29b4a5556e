"""Every registered query against its checking SQL."""

import pytest

import __spark_entry__ as entry
from checks import oracles, queries
from checks.compare import check, connect

from .conftest import SF_DIR

QUERIES, ORACLES = queries.queries(), oracles.oracle_sql()
ROWS_ONLY = {"content_fingerprint"}


@pytest.fixture(scope="module")
def duck():
    return connect(SF_DIR)


def test_only_known_queries_lack_sql():
    assert set(QUERIES) - set(ORACLES) == ROWS_ONLY
    assert set(ORACLES) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, duck, name):
    outcome, _ = check(spark, duck, SF_DIR, name, QUERIES[name], ORACLES.get(name))
    assert not outcome.startswith("FAILED"), outcome


def test_entry_gives_rows(spark):
    assert entry.entry(spark).count() > 0
