"""Every registered query against its SQL, on the smallest tables."""

from __future__ import annotations

import pytest

import __spark_entry__ as entry
from tests.conftest import SF_DIR
from verification.catalogue import ORACLE, QUERIES
from verification.compare import connect, difference


@pytest.fixture(scope="module")
def connection():
    return connect(SF_DIR)


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLE)


def test_entry(spark):
    assert entry.entry(spark).count() == 150


@pytest.mark.parametrize("key", QUERIES)
def test_query(spark, connection, key):
    assert difference(QUERIES[key](spark, SF_DIR), connection, ORACLE[key]) is None
