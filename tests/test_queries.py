"""Every query of the catalog against its SQL on the smallest tables."""

from __future__ import annotations

import pytest

from __spark_entry__ import entry, oracle_sql, queries
from folioflow.catalog import QUERIES
from tests.compare import difference, oracle

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def connection():
    return oracle(FOLDER)


def test_entry(spark):
    assert entry(spark).count() > 0


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_agrees_with_sql(spark, connection, name):
    assert difference(queries()[name](spark, FOLDER), connection, oracle_sql()[name]) is None
