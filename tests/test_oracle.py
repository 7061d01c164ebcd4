"""Every registered query against its oracle, on the smallest tables."""

import pytest

from __spark_entry__ import entry, oracle_sql, queries
from listmill.plans.oracle import ORACLE
from listmill.plans.queries import QUERIES
from tests.compare import mismatch

SF_DIR = "/root/testdata/sf0.001"


def test_every_query_has_an_oracle():
    assert QUERIES.keys() == ORACLE.keys()
    assert QUERIES.keys() <= queries().keys() and ORACLE.keys() <= oracle_sql().keys()


@pytest.mark.parametrize("name", QUERIES)
def test_query(spark, name):
    assert mismatch(queries()[name](spark, SF_DIR), oracle_sql()[name], SF_DIR) is None


def test_entry(spark):
    assert entry(spark).count() > 0
