"""Every registered query against its SQL."""

from __future__ import annotations

import os

import pytest

from checks.oracle import SQL
from checks.queries import QUERIES
from tests.compare import assert_same, duck_result

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.01")


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, name):
    result = QUERIES[name](spark, SF_DIR)
    if name in SQL:
        assert_same(result, duck_result(SF_DIR, SQL[name]))
    else:
        assert result.count() > 0


def test_every_sql_has_a_query():
    assert SQL.keys() <= QUERIES.keys()
