"""Every query with SQL must give the rows of that SQL; the others must run and give rows."""

import os

import pytest

from __spark_entry__ import oracle_sql, queries
from compare import compare, duck

FOLDER = os.environ.get("FIELDTIDE_TEST_DIR", "/root/testdata/sf0.001")
QUERIES, ORACLES = queries(), oracle_sql()


@pytest.fixture(scope="module")
def con():
    return duck(FOLDER)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, con, name):
    ok, message, _ = compare(spark, con, name, FOLDER, QUERIES, ORACLES)
    assert ok, message
    if name not in ORACLES:
        assert not message.endswith(": 0")


def test_every_check_has_a_query():
    assert set(ORACLES) <= set(QUERIES)
