"""Every query against its SQL twin."""

import pytest

from driver.oracle import ORACLE
from driver.queries import QUERIES
from tests.compare import differences, duck

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def connection():
    with duck(SF_DIR) as opened:
        yield opened


def test_every_query_has_a_twin():
    assert set(QUERIES) == set(ORACLE)


@pytest.mark.parametrize("name", QUERIES)
def test_same_rows(spark, connection, name):
    assert differences(QUERIES[name](spark, SF_DIR), ORACLE[name], connection) == []


def test_entry_has_rows(spark):
    import __spark_entry__

    assert __spark_entry__.entry(spark).count() == 42
