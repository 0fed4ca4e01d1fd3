import os

import pytest

import __spark_entry__ as entry
from tests.oracle import compare, connect

FOLDER = os.environ.get("ORACLE_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="module")
def con():
    return connect(FOLDER)


@pytest.mark.parametrize("name", sorted(entry.oracle_sql()))
def test_agrees_with_sql(spark, con, name):
    df = entry.queries()[name](spark, FOLDER)
    assert compare(df, con, entry.oracle_sql()[name]) == ""


def test_entry(spark):
    assert entry.entry(spark).count() > 0
