"""Every registered operator against its SQL, on the smallest tables."""

import os

import pytest

import __spark_entry__ as registered
import check
from asterlap.plans import registry
from oracle import SQL

FOLDER = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no test tables")


@pytest.fixture(scope="module")
def connection():
    return check.database(FOLDER)


def test_every_operator_has_sql():
    assert set(registry.queries()) == set(SQL)


@pytest.mark.parametrize("name", list(registry.queries()))
def test_operator(spark, connection, name):
    found = registered.queries()[name](spark, FOLDER)
    assert check.differences(found, connection.execute(registered.oracle_sql()[name])) == []


def test_entry(spark):
    assert registered.entry(spark).head(1)
