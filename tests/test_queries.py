"""Every registered query against its oracle on the smallest tables."""

import pytest

import __spark_entry__ as entry
from strataflow.plans import catalog
from tests.check_queries import compare, connect

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    return connect(FOLDER)


@pytest.mark.parametrize("name", list(catalog.QUERIES))
def test_query_matches_oracle(spark, duck, name):
    ok, note, _ = compare(spark, duck, FOLDER, name, catalog.ORACLES.get(name))
    assert ok is not False, note


def test_every_query_has_an_oracle():
    assert set(catalog.QUERIES) == set(catalog.ORACLES)


def test_flagship(spark):
    df = entry.entry(spark)
    assert df.columns == ["life_cycle_id", "life_cycle", "orders", "customers", "revenue"]
    assert df.count() == 3
