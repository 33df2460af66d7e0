"""Every registered query against its SQL, on the smallest scale factor."""

import pytest

from __spark_entry__ import entry, oracle_sql
from catalog import CATALOG
from check import compare, connect

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    return connect(SF)


@pytest.mark.parametrize("name", list(CATALOG))
def test_query_agrees_with_sql(spark, duck, name):
    outcome, _ = compare(spark, duck, name, SF)
    assert outcome.startswith("ok"), outcome


def test_every_query_has_sql():
    assert set(CATALOG) <= set(oracle_sql())


def test_entry(spark):
    df = entry(spark)
    assert df.columns == ["date", "transaction_type", "tx_count", "total_volume", "fraud_count"]
    assert not df.isEmpty()
