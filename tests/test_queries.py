from __future__ import annotations

import pytest
from compare import oracle_rows, spark_rows

import __spark_entry__ as contract
from foyer.plans import batch, oracle, stream


BASE = batch.QUERIES | stream.QUERIES


def test_every_query_has_an_oracle():
    assert BASE.keys() == oracle.ORACLES.keys()
    assert contract.oracle_sql().keys() <= contract.queries().keys()


def test_entry(spark):
    assert contract.entry(spark).count() > 0


@pytest.mark.parametrize("name", list(BASE))
def test_query_equals_oracle(spark, sf_dir, name):
    got = spark_rows(contract.queries()[name](spark, sf_dir))
    want = oracle_rows(contract.oracle_sql()[name], sf_dir)
    assert got == want
    assert sum(got[1].values()) > 0
