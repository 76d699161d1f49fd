"""Every registered query against its SQL over the given test tables."""

import os

import pytest

import __spark_entry__ as entry
from shipreport.workload import queries as workload
from compare import differences, oracle_bag, oracle_connection, spark_bag

SF = os.environ.get("SHIPREPORT_SF", "/root/testdata/sf0.001")
QUERIES, ORACLES = workload.QUERIES, entry.oracle_sql()


@pytest.fixture(scope="module")
def oracle():
    con = oracle_connection(SF)
    yield con
    con.close()


def test_every_query_has_an_oracle():
    assert set(QUERIES) <= set(ORACLES) and set(QUERIES) <= set(entry.queries())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, oracle, name):
    got = spark_bag(QUERIES[name](spark, SF))
    assert not differences(got, oracle_bag(oracle, ORACLES[name]))


def test_entry(spark):
    assert len(entry.entry(spark).columns) == 33
