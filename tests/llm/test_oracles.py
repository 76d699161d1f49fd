"""The queries that SQL can express, against that SQL over whole tables."""

import os
import re

import pytest

import __spark_entry__ as entry
from compare import differences, oracle_bag, oracle_connection, spark_bag
from shipreport.llm.oracles import ORACLES
from shipreport.llm.queries import QUERIES

SF = os.environ.get("SHIPREPORT_SF", "/root/testdata/sf0.001")


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query(spark, name):
    con = oracle_connection(SF)
    got, want = spark_bag(QUERIES[name](spark, SF)), oracle_bag(con, ORACLES[name])
    con.close()
    assert sum(got[1].values()) and not differences(got, want)


def test_each_operator_is_registered():
    names = set(entry.queries())
    assert "pipeline" in names
    for n in range(1, 14):
        assert len([x for x in names if re.match(rf"op{n}_", x)]) == 1
