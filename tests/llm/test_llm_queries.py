"""Every query with SQL against DuckDB, and the others against their own results in brief."""

import pytest

import __spark_entry__ as contract
from compare import compare, connect
from postlake.llm.oracle import ORACLE
from postlake.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    return connect(SF)


def test_one_query_per_operator():
    numbers = sorted(int(name[2:].split("_")[0]) for name in QUERIES if name.startswith("op"))
    assert numbers == list(range(1, 14))
    assert set(QUERIES) | {"pipeline"} <= set(contract.queries())
    assert set(ORACLE) <= set(contract.oracle_sql())


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_equals_sql(spark, duck, name):
    assert compare(QUERIES[name](spark, SF), duck, ORACLE[name]) is None
