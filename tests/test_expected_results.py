"""Each registered query against its SQL in the independent engine, on the smallest tables."""

import pytest

import __spark_entry__ as contract
from testbed.compare import connect, differences

SF_DIR = "/root/testdata/sf0.001"
QUERIES = {n: q for n, q in contract.queries().items() if n not in contract.LLM_QUERIES}
EXPECTED = {n: s for n, s in contract.oracle_sql().items() if n not in contract.LLM_ORACLE}


@pytest.fixture(scope="module")
def engine():
    return connect(SF_DIR)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, engine, name):
    df = QUERIES[name](spark, SF_DIR)
    found = df.toPandas()
    relation = engine.sql(EXPECTED[name])
    assert differences(found, relation.df()) is None
    kinds = {"int": "INTEGER", "bigint": "BIGINT", "float": "FLOAT", "double": "DOUBLE",
             "boolean": "BOOLEAN"}
    theirs = dict(zip(relation.columns, map(str, relation.types)))
    assert {c: kinds.get(t, "VARCHAR") for c, t in df.dtypes} == theirs


def test_flagship_query(spark):
    rows = contract.entry(spark).collect()
    assert len(rows) == 2


def test_contract_names():
    assert set(EXPECTED) == set(QUERIES)
