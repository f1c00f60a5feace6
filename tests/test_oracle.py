import pytest

import __spark_entry__ as driver
import oracle
from coinweir.plans import oracles, registry

FOLDER = "/root/testdata/sf0.001"
TYPES = {
    "string": "VARCHAR",
    "bigint": "BIGINT",
    "int": "INTEGER",
    "double": "DOUBLE",
    "boolean": "BOOLEAN",
    "timestamp_ntz": "TIMESTAMP",
}


@pytest.fixture(scope="module")
def con():
    return oracle.connect(FOLDER)


def test_every_query_has_sql():
    assert registry.registered().keys() == oracles.oracle_sql().keys()
    assert registry.registered().keys() <= driver.queries().keys()
    assert oracles.oracle_sql().items() <= driver.oracle_sql().items()


@pytest.mark.parametrize("name", sorted(registry.registered()))
def test_query_equals_sql(spark, con, name):
    found = registry.registered()[name](spark, FOLDER)
    expected = con.sql(oracles.oracle_sql()[name])
    types = dict(zip(expected.columns, map(str, expected.types)))
    assert {column: TYPES[kind] for column, kind in found.dtypes} == types
    rows = oracle.normalised(found.toPandas())
    assert rows and rows == oracle.normalised(expected.df())


def test_entry(spark):
    assert driver.entry(spark).columns == ["transaction_month", "income", "expenses", "net"]
