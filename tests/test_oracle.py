"""Every registered query against its SQL, over the whole tables."""

import compare
import pytest

import __spark_entry__ as contract
from seatwise.plans.oracle import ORACLE
from seatwise.plans.registry import QUERIES

SQL_TYPES = {
    "string": "VARCHAR",
    "int": "INTEGER",
    "bigint": "BIGINT",
    "double": "DOUBLE",
    "date": "DATE",
    "timestamp_ntz": "TIMESTAMP",
}


@pytest.fixture(scope="module")
def duck(sf_dir):
    return compare.connect(sf_dir)


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_matches_sql(spark, sf_dir, duck, name):
    result = contract.queries()[name](spark, sf_dir)
    expected = duck.execute(ORACLE[name]).description
    assert {f.name: SQL_TYPES[f.dataType.simpleString()] for f in result.schema.fields} == {
        d[0]: str(d[1]) for d in expected
    }
    got = compare.spark_rows(result)
    assert got
    assert got == compare.sql_rows(duck, ORACLE[name])


def test_every_query_has_its_sql_and_is_registered():
    assert set(QUERIES) == set(ORACLE)
    assert set(QUERIES) <= set(contract.queries())
    assert set(ORACLE) <= set(contract.oracle_sql())


def test_entry_runs_the_rollup(spark):
    rollup = contract.entry(spark)
    assert len(rollup.columns) == 41
    assert rollup.count() > 0
