"""Every registered query against its SQL; those without SQL must give rows."""

import compare
import pytest

import __spark_entry__ as contract

QUERIES, ORACLE = contract.queries(), contract.oracle_sql()


@pytest.fixture(scope="module")
def con(sf_dir):
    return compare.connect(sf_dir)


def test_every_oracle_has_a_query():
    assert set(ORACLE) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_matches_sql(name, spark, sf_dir, con):
    result = compare.spark_result(QUERIES[name](spark, sf_dir))
    assert compare.differences(result, compare.sql_result(con, ORACLE[name])) == []


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLE)))
def test_gives_rows(name, spark, sf_dir):
    assert QUERIES[name](spark, sf_dir).count() > 0


def test_entry(spark):
    assert contract.entry(spark).count() == 3
