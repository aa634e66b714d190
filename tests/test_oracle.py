"""Every registered query against its SQL on the smallest tables."""

import compare
import pytest

import __spark_entry__ as entry_point
from oracle_queries import SQL
from spark_queries import QUERIES

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    return compare.connect(SF)


def test_every_query_has_sql():
    assert set(QUERIES) == set(SQL)
    assert set(QUERIES) <= set(entry_point.queries()) and set(SQL) <= set(entry_point.oracle_sql())


def test_some_transaction_meets_two_rules():
    duck = compare.connect("/root/testdata/sf0.01")
    hits = f"SELECT transaction_id FROM ({SQL['mart_suspicious_transactions']}) GROUP BY 1 HAVING count(DISTINCT rule_code) > 1"
    assert duck.execute(f"SELECT count(*) FROM ({hits})").fetchone()[0] > 0
    codes = f"SELECT count(DISTINCT rule_code) FROM ({SQL['mart_suspicious_transactions']})"
    assert duck.execute(codes).fetchone()[0] == 3


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_sql(spark, duck, name):
    assert compare.difference(QUERIES[name](spark, SF), duck, SQL[name]) is None


def test_entry_returns_rows(spark):
    rows = entry_point.entry(spark)
    assert rows.count() > 0 and "rule_code" in rows.columns
