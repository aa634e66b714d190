"""Registered queries of the operators: against their SQL, and over whole tables."""

import compare
import pytest
from passbook.llm import queries

SF = "/root/testdata/sf0.001"
WHOLE = {f"op{n}" for n in (1, 4, 5, 6, 7, 8, 9, 11)}


@pytest.mark.parametrize("name", sorted(queries.SQL))
def test_query_equals_sql(spark, name):
    assert compare.difference(queries.QUERIES[name](spark, SF), compare.connect(SF), queries.SQL[name]) is None


@pytest.mark.parametrize("name", sorted(q for q in queries.QUERIES if q.split("_")[0] in WHOLE))
def test_one_row_for_each_row(spark, name):
    table, key = ("pages", "page_id") if name.startswith("op1_") else ("documents", "doc_id")
    rows = spark.read.parquet(f"{SF}/{table}.parquet")
    found = queries.QUERIES[name](spark, SF)
    assert sorted(r[0] for r in found.select(key).collect()) == sorted(r[0] for r in rows.select(key).collect())


def test_thirteen_operators():
    assert sorted(int(q[2:].split("_")[0]) for q in queries.QUERIES) == list(range(1, 14))
