"""Every registered query with SQL, against DuckDB on whole tables."""

import os

import pytest
from compare import differences, duck

import __spark_entry__ as entry_module

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
SQL = entry_module.oracle_sql()

#: Spark type -> SQL type the driver's schema check expects.
SAME_TYPE = {
    "bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR",
    "boolean": "BOOLEAN",
}


@pytest.fixture(scope="module")
def con():
    return duck(SF_DIR)


def test_every_sql_has_a_query():
    assert set(SQL) <= set(entry_module.queries())


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_equals_sql(spark, con, name):
    d = differences(entry_module.queries()[name](spark, SF_DIR), con, SQL[name])
    assert d["columns"][0] == d["columns"][1]
    assert not d["only_spark"] and not d["only_sql"], d
    spark_types, sql_types = d["types"]
    assert {c: SAME_TYPE[t] for c, t in spark_types.items()} == sql_types


def test_entry(spark):
    rows = entry_module.entry(spark).collect()
    assert rows and set(rows[0].asDict()) == {"type", "n", "pct"}
    assert abs(sum(r["pct"] for r in rows) - 100) < 1e-9
