"""Every registered query against its SQL, and the shape of the large plans."""

import os

import pytest
from compare import ROOT, connect, spark_rows, sql_rows

import __spark_entry__ as contract
from skyledger.catalog.queries import QUERIES

SF = os.environ.get("TEST_SF", "sf0.001")
DIR = f"{ROOT}/{SF}"

pytestmark = pytest.mark.skipif(not os.path.isdir(DIR), reason="no tables")


@pytest.fixture(scope="module", autouse=True)
def generated_code(spark):
    """Queries run as jobs run them."""
    spark.conf.set("spark.sql.codegen.wholeStage", "true")
    yield
    spark.conf.set("spark.sql.codegen.wholeStage", "false")


@pytest.fixture(scope="module")
def con():
    return connect(DIR)


def test_contract(spark):
    assert set(QUERIES) <= set(contract.queries())
    assert set(QUERIES) <= set(contract.oracle_sql()) <= set(contract.queries())
    assert contract.entry(spark).count() > 0


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_sql(spark, con, name):
    result = contract.queries()[name](spark, DIR)
    plan = result._jdf.queryExecution().executedPlan().toString()
    for bad in ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "MapInPandas"):
        assert bad not in plan
    columns, rows = spark_rows(result)
    sql_columns, expected = sql_rows(con, contract.oracle_sql()[name])
    assert columns == sql_columns
    assert list(map(repr, rows)) == list(map(repr, expected))
