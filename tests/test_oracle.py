"""Every query against its SQL in the second engine, and its plan."""

import os
import re

import pytest

from checks import compare
from checks.oracle import oracle_sql
from checks.queries import queries

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
ROWS_ONLY: set[str] = set()


@pytest.fixture(scope="module")
def database():
    return compare.database(SF_DIR)


def test_every_query_has_sql():
    assert set(queries()) - set(oracle_sql()) == ROWS_ONLY
    assert set(oracle_sql()) <= set(queries())


@pytest.mark.parametrize("name", list(queries()))
def test_query(spark, database, name):
    df = queries()[name](spark, SF_DIR)
    outcome, rows = compare.compare(df, database, name)
    assert outcome in ("equal", "rows only")
    assert rows > 0
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert not re.search("CartesianProduct|BroadcastNestedLoopJoin|BatchEvalPython|InPandas", plan)
