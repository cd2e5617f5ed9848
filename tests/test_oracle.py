"""Every registered query against its SQL, at the smallest scale factor."""

import pytest

import __spark_entry__ as entry
import check
from pageflow.plans.oracle import oracle_sql
from pageflow.plans.queries import queries

SF_DIR = "/root/testdata/sf0.001"
ROWS_ONLY = {"gbt_predictions", "model_search", "permutation_importance", "external_evaluation"}


@pytest.fixture(scope="module")
def connection():
    return check.connect(SF_DIR)


@pytest.mark.parametrize("name", list(queries()))
def test_query(spark, connection, name):
    df = queries()[name](spark, SF_DIR)
    assert check.compare(df, connection, name) is None
    plan = df._jdf.queryExecution().executedPlan().toString()
    for operator in ("BatchEvalPython", "ArrowEvalPython", "CartesianProduct", "BroadcastNestedLoopJoin"):
        assert operator not in plan


def test_all_but_models_have_sql():
    assert set(queries()) - set(oracle_sql()) == ROWS_ONLY
    assert set(oracle_sql()) <= set(queries())
    assert set(queries()) <= set(entry.queries())


def test_entry(spark):
    assert entry.entry(spark).columns == ["file_date", "language", "DAU"]
    assert entry.entry(spark).count() > 0
