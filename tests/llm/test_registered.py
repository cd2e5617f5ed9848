"""The registered queries of the operators: against their SQL where they have one, else whole and well-formed."""

import pytest

import __spark_entry__ as entry
import check
from pageflow.llm import oracle, queries

SF_DIR = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", list(oracle.oracle_sql()))
def test_query_equals_its_sql(spark, name):
    assert check.compare(entry.queries()[name](spark, SF_DIR), check.connect(SF_DIR), name) is None


def test_all_operators_are_registered():
    own = queries.queries()
    assert sorted(int(name[2:].split("_")[0]) for name in own) == list(range(1, 14))
    assert set(own) | {"pipeline"} <= set(entry.queries())
    assert set(oracle.oracle_sql()) <= set(own)
