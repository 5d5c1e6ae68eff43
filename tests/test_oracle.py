"""Every query with an oracle must equal its DuckDB SQL at sf0.01."""
import os

import pytest

import __spark_entry__ as E
from tests.oracle_check import compare, duck

SF = "/root/testdata/sf0.01"
pytestmark = pytest.mark.skipif(not os.path.exists(SF), reason="test data not present")


@pytest.fixture(scope="module")
def con():
    return duck(SF)


@pytest.mark.parametrize("name", sorted(E.oracle_sql()))
def test_query_matches_oracle(spark, con, name):
    r = compare(spark, name, SF, E.queries()[name], E.oracle_sql()[name], con)
    assert r["status"] == "match", r


def test_every_oracle_has_a_query():
    assert set(E.oracle_sql()) <= set(E.queries())


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.columns == ["user_id", "game", "score"]
    assert df.count() > 0


@pytest.mark.parametrize("name", sorted(set(E.queries()) - set(E.oracle_sql())))
def test_rows_only_query_runs(spark, name):
    df = E.queries()[name](spark, SF)
    assert df.count() > 0
