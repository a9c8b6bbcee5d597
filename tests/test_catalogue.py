"""Every query of the library, against its SQL where there is one."""

import pytest

from tests.oracle import DATA, same
from voxelyard.plans import catalogue

SF = f"{DATA}/sf0.001"
QUERIES, SQL = catalogue.queries(), catalogue.oracle_sql()


@pytest.mark.parametrize("name", sorted(SQL))
def test_matches_sql(spark, name):
    same(spark, QUERIES[name], SQL[name], SF)


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(SQL)))
def test_runs(spark, name):
    df = QUERIES[name](spark, SF)
    assert df.columns and len(set(df.columns)) == len(df.columns)
    assert df.count() >= 0


def test_every_sql_has_a_query():
    assert set(SQL) <= set(QUERIES)
