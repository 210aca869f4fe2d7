"""Every query of the core: those with SQL give its rows, the others run and have a stable schema."""

import os

import pytest

from siltloom.plans import catalogue, further  # noqa: F401
from tests.oracle import connect, same

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="no test data")


@pytest.fixture(scope="module")
def con():
    return connect(SF)


@pytest.mark.parametrize("name", sorted(catalogue.SQL))
def test_sql(spark, con, name):
    same(catalogue.QUERIES[name](spark, SF), con, catalogue.SQL[name])


@pytest.mark.parametrize("name", sorted(set(catalogue.QUERIES) - set(catalogue.SQL)))
def test_runs(spark, name):
    df = catalogue.QUERIES[name](spark, SF)
    assert df.columns
    df.write.format("noop").mode("overwrite").save()


def test_entry(spark):
    import __spark_entry__

    assert __spark_entry__.entry(spark).count() > 0
    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())
