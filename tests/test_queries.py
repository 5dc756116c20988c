import pytest

from fleetspark.plans import registry
from tests.oracle import connect, differences


@pytest.fixture(scope="module")
def con(sf_dir):
    return connect(sf_dir)


@pytest.mark.parametrize("name", sorted(registry.queries()))
def test_query_matches_its_sql(spark, sf_dir, con, name):
    assert differences(registry.queries()[name](spark, sf_dir), con.sql(registry.oracle_sql()[name])) == []


def test_entry(spark):
    import __spark_entry__

    assert __spark_entry__.entry(spark).columns[0] == "cloud"
    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())
