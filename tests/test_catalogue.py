import pytest

from quern.plans.catalogue import ORACLE, QUERIES


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_equals_its_sql(name, compare):
    compare(name, QUERIES, ORACLE)


def test_every_query_is_registered():
    import __spark_entry__ as e

    assert set(QUERIES) <= set(e.queries())
    assert set(ORACLE) <= set(e.oracle_sql())
