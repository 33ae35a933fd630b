import pytest

from gristmill.plans import oracle, reference

NAMES = sorted(reference.QUERIES)


@pytest.mark.parametrize("name", NAMES)
def test_query_equals_sql(name, same_as_sql):
    same_as_sql(reference.QUERIES[name], oracle.SQL[name])


def test_every_query_has_sql():
    assert set(reference.QUERIES) == set(oracle.SQL)


def test_entry_points(spark):
    import __spark_entry__ as entry

    assert entry.entry(spark).count() > 0
    assert set(entry.oracle_sql()) <= set(entry.queries())
