import pytest
from oracle_check import connect, same

from quarrelscope.plans import registry

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return connect(SF)


@pytest.mark.parametrize("name", list(registry.ORACLE_SQL))
def test_query_equals_its_sql(spark, con, name):
    same(registry.QUERIES[name](spark, SF), con, registry.ORACLE_SQL[name])


def test_every_query_has_sql():
    assert set(registry.ORACLE_SQL) == set(registry.QUERIES)


def test_entry(spark):
    import __spark_entry__ as entry

    assert entry.entry(spark).count() > 0
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_entry_without_the_corpus_part(monkeypatch):
    import importlib
    import sys

    import __spark_entry__ as entry

    monkeypatch.setitem(sys.modules, "corpus_pipeline", None)
    try:
        importlib.reload(entry)
        assert set(entry.queries()) == set(registry.QUERIES)
        assert set(entry.oracle_sql()) == set(registry.ORACLE_SQL)
    finally:
        monkeypatch.undo()
        importlib.reload(entry)
