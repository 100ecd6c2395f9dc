import pytest
from compare import connect, normal, rows

import __spark_entry__
from tidewright.catalog import ORACLE_SQL, QUERIES


@pytest.fixture(scope="module")
def duck(sf):
    return connect(sf)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_agrees_with_sql(spark, sf, duck, name):
    df = QUERIES[name](spark, sf)
    found = duck.execute(ORACLE_SQL[name])
    names = [d[0] for d in found.description]
    assert sorted(names) == sorted(df.columns)
    assert normal(rows(df.columns, df.collect())) == normal(rows(names, found.fetchall()))


def test_entry(spark):
    assert __spark_entry__.entry(spark).count() > 0


def test_every_query_has_sql():
    assert set(ORACLE_SQL) == set(QUERIES)
    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())


def test_entry_without_the_optional_subpackage(monkeypatch):
    import sys

    for name in ("tidewright.llm.queries", "tidewright.llm.oracles", "corpus_pipeline"):
        monkeypatch.setitem(sys.modules, name, None)
    assert set(__spark_entry__.queries()) == set(QUERIES)
    assert set(__spark_entry__.oracle_sql()) == set(ORACLE_SQL)
