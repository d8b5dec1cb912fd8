"""Registered queries against their SQL, on the smallest driver tables."""

import pytest
from compare import compare, connect

import __spark_entry__ as entry
from granary.registry import SOURCES

QUERIES, ORACLES = entry.queries(), entry.oracle_sql()


@pytest.fixture(scope="module")
def duck():
    return connect("/root/testdata/sf0.001")


def test_names_match():
    assert set(ORACLES) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(n for n in ORACLES if not n.startswith("load_")))
def test_query_equals_its_sql(spark, duck, small, name):
    count, problem = compare(QUERIES[name](spark, small), duck, ORACLES[name])
    assert problem is None


def test_flagship_query(spark):
    df = entry.entry(spark)
    assert df.count() > 0


def test_every_check_rejects_some_row(duck):
    """Each check text of the registry is held against SQL by at least one failing row."""
    seen = set()
    for name, sql in ORACLES.items():
        if name.startswith("quarantine_"):
            query = f"SELECT DISTINCT unnest(string_split(failed, ',')) FROM ({sql}) q"
            seen |= {r[0] for r in duck.execute(query).fetchall()}
    assert seen == {check for table in SOURCES.values() for check in table.checks}
