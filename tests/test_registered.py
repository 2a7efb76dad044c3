"""Every registered query against its SQL on whole tables."""

from __future__ import annotations

import pytest

from __spark_entry__ import entry, oracle_sql, queries
from registered.oracle import ORACLE
from registered.queries import QUERIES
from tests.oracle_check import database, mismatch

SF = "/root/testdata/sf0.001"


#: Estimates of sketches, see test_sketches.py.
NO_SQL = {"profile_sketch"}


@pytest.fixture(scope="module")
def con():
    return database(SF)


def test_each_query_has_its_sql():
    assert [name for name in QUERIES if name not in NO_SQL] == list(ORACLE)
    assert queries().keys() >= QUERIES.keys() and oracle_sql().keys() >= ORACLE.keys()


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_equals_sql(spark, con, name):
    assert mismatch(spark, con, SF, name) is None


def test_a_difference_is_noticed(spark, con, monkeypatch):
    changed = oracle_sql() | {"next_key": "select cast(max(o_orderkey) as bigint) as next_key from orders"}
    monkeypatch.setattr("tests.oracle_check.oracle_sql", lambda: changed)
    assert "1 rows differ" in mismatch(spark, con, SF, "next_key")


def test_flagship(spark):
    assert entry(spark).count() > 0
