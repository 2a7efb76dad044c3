from __future__ import annotations

from datetime import date
from decimal import Decimal

from starmill.operators.audit import load_audit, profile_table


def test_load_audit(spark):
    df = spark.createDataFrame([(1,), (1,), (None,), (2,), (None,)], "k int")
    assert tuple(load_audit(df, "k").first()) == (5, 2, 2)
    assert tuple(load_audit(df.limit(0), "k").first()) == (0, 0, 0)
    source = spark.createDataFrame([("a",), ("a",), (None,), ("b",), ("a",)], "code string")
    assert tuple(load_audit(df, "k", source, "code").first()) == (5, 2, 2, 5, 1, 2)
    assert tuple(load_audit(df, "k", source.limit(0), "code").first()) == (5, 2, 2, 0, 0, 0)


def test_profile(spark):
    big = 2**60
    df = spark.createDataFrame(
        [
            (big, 1.5, "a", Decimal("1.10"), date(2016, 1, 1), True),
            (big + 1, 1.5, None, Decimal("1.30"), date(2016, 1, 1), False),
            (big, None, "a", Decimal("1.10"), None, None),
        ],
        "n long, x double, t string, d decimal(10,2), day date, flag boolean",
    )
    got = {r.column_name: tuple(r)[1:] for r in profile_table(df).collect()}
    assert got["n"][:3] == (3, 0, 2)
    assert got["x"] == (3, 1, 1, 1.5, 1.5, 1.5, None, None)
    assert got["t"] == (3, 1, 1, None, None, None, "a", "a")
    assert got["d"][:5] == (3, 0, 2, 1.1, 1.3)
    assert got["day"] == (3, 1, 1, None, None, None, "2016-01-01", "2016-01-01")
    assert got["flag"] == (3, 1, 2, None, None, None, "false", "true")


def test_profile_of_an_empty_table_has_its_columns(spark):
    got = profile_table(spark.createDataFrame([], "n long, t string")).collect()
    assert sorted(tuple(r) for r in got) == [("n", 0, 0, 0, *[None] * 5), ("t", 0, 0, 0, *[None] * 5)]
