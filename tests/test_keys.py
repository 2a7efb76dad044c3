from __future__ import annotations

import hashlib

import pytest
from pyspark.sql import functions as F

from starmill.operators.keys import dense_key, next_key


def by_digest(values):
    return sorted(values, key=lambda v: (hashlib.md5(str(v).encode()).hexdigest(), v))


@pytest.mark.parametrize("partitions", [1, 7])
def test_keys_are_dense_and_do_not_depend_on_partitions(spark, partitions):
    members = [f"m{i}" for i in range(20_000)]
    df = spark.createDataFrame([(m,) for m in members], "member string").repartition(partitions)
    got = {r.member: r.key for r in dense_key(df, ["member"], "key").collect()}
    assert got == {m: i for i, m in enumerate(by_digest(members), start=1)}


def test_keys_go_on_from_a_base(spark):
    df = spark.createDataFrame([(i,) for i in range(50)], "member int")
    base = spark.createDataFrame([(100,)], "k int").agg(F.max("k")).scalar()
    assert sorted(r.key for r in dense_key(df, ["member"], "key", base).collect()) == list(range(101, 151))


def test_keys_of_several_columns(spark):
    df = spark.createDataFrame([(y, m) for y in (2016, 2017) for m in range(1, 13)], "y int, m int")
    assert sorted(r.key for r in dense_key(df, ["y", "m"], "key").collect()) == list(range(1, 25))


def test_no_members_no_keys(spark):
    empty = spark.createDataFrame([], "member string")
    assert dense_key(empty, ["member"], "key").count() == 0


def test_next_key(spark):
    assert next_key(spark.createDataFrame([(4,), (9,)], "k long"), "k").first()[0] == 10
    assert next_key(spark.createDataFrame([], "k long"), "k").first()[0] == 1
