"""Bucket digests: the merge they lead to, and the buckets they leave alone."""

from __future__ import annotations

import random
from datetime import date

import pytest
from pyspark.sql import functions as F

from starmill.operators.digests import bucket_count, changed_buckets, scd2_merge_changed
from starmill.operators.scd2 import scd2_initial, scd2_merge
from tests.test_scd2 import D1, D2, SPEC, STAGED, stored


def dimension(spark, members):
    return stored(scd2_initial(spark.createDataFrame(members, STAGED), SPEC, D1))


def all_rows(df):
    return sorted(map(tuple, df.collect()), key=str)


@pytest.mark.parametrize("seed", range(3))
def test_equal_to_a_merge_of_all_members(spark, seed):
    r = random.Random(seed)
    state = lambda: (r.choice(["x", "y", None, ""]), r.choice([1, 2, None]))
    members = [(f"m{n}", *state()) for n in range(400)]
    dim = dimension(spark, members)
    sent = [(c, *(state() if r.random() < 0.05 else (a, b))) for c, a, b in members if r.random() < 0.97]
    sent += [("new", "x", 1), ("m1", "x", 1), ("m1", "x", 1)]
    staged = stored(spark.createDataFrame(sent, STAGED))
    want = all_rows(scd2_merge(dim, staged, SPEC, D2))
    for per_bucket in (1, 16, 10**6):
        assert all_rows(scd2_merge_changed(dim, staged, SPEC, D2, stored, per_bucket)) == want


def test_a_redelivery_with_one_percent_of_changes_joins_few_buckets(spark):
    rows = spark.range(20000).selectExpr("concat('m', id) as code", "'x' as name", "cast(id % 50 as int) as size")
    dim = stored(scd2_initial(rows, SPEC, D1))
    changed = F.pmod(F.xxhash64("code"), F.lit(100)) == 7
    again = stored(rows.withColumn("name", F.when(changed, F.lit("z")).otherwise(F.col("name"))))
    buckets = bucket_count(20000)
    n_changed, found = again.where(changed).count(), changed_buckets(dim, again, SPEC, buckets).count()
    assert 0 < found <= n_changed < buckets / 5
    assert changed_buckets(dim, stored(rows), SPEC, buckets).count() == 0
    merged = scd2_merge_changed(dim, again, SPEC, D2, stored)
    assert merged.count() == 20000 + n_changed


def test_null_and_swapped_values_change_a_digest(spark):
    dim = dimension(spark, [("a", None, 1), ("b", "1", None), ("c", "x", 1)])
    for member, expected in ((("a", "", 1), 1), (("a", "1", None), 1), (("b", "1", None), 0), (("c", "x", 1), 0)):
        rest = [m for m in [("a", None, 1), ("b", "1", None), ("c", "x", 1)] if m[0] != member[0]]
        staged = spark.createDataFrame([member, *rest], STAGED)
        assert changed_buckets(dim, staged, SPEC, 1 << 20).count() == expected


def test_empty_sides(spark):
    empty = spark.createDataFrame([], STAGED)
    dim = dimension(spark, [("a", "x", 1)])
    assert all_rows(scd2_merge_changed(dim, empty, SPEC, D2, stored)) == all_rows(dim)
    none = stored(scd2_initial(empty, SPEC, D1))
    assert scd2_merge_changed(none, spark.createDataFrame([("a", "x", 1)], STAGED), SPEC, date(2024, 5, 1), stored).count() == 1
