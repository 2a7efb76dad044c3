"""Keyed merges of a partitioned fact, in order and out of order."""

from __future__ import annotations

import random
from datetime import date

from pyspark.sql import functions as F

from starmill.operators.corrections import IDENTITY, identity, merge_fact

SCHEMA = "flight long, part int, value double"
DAYS = [date(2024, m, 1) for m in range(1, 6)]


def merged(spark, root, rows, day, **more):
    frame = spark.createDataFrame(rows, SCHEMA).withColumn(IDENTITY, identity("flight", "part"))
    return merge_fact(spark, f"{root}/fact", frame, "part", day, SCHEMA, f"{root}/work", **more)


def stored(spark, root):
    fact = spark.read.schema(SCHEMA).parquet(f"{root}/fact").select("flight", "part", "value")
    return sorted((tuple(r) for r in fact.collect()), key=str)


def test_late_corrected_and_older_rows(spark, tmp_path):
    first = merged(spark, tmp_path, [(1, 1, 1.0), (2, 1, 2.0), (3, 2, 3.0), (3, 2, 3.0)], DAYS[0])
    assert (first.rows_before, first.rows_delivered, first.rows_replaced, first.rows_after) == (0, 4, 0, 4)
    second = merged(spark, tmp_path, [(2, 1, 20.0), (4, 1, 4.0)], DAYS[2])
    assert (second.rows_before, second.rows_replaced, second.rows_ignored, second.rows_after) == (2, 1, 0, 3)
    late = merged(spark, tmp_path, [(1, 1, 10.0), (2, 1, 99.0), (5, 3, 5.0)], DAYS[1])
    assert (late.rows_before, late.rows_replaced, late.rows_ignored, late.rows_after) == (3, 1, 1, 4)
    assert stored(spark, tmp_path) == [
        (1, 1, 10.0), (2, 1, 20.0), (3, 2, 3.0), (3, 2, 3.0), (4, 1, 4.0), (5, 3, 5.0)
    ]


def test_other_partitions_are_not_written(spark, tmp_path):
    merged(spark, tmp_path, [(1, 1, 1.0), (2, 2, 2.0)], DAYS[0])
    files = set((tmp_path / "fact" / "part=2").iterdir())
    merged(spark, tmp_path, [(3, 1, 3.0)], DAYS[1])
    assert set((tmp_path / "fact" / "part=2").iterdir()) == files


def test_random_deliveries_in_any_order(spark, tmp_path):
    r = random.Random(2)
    deliveries = {
        day: [(r.randint(1, 30), r.choice([1, 2, None]), float(n)) for n in range(r.randint(0, 25))] for day in DAYS
    }
    latest = {}
    for day in DAYS:
        groups = {}
        for row in deliveries[day]:
            groups.setdefault(row[:2], []).append(row)
        latest |= groups
    want = sorted((row for rows in latest.values() for row in rows), key=str)
    for n, limit in enumerate((0, 1 << 26)):
        order = r.sample(DAYS, len(DAYS))
        for day in [*order, order[-1]]:  # the last one is run again, as after a lost driver
            merged(spark, tmp_path / str(n), deliveries[day], day, limit_bytes=limit)
        assert stored(spark, tmp_path / str(n)) == want


def test_identities_tell_values_apart(spark):
    rows = [("a", "bc"), ("ab", "c"), (None, "abc"), ("", "abc"), ("abc", None), ("-", "abc"), ("1:a", "bc")]
    frame = spark.createDataFrame(rows, "x string, y string").select(identity("x", "y").alias("id"))
    assert frame.agg(F.count_distinct("id")).first()[0] == len(rows)


def test_rows_without_an_identity_stay(spark, tmp_path):
    frame = spark.createDataFrame([(1, 1, 1.0), (2, 1, 2.0)], SCHEMA).withColumn(IDENTITY, F.lit(None).cast("string"))
    for day in DAYS[:2]:
        merge_fact(spark, f"{tmp_path}/fact", frame, "part", day, SCHEMA, f"{tmp_path}/work")
    assert len(stored(spark, tmp_path)) == 4


def test_only_identities_of_several_deliveries_are_looked_up(spark, tmp_path):
    work = tmp_path / "work"
    merged(spark, tmp_path, [(n, n % 3, 1.0) for n in range(50)], DAYS[0])
    assert sorted(p.name for p in work.iterdir()) == ["delivered"]  # there was nothing to merge with
    done = merged(spark, tmp_path, [(n, n % 3, 2.0) for n in range(40, 60)], DAYS[1])
    assert (done.rows_before, done.rows_delivered, done.rows_replaced, done.rows_ignored) == (50, 20, 10, 0)
    assert sorted(p.name for p in work.iterdir()) == ["delivered", "kept", "last"]
    assert spark.read.parquet(f"{work}/last/v*").count() == 10
