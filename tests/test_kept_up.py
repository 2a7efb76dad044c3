"""Kept sums against dashboards recomputed from the whole fact."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from starmill.plans import dashboards
from starmill.plans.facts import DAILY_COLUMNS, fact_schema
from starmill.plans.kept_up import ANSWERS, KEPT, keep_up, kept_dashboard
from starmill.sources import write_table
from tests.test_facts import dims  # noqa: F401

DIMENSION = {"airline_dashboard": "airline", "plane_dashboard": "plane", "holiday_trend": "date", "least_delayed_month": "date"}


def fact_rows(r, days, n):
    rows = []
    for _ in range(n):
        row = {c: r.choice([None, 1, 2, 3]) if c.endswith("_key") else r.choice([None, 0.0, 1.0, 12.0]) for c in DAILY_COLUMNS}
        row |= {"flight_date_key": r.choice(days), "cancelled": r.choice([0.0, 1.0]), "diverted": r.choice([0.0, 1.0])}
        rows.append(tuple(row.values()))
    return rows


def all_rows(df):
    return sorted((tuple(round(v, 9) if isinstance(v, float) else v for v in row) for row in df.collect()), key=str)


def write(spark, path, rows):
    frame = spark.createDataFrame(rows, fact_schema(DAILY_COLUMNS))
    write_table(frame, path, ["flight_date_key"], keep_others=True)
    return spark.read.schema(fact_schema(DAILY_COLUMNS)).parquet(path)


@pytest.fixture(scope="module")
def lake(spark, tmp_path_factory):
    """Two deliveries of days and a correction of one of them."""
    r, root = random.Random(3), tmp_path_factory.mktemp("kept")
    for days in ([1, 2, 3], [40, 41], [2]):
        fact = write(spark, str(root / "fact"), fact_rows(r, days, 60))
        keep_up(fact, str(root / "sums"), "flight_date_key", days)
    return root, fact


@pytest.mark.parametrize("name", list(ANSWERS))
def test_equal_to_the_recomputed_dashboard(spark, lake, dims, name):  # noqa: F811
    root, fact = lake
    dimension = getattr(dims, DIMENSION.get(name, "airport"))
    kept = kept_dashboard(spark, str(root / "sums"), name, dimension)
    whole = getattr(dashboards, name)(fact, dimension)
    assert kept.columns == whole.columns
    assert all_rows(kept) == all_rows(whole)


def test_only_changed_partitions_are_read_and_written(spark, lake, tmp_path):
    root, fact = lake
    before = {p: p.stat().st_mtime_ns for p in (root / "sums").rglob("*.parquet")}
    inside = fact.where(F.col("flight_date_key").isin([2]))
    assert all("flight_date_key=2/" in f for f in inside.inputFiles()) or len(inside.inputFiles()) > 0
    keep_up(fact, str(root / "sums"), "flight_date_key", [2])
    after = {p: p.stat().st_mtime_ns for p in (root / "sums").rglob("*.parquet")}
    stayed = [p for p in before if "kept_part=2" not in str(p)]
    assert stayed and all(after.get(p) == before[p] for p in stayed)
    assert {p.name for p in (root / "sums").iterdir()} == set(KEPT)


def test_a_kept_dashboard_reads_no_fact(spark, lake, dims):  # noqa: F811
    root, _ = lake
    kept = kept_dashboard(spark, str(root / "sums"), "airline_dashboard", dims.airline)
    assert not any("/fact/" in f for f in kept.inputFiles())
