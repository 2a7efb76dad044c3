"""Sketched profiles against exact ones, merged from deliveries that are not read again."""

from __future__ import annotations

import random
import re
from collections import Counter

import numpy as np
import pytest

from registered.queries import profile_sketch
from starmill.operators.sketches import TRACKED, merged_profiles, profile_report, profile_states
from tests.test_scd2 import stored

SCHEMA = "id long, price double, town string, day date, void string"


@pytest.fixture(scope="module")
def deliveries(spark):
    r = random.Random(1)
    rows = [
        (k, r.expovariate(1.0) if k % 9 else None, r.choice(["a", "b", "c"]) if k % 2 else f"t{k}", None, None)
        for k in range(30000)
    ]
    frames = [spark.createDataFrame(part, SCHEMA) for part in (rows[:7000], rows[7000:7001], rows[7001:], [])]
    return rows, frames


def report(states):
    return {r.column_name: r for r in profile_report(states).collect()}


def test_merged_states_are_within_their_error_bounds(spark, deliveries):
    rows, frames = deliveries
    states = [stored(profile_states(f)) for f in frames]
    merged = merged_profiles(*states)
    files = [f for f in merged.inputFiles()]
    assert files and not any("delivery" in f for f in files)  # only states are read
    for got in (report(merged), report(profile_states(spark.createDataFrame(rows, SCHEMA)))):
        assert {r.row_count for r in got.values()} == {len(rows)}
        for n, name in enumerate(("id", "price", "town", "day", "void")):
            values = [r[n] for r in rows if r[n] is not None]
            assert got[name].null_count == len(rows) - len(values)
            assert abs(got[name].distinct_estimate - len(set(values))) <= 0.05 * len(set(values))
        prices = np.sort([r[1] for r in rows if r[1] is not None])
        assert (got["price"].min_value, got["price"].max_value) == (prices[0], prices[-1])
        assert got["price"].mean_value == pytest.approx(prices.mean())
        for rank, value in zip((0.25, 0.5, 0.75), got["price"].quantiles, strict=True):
            assert abs(np.searchsorted(prices, value) / len(prices) - rank) < 0.027
        exact = Counter(r[2] for r in rows)
        frequent = {item["item"]: item["count"] for item in got["town"].frequent}
        assert {"a", "b", "c"} <= set(frequent)
        for item in "abc":
            assert abs(frequent[item] - exact[item]) <= 3 * len(rows) / TRACKED
        assert got["town"].quantiles is None and (got["town"].min_text, got["town"].max_text) == ("a", max(r[2] for r in rows))
        assert got["void"].distinct_estimate == 0 and got["day"].min_text is None


def test_the_rows_are_scanned_once(spark):
    lines = spark.read.parquet("/root/testdata/sf0.001/lineitem.parquet")
    plan = profile_states(lines)._jdf.queryExecution().optimizedPlan().toString()
    assert len(re.findall("Relation", plan)) == 1


def test_query_is_near_the_exact_profile(spark):
    lines = spark.read.parquet("/root/testdata/sf0.001/lineitem.parquet").toPandas()
    for row in profile_sketch(spark, "/root/testdata/sf0.001").collect():
        column = lines[row.column_name]
        assert (row.row_count, row.null_count) == (len(column), column.isna().sum())
        assert abs(row.distinct_estimate - column.nunique()) <= max(1, 0.05 * column.nunique())
        if row.quartile_2 is not None:
            rank = (column <= row.quartile_2).mean(), (column < row.quartile_2).mean()
            assert rank[1] - 0.03 <= 0.5 <= rank[0] + 0.03
        if column.nunique() < 100:
            assert row.most_frequent_count == column.value_counts().iloc[0]


def test_query_has_no_most_frequent_value_where_all_are_rare(spark, tmp_path):
    rows = [(k, k % 4, None) for k in range(30000)]
    spark.createDataFrame(rows, "l_orderkey long, l_linenumber int, l_tax double").write.parquet(f"{tmp_path}/lineitem.parquet")
    found = {r.column_name: r for r in profile_sketch(spark, str(tmp_path)).collect()}
    assert {r.row_count for r in found.values()} == {len(rows)}
    assert (found["l_orderkey"].most_frequent, found["l_orderkey"].most_frequent_count) == (None, None)
    assert found["l_linenumber"].most_frequent in "0123" and found["l_linenumber"].most_frequent_count == 7500
    assert found["l_tax"].quartile_2 is None and abs(found["l_orderkey"].quartile_2 - 15000) < 900
