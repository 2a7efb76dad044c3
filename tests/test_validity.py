"""Versions valid on a day: bisection against plain Python, facts of old flights, plans without ranges."""

from __future__ import annotations

import random
import re
from datetime import date, timedelta

import pytest
from pyspark.sql import functions as F

from starmill.operators.scd2 import OPEN_END
from starmill.operators.validity import packed_versions, version_on
from starmill.plans.facts import Dimensions, daily_fact
from tests.test_facts import flight

D0 = date(2016, 1, 1)


def day(n):
    return D0 + timedelta(days=n)


def valid(versions, on, reach_back):
    if on is None or not versions:
        return None
    if on < versions[0][0] and reach_back:
        return versions[0][2]
    return next((k for start, end, k in versions if start <= on < end), None)


@pytest.mark.parametrize("reach_back", [False, True])
def test_bisection_equals_a_search_through_all(spark, reach_back):
    r = random.Random(4)
    rows, asked, key = [], [], 0
    for member in range(40):
        starts = sorted(r.sample(range(200), r.choice([1, 1, 2, 3, 7, 8, 60])))
        versions = []
        for n, start in enumerate(starts):
            key += 1
            end = day(starts[n + 1]) if n + 1 < len(starts) else r.choice([OPEN_END, day(start + 5)])
            if end < OPEN_END and r.random() < 0.2:
                end = min(end, day(start + 1))  # a gap follows
            versions.append((day(start), end, key))
            rows.append((f"m{member}", day(start), end, key))
        asked += [(f"m{member}", on, valid(versions, on, reach_back)) for on in [None, *map(day, range(-2, 210, 3))]]
    asked += [("nobody", D0, None), (None, D0, None)]
    dim = spark.createDataFrame(rows, "code string, start_date date, end_date date, thing_key long")
    questions = spark.createDataFrame(asked, "code string, day date, want long")
    joined = questions.join(packed_versions(dim, ["code"], "thing_key"), "code", "left")
    found = joined.withColumn("got", version_on(F.col("versions"), F.col("day"), reach_back))
    assert found.count() == len(asked)
    assert found.where("NOT (got <=> want)").collect() == []


def airlines(spark):
    rows = [(1, "AA", "old", day(0), day(10), False), (2, "AA", "new", day(10), OPEN_END, True), (3, "BB", "b", day(5), OPEN_END, True)]
    return spark.createDataFrame(
        rows, "airline_key long, carrier string, airline_name string, start_date date, end_date date, current_flag boolean"
    )


def calendar(spark):
    return spark.range(30).selectExpr("date_add(date '2015-12-25', cast(id as int)) as date", "cast(id as int) as date_key")


def days_and_carriers(spark):
    given = [(0, "AA"), (9, "AA"), (10, "AA"), (4, "BB"), (5, "BB"), (-3, "AA"), (6, "ZZ"), (6, None)]
    return given, spark.createDataFrame([flight(FlightDate=day(n), Carrier=c) for n, c in given], flight_schema())


def flight_schema():
    from starmill.schemas import FLIGHTS

    return FLIGHTS


@pytest.mark.parametrize("limit", [0, 1 << 26])
def test_old_flights_get_the_versions_of_their_day(spark, limit):
    given, flights = days_and_carriers(spark)
    dims = Dimensions(airline=airlines(spark), date=calendar(spark))
    columns = ["flight_date_key", "airline_key"]
    fact = daily_fact(flights, dims, columns, limit_bytes=limit, point_in_time=True, keep=["Carrier"])
    want = {(0, "AA"): 1, (9, "AA"): 1, (10, "AA"): 2, (5, "BB"): 3}
    got = sorted(((r.flight_date_key - 7, r.Carrier, r.airline_key) for r in fact.collect()), key=str)
    assert got == sorted(((n, c, want.get((n, c))) for n, c in given), key=str)
    back = daily_fact(flights, dims, columns, limit_bytes=limit, point_in_time=True, reach_back=True, keep=["Carrier"])
    assert {(r.flight_date_key - 7, r.Carrier): r.airline_key for r in back.collect()}[(-3, "AA")] == 1
    open_only = daily_fact(flights, dims, columns, limit_bytes=limit, keep=["Carrier"])
    assert {r.airline_key for r in open_only.where("Carrier = 'AA'").collect()} == {2}


def test_no_range_is_joined(spark):
    _, flights = days_and_carriers(spark)
    dims = Dimensions(airline=airlines(spark), date=calendar(spark))
    for limit in (0, 1 << 26):
        fact = daily_fact(flights, dims, ["airline_key"], limit_bytes=limit, point_in_time=True)
        plan = fact._jdf.queryExecution().executedPlan().toString()
        assert not re.search("NestedLoop|Cartesian|Python", plan)


def test_the_version_is_sought_once_per_value(spark):
    from pyspark.sql import functions as F

    from starmill.operators.validity import VERSIONS, version_on

    frame = spark.createDataFrame([], f"versions {VERSIONS}, day date")
    for reach_back in (False, True):
        found = frame.select(version_on(F.col("versions"), F.col("day"), reach_back).alias("key"))
        assert found._jdf.queryExecution().optimizedPlan().toString().count("aggregate(") == 1
