from __future__ import annotations

from starmill.plans.staging import flight_airports, stage_airline, stage_airport, stage_plane
from starmill.schemas import AIRLINES, AIRPORTS, ENGINES, PLANES, WAC

SEEN = "OriginAirportID string, OriginState string, OriginStateName string, OriginWac int"


def test_most_flights_decide_about_an_airport(spark, rows):
    flights = spark.createDataFrame(
        [("1", "NJ", "New Jersey", 21)] * 2
        + [("1", "AA", "Wrong", 1), ("2", "B", "b", 2), ("2", "A", "a", None), (None, "X", "x", 9)],
        SEEN,
    )
    assert rows(flight_airports(flights)) == [("1", "NJ", "New Jersey", 21), ("2", "A", "a", None)]
    plan = flight_airports(flights)._jdf.queryExecution().executedPlan().toString()
    assert plan.index("SortAggregate") < plan.index("HashAggregate")


def test_airports(spark, rows):
    airports = spark.createDataFrame([("1", "Adak, AK: Adak Airport"), ("1", "Adak, AK: Adak Airport"), ("9", None)], AIRPORTS)
    flights = spark.createDataFrame([("1", "AK", "Alaska", 1)], SEEN)
    wac = spark.createDataFrame([(1, "United States"), (1, "Other")], WAC)
    assert rows(stage_airport(airports, flights, wac)) == [
        ("1", "adak airport", "adak", "ak", "alaska", 1, "other"),
        ("9", "undefined", "undefined", "undefined", "undefined", None, "undefined"),
    ]


def test_airlines(spark, rows):
    airlines = spark.createDataFrame([("AA", "American"), ("AA", "American"), ("BB", None)], AIRLINES)
    assert rows(stage_airline(airlines)) == [("AA", "american"), ("BB", "undefined")]


def test_planes(spark, rows):
    planes = spark.createDataFrame(
        [
            ("N1", "156H", "OWNER", "72", 1973, "MEMPHIS", "TN", "PO BOX", 95),
            ("N1", "156H", "OWNER", "72", 1973, "MEMPHIS", "TN", "PO BOX", 95),
            ("N2", None, None, None, None, None, None, None, None),
        ],
        PLANES,
    )
    engines = spark.createDataFrame([(95, "ALLIANCE", "HESS", 750), (95, "ALLIANCE", "HESS", 800)], ENGINES)
    none = "undefined"
    assert rows(stage_plane(planes, engines)) == [
        ("N1", "156H", "owner", "72", 1973, "memphis", "tn", "po box", 95, "alliance", "hess", 750),
        ("N2", none, none, none, None, none, none, none, None, none, none, None),
    ]
