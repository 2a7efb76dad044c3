"""The questions the dashboards answer, asked of the fact tables.

Each question adds up the fact by surrogate key first, so that what is joined to a dimension afterwards has
one row per key rather than one per flight.  These sums are functions of their own, named ``*_sums``: sums of parts of the
fact add up to those of the whole, so they can be kept per partition, see :mod:`starmill.plans.kept_up`, and a question is
answered from either.  Answers are per member, under its newest description: versions of one
airport or plane count together.  Rows whose member was not found are a group of their own, without a name, so the
groups add up to the fact.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _flagged(column: str) -> Column:
    return F.coalesce(F.sum(column), F.lit(0.0)).cast("long")


def _delayed() -> Column:
    return F.count(F.when(F.col("total_delay") > 0, 1))


def _minutes(column: str) -> Column:
    return F.coalesce(F.sum(column), F.lit(0.0))


def _delay_sums() -> list[Column]:
    return [_delayed().alias("delayed_flights"), _minutes("total_delay").alias("delay_minutes")]


def _flight_sums() -> list[Column]:
    flags = [_flagged("diverted").alias("diverted_flights"), _flagged("cancelled").alias("cancelled_flights")]
    return [F.count("*").alias("flights"), *flags, *_delay_sums()]


def least_delayed_month(fact: DataFrame, dates: DataFrame) -> DataFrame:
    """The month of the year with the fewest delayed flights, then the fewest minutes."""
    return least_delayed_of(fact.groupBy("flight_date_key").agg(*_delay_sums()), dates)


def least_delayed_of(per_day: DataFrame, dates: DataFrame) -> DataFrame:
    months = per_day.join(
        dates.select(F.col("date_key").alias("flight_date_key"), "calendar_month"), "flight_date_key"
    )
    return (
        months.groupBy("calendar_month")
        .agg(F.sum("delayed_flights").alias("delayed_flights"), F.sum("delay_minutes").alias("delay_minutes"))
        .orderBy("delayed_flights", "delay_minutes", "calendar_month")
        .limit(1)
    )


def cancellation_reasons(flights: DataFrame) -> DataFrame:
    """Cancelled flights per reason.  The fact does not carry the reason, so this reads the raw flights."""
    cancelled = flights.where(F.col("Cancelled") == 1)
    return cancelled.groupBy(F.col("CancellationCode").alias("reason")).agg(F.count("*").alias("flights"))


def busiest_destinations(fact: DataFrame, airports: DataFrame, k: int = 10) -> DataFrame:
    """The ``k`` airports most flights go to."""
    arrivals = fact.groupBy("dest_airport_key").agg(F.count("*").alias("flights"))
    return busiest_of(arrivals, airports, k)


def busiest_of(sums: DataFrame, airports: DataFrame, k: int = 10) -> DataFrame:
    arrivals = sums.select(F.col("dest_airport_key").alias("airport_key"), "flights")
    return _per_airport(arrivals, airports).orderBy(F.desc("flights"), "code").limit(k)


def airline_dashboard(fact: DataFrame, airlines: DataFrame) -> DataFrame:
    """Flights, delays, diversions and taxi times per airline."""
    return airlines_of(airline_sums(fact), airlines)


def airline_sums(fact: DataFrame, *by: str) -> DataFrame:
    taxi = [f(c).alias(f"{c}_{n}") for c in ("taxi_in", "taxi_out") for n, f in (("sum", F.sum), ("count", F.count))]
    return fact.groupBy(*by, "airline_key").agg(
        F.count("*").alias("flights"), *_delay_sums(), _flagged("diverted").alias("diverted_flights"), *taxi
    )


def airlines_of(sums: DataFrame, airlines: DataFrame) -> DataFrame:
    named = sums.join(airlines.select("airline_key", "carrier", "airline_name"), "airline_key", "left")
    mean = {c: F.try_divide(F.col(f"{c}_sum"), F.col(f"{c}_count")).alias(f"avg_{c}") for c in ("taxi_in", "taxi_out")}
    counts = ("flights", "delayed_flights", "delay_minutes", "diverted_flights")
    return named.select("carrier", "airline_name", *counts, *mean.values())


def _per_airport(sums: DataFrame, airports: DataFrame) -> DataFrame:
    """Sums by ``airport_key`` as sums by airport; the newest version of one has the largest key."""
    named = sums.join(airports.select("airport_key", "code", "airport_name", "city"), "airport_key", "left")
    newest = [F.max_by(c, "airport_key").alias(c) for c in ("airport_name", "city")]
    return named.groupBy("code").agg(*newest, *[F.sum(c).alias(c) for c in sums.columns if c != "airport_key"])


AIRPORT_SUMS = ("departures", "cancelled_flights", "diverted_flights", "diversions_received")


def airport_sums(fact: DataFrame, *by: str) -> DataFrame:
    """Each use of an airport by the flights, added up by ``airport_key`` in one pass."""
    zero = F.lit(0.0)
    uses = [
        # airport, departures, cancelled, diverted away, diverted here; flights without a diversion name no airport
        (F.col("origin_airport_key"), F.lit(1.0), F.col("cancelled"), zero, zero),
        (F.col("dest_airport_key"), zero, zero, F.col("diverted"), zero),
        (F.col("div1_airport_key"), zero, zero, zero, F.col("div1_airport_key").isNotNull().cast("double")),
        (F.col("div2_airport_key"), zero, zero, zero, F.col("div2_airport_key").isNotNull().cast("double")),
    ]
    names = ["airport_key", *AIRPORT_SUMS]
    rows = [F.struct(*[c.alias(n) for c, n in zip(use, names, strict=True)]) for use in uses]
    uses = fact.select(*by, F.inline(F.array(*rows)))
    sums = uses.groupBy(*by, "airport_key").agg(*[_flagged(n).alias(n) for n in AIRPORT_SUMS])
    return sums.where(F.col("airport_key").isNotNull() | reduce(or_, [F.col(n) != 0 for n in AIRPORT_SUMS]))


def airport_dashboard(fact: DataFrame, airports: DataFrame) -> DataFrame:
    """Per airport: departures, cancelled departures, arrivals that were diverted, diversions it took in."""
    return airports_of(airport_sums(fact), airports)


def airports_of(sums: DataFrame, airports: DataFrame) -> DataFrame:
    return _per_airport(sums, airports).select("code", "airport_name", "city", *AIRPORT_SUMS)


def city_diversions(fact: DataFrame, airports: DataFrame) -> DataFrame:
    """Per city: flights to it that were diverted, and diversions its airports took in."""
    return cities_of(airport_sums(fact), airports)


def cities_of(sums: DataFrame, airports: DataFrame) -> DataFrame:
    per_airport = _per_airport(sums, airports)
    return per_airport.groupBy("city").agg(*[F.sum(c).alias(c) for c in ("diverted_flights", "diversions_received")])


PLANE_TRAITS = ("eng_mfr_name", "eng_model_name", "year_mfr", "registrant_city")


def plane_dashboard(fact: DataFrame, planes: DataFrame, by: Sequence[str] = PLANE_TRAITS) -> DataFrame:
    """Flights, diversions, cancellations and delays by engine, year built and owner's city."""
    return planes_of(plane_sums(fact), planes, by)


def plane_sums(fact: DataFrame, *by: str) -> DataFrame:
    return fact.groupBy(*by, "plane_key").agg(*_flight_sums())


def planes_of(per_plane: DataFrame, planes: DataFrame, by: Sequence[str] = PLANE_TRAITS) -> DataFrame:
    traits = per_plane.join(planes.select("plane_key", "n_number", *by), "plane_key", "left")
    return traits.groupBy(*by).agg(
        F.count_distinct("n_number").alias("planes"), *[F.sum(c).alias(c) for c in per_plane.columns if c != "plane_key"]
    )


def holiday_trend(fact: DataFrame, dates: DataFrame) -> DataFrame:
    """Flights, cancellations and delays on holidays and on other days."""
    return holidays_of(day_sums(fact), dates)


def day_sums(fact: DataFrame, *by: str) -> DataFrame:
    return fact.groupBy(*by, "flight_date_key").agg(*_flight_sums())


def holidays_of(per_day: DataFrame, dates: DataFrame) -> DataFrame:
    days = per_day.join(
        dates.select(F.col("date_key").alias("flight_date_key"), "holiday_indicator"), "flight_date_key"
    )
    return days.groupBy("holiday_indicator").agg(
        F.count("*").alias("days"),
        *[F.sum(c).alias(c) for c in per_day.columns if c != "flight_date_key"],
        (F.sum("flights") / F.count("*")).alias("flights_per_day"),
    )


def route_dashboard(fact: DataFrame, airports: DataFrame) -> DataFrame:
    """Flights, diversions, cancellations and delays per origin and destination."""
    return routes_of(route_sums(fact), airports)


def route_sums(fact: DataFrame, *by: str) -> DataFrame:
    return fact.groupBy(*by, "origin_airport_key", "dest_airport_key").agg(*_flight_sums())


def routes_of(routes: DataFrame, airports: DataFrame) -> DataFrame:
    ends = {
        role: airports.select(
            F.col("airport_key").alias(f"{role}_airport_key"),
            F.col("code").alias(f"{role}_code"),
            F.col("city").alias(f"{role}_city"),
        )
        for role in ("origin", "dest")
    }
    named = routes.join(ends["origin"], "origin_airport_key", "left").join(ends["dest"], "dest_airport_key", "left")
    sums = [c for c in routes.columns if not c.endswith("_airport_key")]
    return named.select("origin_code", "origin_city", "dest_code", "dest_city", *sums)


def monthly_dashboard(fact: DataFrame, months: DataFrame) -> DataFrame:
    """Freight, passengers and mail per month."""
    return months_of(month_sums(fact), months)


def month_sums(fact: DataFrame, *by: str) -> DataFrame:
    keys = dict.fromkeys([*by, "monthly_key"])
    return fact.groupBy(*keys).agg(*[F.sum(m).alias(m) for m in ("freight", "passengers", "mail")])


def months_of(sums: DataFrame, months: DataFrame) -> DataFrame:
    return sums.join(months, "monthly_key", "left").select("year", "quarter", "month", "freight", "passengers", "mail")
