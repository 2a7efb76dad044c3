"""Raw extracts to staged dimension rows.

Rows without natural key name no member and are left out; NULLs in attributes become the filler word.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.text import fill_undefined, lower_columns, parse_place
from ..operators.lookups import lookup, one_per_key
from ..schemas import PLANE


def stage_airline(airlines: DataFrame) -> DataFrame:
    """Carrier code and lower-cased name.

    Flights contribute neither rows nor columns to this table, so they are not read.
    """
    named = airlines.select(F.col("Code").alias("carrier"), F.lower("Description").alias("airline_name"))
    return fill_undefined(named.where("carrier IS NOT NULL").distinct())


def flight_airports(flights: DataFrame) -> DataFrame:
    """State and world area of each airport flights leave from, one row per airport.

    Where flights disagree, what most of them say counts, and the smallest of what equally many say.
    Counting hashes the flights where they lie; only a few rows per airport are shuffled and compared.
    """
    said = ["state_code", "state_name", "wac"]
    seen = flights.where(F.col("OriginAirportID").isNotNull()).groupBy(
        F.lower("OriginAirportID").alias("code"),
        F.col("OriginState").alias("state_code"),
        F.col("OriginStateName").alias("state_name"),
        F.col("OriginWac").alias("wac"),
    )
    counted = seen.agg((-F.count("*")).alias("rank"))
    return one_per_key(counted.select("code", "rank", *said), ["code"]).select("code", *said)


def stage_airport(airports: DataFrame, flights: DataFrame, wac: DataFrame) -> DataFrame:
    """Airports with their place text taken apart, their state from the flights and their country.

    Codes are lower-cased, as are those of flights and passengers wherever they are looked up.
    """
    countries = one_per_key(wac.select("world_area_code", "country"), ["world_area_code"])
    placed = parse_place(airports.where("Code IS NOT NULL"), "Description").select(
        F.lower("Code").alias("code"), F.col("place_name").alias("airport_name"), "city"
    )
    # The flight side has one row per airport and is shuffled by code already.  Measuring it for a broadcast
    # would read the flights a second time; adaptive execution sees its size when it is there.
    located = placed.distinct().join(flight_airports(flights), "code", "left")
    with_country = lookup(located, countries, on={"wac": "world_area_code"}, take={"country": "country"})
    text = ["airport_name", "city", "state_code", "state_name", "country"]
    staged = lower_columns(with_country, text)
    return fill_undefined(
        staged.select("code", "airport_name", "city", "state_code", "state_name", "wac", "country").distinct()
    )


def stage_plane(planes: DataFrame, engines: DataFrame) -> DataFrame:
    """Registered aircraft with the make, model and power of their engine."""
    registered = planes.where("`N-Number` IS NOT NULL").select(
        F.col("N-Number").alias("n_number"),
        F.col("Serial Number").alias("serial_number"),
        F.lower("Name").alias("aircraft_name"),
        F.col("MFR MDL Code").alias("aircraft_mfr_model"),
        F.col("Year MFR").alias("year_mfr"),
        F.lower("City").alias("registrant_city"),
        F.lower("State").alias("registrant_state"),
        F.lower("Street 1").alias("registrant_street"),
        F.col("Eng MFR Code").alias("eng_mfr_model_code"),
    )
    makes = one_per_key(
        engines.select(
            F.col("Eng MFR Code").alias("code"),
            F.lower("eng mfr name").alias("eng_mfr_name"),
            F.lower("engine model name").alias("eng_model_name"),
            F.col("horsepower").alias("eng_horse_power"),
        ),
        ["code"],
    )
    take = ["eng_mfr_name", "eng_model_name", "eng_horse_power"]
    powered = lookup(registered.distinct(), makes, on={"eng_mfr_model_code": "code"}, take={c: c for c in take})
    return fill_undefined(powered.select("n_number", *PLANE.attributes))
