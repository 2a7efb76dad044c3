"""Declared schemas of the raw extracts and descriptions of the versioned dimensions.

Raw types are stated rather than inferred: inference reads every file twice and lets the data decide the
join types.  Airport ids are text on every side because the staged code is lower-cased text that may be the
filler word.
"""

from __future__ import annotations

from dataclasses import dataclass

# DepTime is a number with decimals because extracts with gaps write 845 as 845.0.
FLIGHTS = """
    FlightDate date, Carrier string, TailNum string, OriginAirportID string, OriginState string,
    OriginStateName string, OriginWac int, DestAirportID string, CRSDepTime int, DepTime double,
    Cancelled double, CancellationCode string, Diverted double, AirTime double,
    WeatherDelay double, NASDelay double, SecurityDelay double, LateAircraftDelay double,
    TaxiIn double, TaxiOut double,
    Div1AirportID string, Div1TailNum string, Div2AirportID string, Div2TailNum string
"""

AIRLINES = "Code string, Description string"

AIRPORTS = "Code string, Description string"

WAC = "world_area_code int, country string"

PLANES = """
    `N-Number` string, `Serial Number` string, Name string, `MFR MDL Code` string, `Year MFR` int,
    City string, State string, `Street 1` string, `Eng MFR Code` int
"""

ENGINES = "`Eng MFR Code` int, `eng mfr name` string, `engine model name` string, horsepower int"

PASSENGERS = """
    carrier string, origin_airport_id string, dest_airport_id string, year int, month int,
    freight double, passengers double, mail double
"""

# `date` stays text here: the extract writes day/month/year text, see calendar.parse_calendar.
DATES = """
    date_key int, full_date_description string, date string, day_of_week int, calendar_month int,
    calenda_quarter int, calendar_year int, holiday_indicator string, weekday_indicator string
"""

TIMES = """
    time_key int, time_24h string, hour int, minute int, second int, hour_12 int, time_ampm string,
    meridian_indicator string, period string
"""


@dataclass(frozen=True)
class DimSpec:
    """A dimension that keeps history: which columns identify a member and which describe it."""

    name: str
    key: str
    natural_key: tuple[str, ...]
    attributes: tuple[str, ...]

    @property
    def columns(self) -> list[str]:
        return [self.key, *self.natural_key, *self.attributes, "start_date", "end_date", "current_flag"]


AIRLINE = DimSpec("airline_dimension", "airline_key", ("carrier",), ("airline_name",))

AIRPORT = DimSpec(
    "airport_dimension",
    "airport_key",
    ("code",),
    ("airport_name", "city", "state_code", "state_name", "wac", "country"),
)

PLANE = DimSpec(
    "plane_dimension",
    "plane_key",
    ("n_number",),
    (
        "serial_number",
        "aircraft_name",
        "aircraft_mfr_model",
        "year_mfr",
        "registrant_city",
        "registrant_state",
        "registrant_street",
        "eng_mfr_model_code",
        "eng_mfr_name",
        "eng_model_name",
        "eng_horse_power",
    ),
)
