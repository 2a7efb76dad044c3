"""The load on storage: raw extracts -> staging tables -> dimensions and facts.

``lake/landing/<table>`` holds the last extract of each table as Parquet, rejected lines beside it, ``lake/staging/<table>``
the staged dimensions, ``lake/presentation/<table>`` the warehouse.  The text of an extract is parsed one time only, and its
lines are counted by the job that lands them.

Facts are merged: of a flight, or of an airline, route and month, the latest delivery counts, and a late row leaves the
others of its day alone.  Only days and months with delivered rows are read and written.  Calendars are extended, never
numbered anew, so the keys in older facts stay right.  Landed and staged tables, dimensions and calendars are written as
complete versions; of each the last two are kept.
"""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass
from datetime import date
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import schemas
from ..operators.audit import load_audit
from ..operators.calendar import (
    date_dimension,
    date_span,
    extended_months,
    extended_span,
    keep_keys,
    month_span,
    monthly_dimension,
    parse_calendar,
    time_dimension,
)
from ..operators.corrections import IDENTITY, MERGE_STEPS, Merge, identity, merge_fact
from ..operators.lookups import one_per_key
from ..operators.scd2 import scd2_initial, scd2_merge
from ..schemas import AIRLINE, AIRPORT, PLANE, DimSpec
from ..sources import Landed, current_version, exists, land, prune_versions, read_table, replace_table
from .facts import DAILY_COLUMNS, MONTHLY_COLUMNS, Dimensions, daily_fact, fact_schema, monthly_fact
from .staging import stage_airline, stage_airport, stage_plane


@dataclass(frozen=True)
class Extract:
    """Where a raw table lies and how its fields are set apart."""

    path: str
    sep: str = ","
    date_format: str = "yyyy-MM-dd"


@dataclass(frozen=True)
class RawZone:
    """The raw extracts of one delivery.  Calendars that are not delivered are generated."""

    flights: Extract
    airlines: Extract
    airports: Extract
    wac: Extract
    planes: Extract
    engines: Extract
    passengers: Extract
    dates: Extract | None = None
    times: Extract | None = None


def raw_zone(
    root: str,
    flights_sep: str = ",",
    date_format: str = "yyyy-MM-dd",
    calendars: bool = False,
    calendar_format: str = "dd/MM/yyyy",
) -> RawZone:
    """The usual layout below one directory; with ``calendars`` the date and time tables are delivered too."""
    delivered = {"dates": Extract(f"{root}/date", ";", calendar_format), "times": Extract(f"{root}/time", ";")}
    return RawZone(
        flights=Extract(f"{root}/flights", flights_sep, date_format),
        airlines=Extract(f"{root}/airline"),
        airports=Extract(f"{root}/airports"),
        wac=Extract(f"{root}/wac", ";"),
        planes=Extract(f"{root}/planes"),
        engines=Extract(f"{root}/engines"),
        passengers=Extract(f"{root}/passengers"),
        **(delivered if calendars else {}),
    )


#: The columns that say which flight, or which monthly figure, a row is about.
FLIGHT_IDENTITY = ("FlightDate", "Carrier", "OriginAirportID", "DestAirportID", "CRSDepTime")
MONTHLY_IDENTITY = ("carrier", "origin_airport_id", "dest_airport_id", "year", "month")

_SCHEMAS = {
    "flights": schemas.FLIGHTS,
    "airlines": schemas.AIRLINES,
    "airports": schemas.AIRPORTS,
    "wac": schemas.WAC,
    "planes": schemas.PLANES,
    "engines": schemas.ENGINES,
    "passengers": schemas.PASSENGERS,
    "dates": schemas.DATES,
    "times": schemas.TIMES,
}


def land_extracts(spark: SparkSession, raw: RawZone, lake: str, max_rejected: float = 0.0) -> dict[str, Landed]:
    """All extracts of a delivery as Parquet; one with more than the share ``max_rejected`` of bad lines stops the load."""
    landed = {}
    for name, schema in _SCHEMAS.items():
        extract = getattr(raw, name)
        if extract is not None:
            # The days of a calendar stay text here, in a form of their own.
            form = "yyyy-MM-dd" if name == "dates" else extract.date_format
            root = f"{lake}/landing/{name}"
            landed[name] = land(spark, extract.path, root, schema, extract.sep, form, max_rejected=max_rejected)
    return landed


def load_dimension(
    spark: SparkSession,
    root: str,
    staging: DataFrame,
    spec: DimSpec,
    as_of: date,
    change: str = "attributes",
) -> DataFrame:
    """First load or merge of one dimension; returns the new version as stored.

    The members of a first load and the delta of a merge are kept next to the table, as ``<root>_delta``.
    """

    def store(delta: DataFrame) -> DataFrame:
        return replace_table(delta, f"{root}_delta")

    if current_version(spark, root) is None:
        return replace_table(scd2_initial(staging, spec, as_of, store), root)
    return replace_table(scd2_merge(read_table(spark, root), staging, spec, as_of, change, store), root)


def _staged(rows: DataFrame, lake: str, name: str) -> DataFrame:
    return replace_table(rows, f"{lake}/staging/{name}")


def stage_dimensions(landed: Mapping[str, Landed], lake: str) -> dict[str, DataFrame]:
    """Write the three staged dimension deliveries and return them read back."""
    rows = {name: extract.rows for name, extract in landed.items()}
    staged = {
        AIRLINE.name: stage_airline(rows["airlines"]),
        AIRPORT.name: stage_airport(rows["airports"], rows["flights"], rows["wac"]),
        PLANE.name: stage_plane(rows["planes"], rows["engines"]),
    }
    return {name: _staged(frame, lake, name) for name, frame in staged.items()}


def load_calendars(
    spark: SparkSession, raw: RawZone, lake: str, landed: Mapping[str, Landed]
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Date, time and month dimensions, delivered or generated over the days of the flights and months of passengers.

    What is stored stays with its keys, also where a delivered calendar numbers a day otherwise, and no two days share one,
    see :func:`keep_keys`.  A delivered calendar keeps one row per day and per clock time, as a second one would double the
    flights; stored days it does not have are kept beside it.
    """
    roots = [f"{lake}/presentation/{name}_dimension" for name in ("date", "time", "monthly")]
    old_dates, old_times, old_months = (
        read_table(spark, root) if current_version(spark, root) is not None else None for root in roots
    )
    if raw.dates is not None:
        delivered = parse_calendar(landed["dates"].rows, raw.dates.date_format)
        dates = one_per_key(delivered, ["date"])
    else:
        spans = [date_span(landed["flights"].rows, "FlightDate"), month_span(landed["passengers"].rows, "year", "month")]
        dates = date_dimension(extended_span(spans, old_dates))
    clock = ["hour", "minute", "second"]
    times = time_dimension(spark) if raw.times is None else one_per_key(landed["times"].rows, clock)
    dates = replace_table(keep_keys(dates, old_dates, "date_key", ["date"]), roots[0])
    times = replace_table(keep_keys(times, old_times, "time_key", clock), roots[1])
    months = monthly_dimension(dates) if old_months is None else extended_months(dates, old_months)
    return dates, times, replace_table(months, roots[2])


def read_fact(spark: SparkSession, lake: str, name: str) -> DataFrame:
    """The rows of all deliveries of ``flight_fact`` or ``monthly_flight_fact``."""
    return spark.read.schema(fact_schema(FACT_COLUMNS[name])).parquet(f"{lake}/presentation/{name}")


#: The fact tables and the column that says which part of them a delivery replaces.
FACTS = {"flight_fact": "flight_date_key", "monthly_flight_fact": "monthly_key"}
FACT_COLUMNS = {"flight_fact": DAILY_COLUMNS, "monthly_flight_fact": MONTHLY_COLUMNS}


def _merged_facts(
    spark: SparkSession, lake: str, landed: Mapping[str, Landed], dims: Dimensions, as_of: date, point_in_time: bool
) -> dict[str, Merge]:
    flights = landed["flights"].rows.withColumn(IDENTITY, identity(*FLIGHT_IDENTITY))
    codes = {c: F.lower(c) for c in MONTHLY_IDENTITY if c.endswith("airport_id")}
    passengers = landed["passengers"].rows.withColumns(codes).withColumn(IDENTITY, identity(*MONTHLY_IDENTITY))
    facts = {
        "flight_fact": daily_fact(flights, dims, point_in_time=point_in_time, keep=[IDENTITY]),
        "monthly_flight_fact": monthly_fact(passengers, dims, point_in_time=point_in_time, keep=[IDENTITY]),
    }
    done = {}
    for name, rows in facts.items():
        path, work = f"{lake}/presentation/{name}", f"{lake}/work/{name}"
        schema = fact_schema(FACT_COLUMNS[name])
        done[name] = merge_fact(spark, path, rows, FACTS[name], as_of, schema, work)
        for step in MERGE_STEPS:
            prune_versions(spark, f"{work}/{step}", keep=1)
    return done


def load_warehouse(
    spark: SparkSession,
    raw: RawZone,
    lake: str,
    as_of: date,
    plane_change: str = "attributes",
    max_rejected: float = 0.0,
    point_in_time: bool = False,
) -> DataFrame:
    """One delivery from raw to presentation; returns an audit row per table.

    ``rows_before`` and ``row_count`` are the rows of the table before and after the load; ``rows_read`` the lines of its
    extract, ``rows_rejected`` those of them that could not be used: malformed, without natural key, further rows of a
    member, or on a day the calendar does not have; ``rows_replaced`` the rows of a fact that later ones took the place
    of.  Passengers are added up, so their rows read are more than those written.

    A load goes on if at most the share ``max_rejected`` of each extract is malformed.  With ``point_in_time`` the facts get
    the versions that were valid on their day, else the open ones.
    """
    landed = land_extracts(spark, raw, lake, max_rejected)
    staged = stage_dimensions(landed, lake)
    before = _row_counts(spark, lake)
    modes = {AIRLINE: "attributes", AIRPORT: "attributes", PLANE: plane_change}
    loaded = {
        spec: load_dimension(spark, f"{lake}/presentation/{spec.name}", staged[spec.name], spec, as_of, mode)
        for spec, mode in modes.items()
    }
    dates, times, months = load_calendars(spark, raw, lake, landed)
    dims = Dimensions(loaded[AIRLINE], loaded[AIRPORT], loaded[PLANE], dates, times, months).measured()
    merges = _merged_facts(spark, lake, landed, dims, as_of, point_in_time)
    for name in [*(spec.name for spec in modes), "date_dimension", "time_dimension", "monthly_dimension"]:
        for root in (f"{lake}/presentation/{name}", f"{lake}/presentation/{name}_delta", f"{lake}/staging/{name}"):
            prune_versions(spark, root)
    for name in landed:
        prune_versions(spark, f"{lake}/landing/{name}")

    tables = {spec.name: (frame, spec.key) for spec, frame in loaded.items()}
    tables |= {"date_dimension": (dates, "date_key"), "time_dimension": (times, "time_key")}
    tables |= {"monthly_dimension": (months, "monthly_key")}
    tables |= {name: (read_fact(spark, lake, name), key) for name, key in FACTS.items()}
    extracts = {AIRLINE.name: "airlines", AIRPORT.name: "airports", PLANE.name: "planes"}
    extracts |= {"flight_fact": "flights", "monthly_flight_fact": "passengers"}
    members = {spec.name: staged[spec.name].select(*spec.natural_key).distinct() for spec in modes}
    audits = []
    for name, (frame, key) in tables.items():
        read = landed[extracts[name]].rows_read if name in extracts else None
        malformed = landed[extracts[name]].rows_rejected if name in extracts else None
        rejected = F.lit(malformed).cast("long")
        if name in members:
            rejected = F.lit(read).cast("long") - members[name].agg(F.count("*")).scalar()
        elif name == "flight_fact":
            rejected = F.lit(read - merges[name].rows_delivered).cast("long")
        audits.append(
            load_audit(frame, key).select(
                F.lit(name).alias("table_name"),
                "*",
                F.lit(before.get(name, 0)).cast("long").alias("rows_before"),
                F.lit(read).cast("long").alias("rows_read"),
                rejected.alias("rows_rejected"),
                F.lit(merges[name].rows_replaced if name in merges else None).cast("long").alias("rows_replaced"),
            )
        )
    return reduce(DataFrame.unionByName, audits)


def _row_counts(spark: SparkSession, lake: str) -> dict[str, int]:
    """Rows of the tables that are already there."""
    counts = {}
    for name in (AIRLINE.name, AIRPORT.name, PLANE.name, "date_dimension", "time_dimension", "monthly_dimension"):
        root = f"{lake}/presentation/{name}"
        if current_version(spark, root) is not None:
            counts[name] = read_table(spark, root).count()
    for name in FACTS:
        if exists(spark, f"{lake}/presentation/{name}"):
            counts[name] = read_fact(spark, lake, name).count()
    return counts
