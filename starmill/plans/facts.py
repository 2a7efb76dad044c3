"""The two fact tables: one row per flight, and monthly loads per airline and route."""

from __future__ import annotations

from collections.abc import Callable, Collection, Mapping, Sequence
from dataclasses import dataclass, field, fields, replace
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.clock import hhmm_hour, hhmm_minute
from ..functions.measures import DELAY_PARTS, total_delay
from ..operators.lookups import BROADCAST_BYTES, current, hot_keys, lookup, measured_bytes, within
from ..operators.validity import packed_versions, version_on


@dataclass(frozen=True)
class Dimensions:
    """The dimension tables a fact load looks its keys up in; one it does not use may be left out.

    ``sizes`` holds the measured bytes of the keys, see :meth:`measured`; without it every load measures anew.
    """

    airline: DataFrame | None = None
    airport: DataFrame | None = None
    plane: DataFrame | None = None
    date: DataFrame | None = None
    time: DataFrame | None = None
    month: DataFrame | None = None
    sizes: Mapping[str, int] = field(default_factory=dict)

    def measured(self) -> Dimensions:
        """The same tables with the sizes of their keys, for several loads over one stored version."""
        tables = _key_tables(self, {f.name for f in fields(self)[:-1] if getattr(self, f.name) is not None})
        return replace(self, sizes=_sizes(tables))


@dataclass(frozen=True)
class Role:
    """One use of a dimension: the fact columns that find a member, and the columns they meet."""

    dimension: str
    on: dict[str, str]


DATE_ROLE = Role("date", {"FlightDate": "date"})

# Output key -> the lookup that finds it.  The same dimension serves several roles.
DAILY_ROLES = {
    "airline_key": Role("airline", {"Carrier": "carrier"}),
    "origin_airport_key": Role("airport", {"OriginAirportID": "code"}),
    "dest_airport_key": Role("airport", {"DestAirportID": "code"}),
    "div1_airport_key": Role("airport", {"Div1AirportID": "code"}),
    "div2_airport_key": Role("airport", {"Div2AirportID": "code"}),
    "actual_dep_time_key": Role("time", {"_dep_hour": "hour", "_dep_minute": "minute"}),
    "crs_dep_time_key": Role("time", {"_crs_hour": "hour", "_crs_minute": "minute"}),
    "plane_key": Role("plane", {"TailNum": "n_number"}),
    "div1_plane_key": Role("plane", {"Div1TailNum": "n_number"}),
    "div2_plane_key": Role("plane", {"Div2TailNum": "n_number"}),
}

MONTHLY_ROLES = {
    "airline_key": Role("airline", {"carrier": "carrier"}),
    "origin_airport_key": Role("airport", {"origin_airport_id": "code"}),
    "dest_airport_key": Role("airport", {"dest_airport_id": "code"}),
    "monthly_key": Role("month", {"year": "year", "month": "month"}),
}

CLOCKS = {
    "_dep_hour": ("DepTime", hhmm_hour),
    "_dep_minute": ("DepTime", hhmm_minute),
    "_crs_hour": ("CRSDepTime", hhmm_hour),
    "_crs_minute": ("CRSDepTime", hhmm_minute),
}

# Output measure -> flight column.
DAILY_MEASURES = {
    "cancelled": "Cancelled",
    "diverted": "Diverted",
    "air_time": "AirTime",
    "weather_delay": "WeatherDelay",
    "nas_delay": "NASDelay",
    "security_delay": "SecurityDelay",
    "late_aircraft_delay": "LateAircraftDelay",
    "taxi_in": "TaxiIn",
    "taxi_out": "TaxiOut",
}

MONTHLY_MEASURES = ("freight", "passengers", "mail")

DAILY_COLUMNS = (
    "airline_key",
    "plane_key",
    "flight_date_key",
    "origin_airport_key",
    "dest_airport_key",
    "actual_dep_time_key",
    "crs_dep_time_key",
    "cancelled",
    "diverted",
    "air_time",
    "weather_delay",
    "nas_delay",
    "security_delay",
    "late_aircraft_delay",
    "total_delay",
    "taxi_in",
    "taxi_out",
    "div1_airport_key",
    "div1_plane_key",
    "div2_airport_key",
    "div2_plane_key",
)


MONTHLY_COLUMNS = ("airline_key", *MONTHLY_MEASURES, "origin_airport_key", "dest_airport_key", "monthly_key")


#: The number of a stored row while its roles are looked up.
_ROW = "_row_number"


def fact_schema(columns: Sequence[str]) -> str:
    """The types of fact columns: calendar keys are int, other keys long, measures double."""
    small = ("flight_date_key", "actual_dep_time_key", "crs_dep_time_key")
    kinds = {c: "int" if c in small else "long" if c.endswith("_key") else "double" for c in columns}
    return ", ".join(f"{c} {kind}" for c, kind in kinds.items())


#: Dimensions that keep versions: natural key and surrogate key.
VERSIONED = {"airline": ("carrier", "airline_key"), "airport": ("code", "airport_key"), "plane": ("n_number", "plane_key")}


def _key_tables(dims: Dimensions, names: Collection[str], packed: bool = False) -> dict[str, DataFrame]:
    """For each dimension used, its natural key and its surrogate key alone, the latter always named alike.

    Roles of one dimension then differ in column names only, so Spark can reuse one broadcast for several.
    With ``packed`` the surrogate of a versioned dimension is the array of all its versions.
    """
    if packed:
        versioned = {
            name: packed_versions(getattr(dims, name), [natural], key).withColumnRenamed("versions", "surrogate")
            for name, (natural, key) in VERSIONED.items()
            if name in names
        }
        return versioned | _key_tables(dims, set(names) - set(versioned))
    build = {
        "airline": lambda: current(dims.airline).select("carrier", F.col("airline_key").alias("surrogate")),
        "airport": lambda: current(dims.airport).select("code", F.col("airport_key").alias("surrogate")),
        "plane": lambda: current(dims.plane).select("n_number", F.col("plane_key").alias("surrogate")),
        "date": lambda: dims.date.select("date", F.col("date_key").alias("surrogate")),
        # Clock values have no seconds, so only the full minutes can be met.
        "time": lambda: dims.time.where("second = 0").select("hour", "minute", F.col("time_key").alias("surrogate")),
        "month": lambda: dims.month.select("year", "month", F.col("monthly_key").alias("surrogate")),
    }
    return {name: build[name]() for name in sorted(names)}


def _sizes(tables: Mapping[str, DataFrame]) -> dict[str, int]:
    return dict(zip(tables, measured_bytes(*tables.values()), strict=True))


def _find_keys(
    rows: DataFrame,
    dims: Dimensions,
    roles: dict[str, Role],
    inner: Sequence[str] = (),
    limit_bytes: int = BROADCAST_BYTES,
    store: Callable[[DataFrame], DataFrame] | None = None,
    valid_on: Column | None = None,
    reach_back: bool = False,
) -> DataFrame:
    """Look up all roles.  The tables that are broadcast have ``limit_bytes`` together.

    If others are left, the frequent keys of ``rows`` are counted before ``rows`` is joined; ``store`` writes computed
    rows somewhere first, so that what computes them runs once.  With the day ``valid_on`` the version of that day is
    found among all versions of a member, else its open one.
    """
    tables = _key_tables(dims, {role.dimension for role in roles.values()}, packed=valid_on is not None)
    sizes = dims.sizes if valid_on is None and dims.sizes else _sizes(tables)
    small = within({name: sizes[name] for name in tables}, limit_bytes)
    large = {target: list(role.on) for target, role in roles.items() if role.dimension not in small}
    shared = _shared(roles, large, inner) if store else {}
    if large and store:
        # Rows that are joined with themselves need a number that stays.
        rows = store(rows.withColumn(_ROW, F.monotonically_increasing_id()) if shared else rows)
    at_once = [target for targets in shared.values() for target in targets]
    hot = hot_keys(rows, {target: columns for target, columns in large.items() if target not in at_once})
    for dimension, targets in shared.items():
        day = valid_on if dimension in VERSIONED else None
        rows = _roles_at_once(rows, tables[dimension], {t: roles[t] for t in targets}, limit_bytes, day, reach_back)
    for target, role in roles.items():
        if target in at_once:
            continue
        rows = lookup(
            rows,
            tables[role.dimension],
            role.on,
            {target: "surrogate"},
            how="inner" if target in inner else "left",
            table_bytes=0 if role.dimension in small else limit_bytes + 1,
            hot=hot.get(target),
            limit_bytes=limit_bytes,
        )
        if valid_on is not None and role.dimension in VERSIONED:
            rows = rows.withColumn(target, version_on(F.col(target), valid_on, reach_back))
    return rows.drop(_ROW)


def _shared(roles: Mapping[str, Role], large: Collection[str], inner: Sequence[str]) -> dict[str, list[str]]:
    """Large dimensions that several roles look for a key in, and these roles."""
    found: dict[str, list[str]] = {}
    for target, role in roles.items():
        if target in large and target not in inner:
            found.setdefault(role.dimension, []).append(target)
    return {dimension: targets for dimension, targets in found.items() if len(targets) > 1}


def _roles_at_once(
    rows: DataFrame,
    table: DataFrame,
    roles: Mapping[str, Role],
    limit_bytes: int,
    valid_on: Column | None = None,
    reach_back: bool = False,
) -> DataFrame:
    """Look up several roles of one large dimension while ``rows``, which have a number, are shuffled once.

    Each key that is there becomes a row of its own, (row number, role, key), and only these narrow rows meet the
    dimension.  What they find is put side by side per row number and joined to the rows by it.  With the day ``valid_on``
    they carry it, and the version is chosen where they meet the dimension, so that one number goes on rather than all
    versions.
    """
    names = list(next(iter(roles.values())).on.values())
    uses = [
        F.struct(F.lit(number).alias("role"), *[F.col(c).alias(n) for c, n in role.on.items()])
        for number, role in enumerate(roles.values())
    ]
    there = F.filter(F.array(*uses), lambda use: reduce(and_, [use[n].isNotNull() for n in names]))
    day = [] if valid_on is None else [valid_on.alias("_day")]
    keys = rows.select(_ROW, *day, F.inline(there))
    hot = hot_keys(keys, {"key": names})["key"]
    on = {n: n for n in names}
    found = lookup(keys, table, on, {"surrogate": "surrogate"}, "inner", limit_bytes + 1, hot, limit_bytes)
    if valid_on is not None:
        found = found.select(_ROW, "role", version_on(F.col("surrogate"), F.col("_day"), reach_back).alias("surrogate"))
    # A row has one key per role and a key one table row, so the largest number is the only one; a maximum is hashed.
    side_by_side = [F.max(F.when(F.col("role") == n, F.col("surrogate"))).alias(t) for n, t in enumerate(roles)]
    return rows.join(found.groupBy(_ROW).agg(*side_by_side), _ROW, "left")


def date_lookup(flights: DataFrame, dates: DataFrame) -> DataFrame:
    """Add ``flight_date_key``.  Flights on a day the calendar does not have are lost."""
    return _find_keys(flights, Dimensions(date=dates), {"flight_date_key": DATE_ROLE}, inner=["flight_date_key"])


def _daily_roles(columns: Sequence[str]) -> dict[str, Role]:
    """The lookups ``columns`` need.  The calendar always: it decides which flights stay."""
    return {"flight_date_key": DATE_ROLE} | {k: role for k, role in DAILY_ROLES.items() if k in columns}


def flight_columns(columns: Sequence[str] = DAILY_COLUMNS) -> set[str]:
    """The raw flight columns from which ``columns`` of the daily fact are computed."""
    looked_up = {c for role in _daily_roles(columns).values() for c in role.on}
    raw = {CLOCKS[c][0] if c in CLOCKS else c for c in looked_up}
    raw |= {DAILY_MEASURES[c] for c in columns if c in DAILY_MEASURES}
    return raw | set(DELAY_PARTS if "total_delay" in columns else ())


def _airport_codes(roles: Mapping[str, Role]) -> dict[str, Column]:
    """Airport codes in the case of the dimension."""
    return {c: F.lower(c) for role in roles.values() if role.dimension == "airport" for c in role.on}


def daily_fact(
    flights: DataFrame,
    dims: Dimensions,
    columns: Sequence[str] = DAILY_COLUMNS,
    limit_bytes: int = BROADCAST_BYTES,
    store: Callable[[DataFrame], DataFrame] | None = None,
    point_in_time: bool = False,
    reach_back: bool = False,
    keep: Sequence[str] = (),
) -> DataFrame:
    """One row per flight: dimension keys and measures.

    ``columns`` narrows the result; lookups whose key is not asked for are not run.  A key with no open
    member is NULL.  Give ``store`` where the flights are computed rather than stored, see :func:`_find_keys`.

    With ``point_in_time`` airlines, airports and planes are those of the flight's day: a load of old flights gets the
    versions of then.  A flight before the first version of a member has a NULL key, or with ``reach_back`` that version.
    ``keep`` names further columns of the flights that the result has after ``columns``.
    """
    roles = _daily_roles(columns)
    decoded = {c: CLOCKS[c] for role in roles.values() for c in role.on if c in CLOCKS}
    clocks = {name: part(F.col(source).cast("int")) for name, (source, part) in decoded.items()}
    flights = flights.select(*sorted(flight_columns(columns)), *keep).withColumns(clocks | _airport_codes(roles))
    valid_on = F.col("FlightDate") if point_in_time else None
    keyed = _find_keys(flights, dims, roles, ["flight_date_key"], limit_bytes, store, valid_on, reach_back)
    measures = {name: F.col(source) for name, source in DAILY_MEASURES.items()}
    measures["total_delay"] = total_delay(*DELAY_PARTS)
    return keyed.select(*[measures[c].alias(c) if c in measures else F.col(c) for c in (*columns, *keep)])


def monthly_fact(
    passengers: DataFrame,
    dims: Dimensions,
    dedupe: bool = False,
    limit_bytes: int = BROADCAST_BYTES,
    store: Callable[[DataFrame], DataFrame] | None = None,
    point_in_time: bool = False,
    reach_back: bool = False,
    keep: Sequence[str] = (),
) -> DataFrame:
    """Freight, passengers and mail per airline, route and month.

    Deliveries of the same airline, route and month are added up before any key is looked up.  With
    ``dedupe`` rows stay as delivered and only equal ones are merged, which loses the second of two equal
    deliveries.  With ``point_in_time`` keys are those of the versions valid on the first of the month, see
    :func:`daily_fact`.  ``keep`` names columns that airline, route and month determine.
    """
    grain = [column for role in MONTHLY_ROLES.values() for column in role.on]
    passengers = passengers.withColumns(_airport_codes(MONTHLY_ROLES))
    if not dedupe:
        passengers = passengers.groupBy(*grain, *keep).agg(*[F.sum(m).alias(m) for m in MONTHLY_MEASURES])
    else:
        passengers = passengers.select(*grain, *keep, *MONTHLY_MEASURES)
    valid_on = F.make_date("year", "month", F.lit(1)) if point_in_time else None
    keyed = _find_keys(
        passengers, dims, MONTHLY_ROLES, (), limit_bytes, store, valid_on, reach_back
    ).select(*MONTHLY_COLUMNS, *keep)
    return keyed.distinct() if dedupe else keyed
