from __future__ import annotations

from datetime import date

import pytest
from pyspark.sql import functions as F

from starmill.operators.calendar import date_dimension, literal_span, monthly_dimension, time_dimension
from starmill.operators.lookups import within
from starmill.operators.scd2 import scd2_initial, scd2_merge
from starmill.plans import dashboards
from starmill.plans.facts import DAILY_COLUMNS, Dimensions, daily_fact, flight_columns, monthly_fact
from starmill.schemas import AIRLINE, AIRPORT, FLIGHTS, PASSENGERS, PLANE
from starmill.sources import scratch_root, write_table

D1, D2 = date(2024, 1, 1), date(2024, 2, 1)


def plane(n_number):
    return (n_number, "s", "a", "m", 2000, "c", "st", "str", 1, "e", "em", 100)


def stored(df):
    path = scratch_root(df.sparkSession)
    write_table(df, path)
    return df.sparkSession.read.parquet(path)


@pytest.fixture(scope="module")
def dims(spark):
    """Dimensions with closed versions among them, so that a lookup of closed ones would show."""
    carriers = "carrier string, airline_name string"
    airlines = scd2_initial(spark.createDataFrame([("AA", "old name"), ("BB", "b")], carriers), AIRLINE, D1)
    airlines = scd2_merge(airlines, spark.createDataFrame([("AA", "new name")], carriers), AIRLINE, D2)
    codes = ", ".join(["code string", *[f"{c} string" for c in AIRPORT.attributes if c != "wac"], "wac int"])
    place = [(c, c, "city " + c, "s", "st", "us", 1) for c in ("1", "2", "3")]
    airports = scd2_initial(spark.createDataFrame(place, codes), AIRPORT, D1)
    moved = spark.createDataFrame([("1", "1", "other city", "s", "st", "us", 1)], codes)
    airports = scd2_merge(airports, moved, AIRPORT, D2)
    whole = ("year_mfr", "eng_mfr_model_code", "eng_horse_power")
    kinds = ", ".join(f"{c} {'int' if c in whole else 'string'}" for c in ("n_number", *PLANE.attributes))
    planes = scd2_initial(spark.createDataFrame([plane("N1"), plane("N2")], kinds), PLANE, D1)
    days = date_dimension(literal_span(spark, date(2016, 1, 1), date(2016, 3, 31)))
    tables = (airlines, airports, planes, days, time_dimension(spark), monthly_dimension(days))
    return Dimensions(*map(stored, tables))


def flight(**given):
    row = dict.fromkeys(c.split()[0] for c in FLIGHTS.replace("\n", " ").split(","))
    row |= {"FlightDate": date(2016, 1, 1), "Carrier": "AA", "TailNum": "N1", "OriginAirportID": "1"}
    row |= {"DestAirportID": "2", "CRSDepTime": 845, "DepTime": 845.0, "Cancelled": 0.0, "Diverted": 0.0}
    row |= {"WeatherDelay": 1.0, "NASDelay": 2.0, "SecurityDelay": 3.0, "LateAircraftDelay": 4.0}
    return tuple((row | given).values())


@pytest.fixture(scope="module")
def flights(spark):
    return spark.createDataFrame(
        [
            flight(AirTime=1.0),
            flight(AirTime=2.0, TailNum="nobody", Carrier="ZZ", OriginAirportID="undefined"),
            flight(AirTime=3.0, Cancelled=1.0, DepTime=None, CRSDepTime=2400),
            flight(AirTime=4.0, FlightDate=date(2015, 12, 31)),
            flight(AirTime=5.0, WeatherDelay=None),
            flight(AirTime=6.0, Diverted=1.0, Div1AirportID="3", Div1TailNum="N1", Div2AirportID="1", Div2TailNum="N2"),
        ],
        FLIGHTS,
    )


def key_of(dim, column, natural, value):
    return dim.where(F.col("current_flag") & (F.col(natural) == value)).first()[column]


def test_daily_fact(flights, dims):
    fact = daily_fact(flights, dims)
    assert tuple(fact.columns) == DAILY_COLUMNS
    got = {r.air_time: r for r in fact.collect()}
    assert sorted(got) == [1.0, 2.0, 3.0, 5.0, 6.0]
    plain = got[1.0]
    assert plain.airline_key == key_of(dims.airline, "airline_key", "carrier", "AA")
    assert plain.origin_airport_key == key_of(dims.airport, "airport_key", "code", "1")
    assert plain.dest_airport_key == key_of(dims.airport, "airport_key", "code", "2")
    assert plain.plane_key == key_of(dims.plane, "plane_key", "n_number", "N1")
    assert (plain.flight_date_key, plain.actual_dep_time_key, plain.crs_dep_time_key) == (1, 31500, 31500)
    assert (plain.total_delay, plain.div1_airport_key, plain.div2_plane_key) == (10.0, None, None)
    assert (got[2.0].airline_key, got[2.0].plane_key, got[2.0].origin_airport_key) == (None, None, None)
    assert (got[3.0].actual_dep_time_key, got[3.0].crs_dep_time_key, got[3.0].cancelled) == (None, 0, 1.0)
    assert got[5.0].total_delay is None
    assert got[6.0].div1_airport_key == key_of(dims.airport, "airport_key", "code", "3")
    assert got[6.0].div2_airport_key == key_of(dims.airport, "airport_key", "code", "1")
    assert got[6.0].div2_plane_key == key_of(dims.plane, "plane_key", "n_number", "N2")


def test_narrow_fact_has_the_same_rows(flights, dims, rows):
    columns = ["airline_key", "total_delay"]
    narrow = daily_fact(flights.select(*flight_columns(columns)), dims, columns)
    assert rows(narrow) == rows(daily_fact(flights, dims), *columns)
    assert flight_columns(["actual_dep_time_key"]) == {"FlightDate", "DepTime"}


def test_shuffled_lookups_give_the_same_fact(flights, dims, rows):
    assert rows(daily_fact(flights, dims, limit_bytes=0)) == rows(daily_fact(flights, dims))


def test_sizes_measured_before_give_the_same_fact(flights, dims, rows):
    sized = dims.measured()
    assert set(sized.sizes) == {"airline", "airport", "plane", "date", "time", "month"}
    assert sized.sizes["date"] == 91 * 48
    assert rows(daily_fact(flights, sized)) == rows(daily_fact(flights, dims))


def test_monthly_fact(spark, dims):
    delivered = spark.createDataFrame(
        [
            ("AA", "1", "2", 2016, 1, 10.0, 5.0, 1.0),
            ("AA", "1", "2", 2016, 1, 10.0, 5.0, 1.0),
            ("AA", "1", "2", 2016, 2, 7.0, 5.0, None),
            ("ZZ", "9", "2", 2019, 1, 1.0, 1.0, 1.0),
        ],
        PASSENGERS,
    )
    summed = sorted((r.freight, r.passengers, r.mail, r.monthly_key) for r in monthly_fact(delivered, dims).collect())
    assert summed[1:] == [(7.0, 5.0, None, 2), (20.0, 10.0, 2.0, 1)]
    assert summed[0] == (1.0, 1.0, 1.0, None)
    merged = monthly_fact(delivered, dims, dedupe=True)
    assert sorted(r.freight for r in merged.collect()) == [1.0, 7.0, 10.0]
    per_month = dashboards.monthly_dashboard(monthly_fact(delivered, dims), dims.month)
    assert sorted(((r.year, r.quarter, r.month, r.freight) for r in per_month.collect()), key=str) == [
        (2016, 1, 1, 20.0),
        (2016, 1, 2, 7.0),
        (None, None, None, 1.0),
    ]


def test_dashboards(flights, dims, rows):
    fact = daily_fact(flights, dims)
    per_airline = {r.carrier: r for r in dashboards.airline_dashboard(fact, dims.airline).collect()}
    assert (per_airline["AA"].airline_name, per_airline["AA"].flights) == ("new name", 4)
    assert (per_airline[None].flights, per_airline["AA"].delayed_flights) == (1, 3)
    per_airport = {r.code: tuple(r)[3:] for r in dashboards.airport_dashboard(fact, dims.airport).collect()}
    assert per_airport == {"1": (4, 1, 0, 1), "2": (0, 0, 1, 0), "3": (0, 0, 0, 1), None: (1, 0, 0, 0)}
    cities = {r.city: tuple(r)[1:] for r in dashboards.city_diversions(fact, dims.airport).collect()}
    assert cities == {"other city": (0, 1), "city 2": (1, 0), "city 3": (0, 1), None: (0, 0)}
    assert rows(dashboards.busiest_destinations(fact, dims.airport)) == [("2", "2", "city 2", 5)]
    trend = {r.holiday_indicator: r for r in dashboards.holiday_trend(fact, dims.date).collect()}
    assert (trend["Holiday"].days, trend["Holiday"].flights, trend["Holiday"].flights_per_day) == (1, 5, 5.0)
    routes = {(r.origin_code, r.dest_code): r.flights for r in dashboards.route_dashboard(fact, dims.airport).collect()}
    assert routes == {("1", "2"): 4, (None, "2"): 1}
    planes = dashboards.plane_dashboard(fact, dims.plane).collect()
    assert sorted((r.planes, r.flights) for r in planes) == [(0, 1), (1, 4)]
    assert dashboards.least_delayed_month(fact, dims.date).first().calendar_month == 1
    reasons = dashboards.cancellation_reasons(flights)
    assert [tuple(r) for r in reasons.collect()] == [(None, 1)]


def test_versions_of_one_member_count_together(spark, dims):
    """A fact that spans loads holds keys of closed versions too."""
    first, second = (r.airport_key for r in dims.airport.where("code = '1'").orderBy("start_date").collect())
    fact = spark.createDataFrame(
        [(first, second, None), (second, first, None), (second, None, first)],
        "origin_airport_key long, dest_airport_key long, div1_airport_key long",
    ).selectExpr("*", "cast(null as long) as div2_airport_key", "0D as cancelled", "1D as diverted")
    assert [tuple(r) for r in dashboards.busiest_destinations(fact, dims.airport).collect()] == [
        ("1", "1", "other city", 2),
        (None, None, None, 1),
    ]
    per_airport = {r.code: tuple(r)[1:] for r in dashboards.airport_dashboard(fact, dims.airport).collect()}
    assert per_airport == {"1": ("1", "other city", 3, 0, 2, 1), None: (None, None, 0, 0, 1, 0)}
    planes = dims.plane.where("n_number = 'N1'")
    twice = planes.unionByName(planes.withColumn("plane_key", F.lit(99).cast("long")))
    keys = [r.plane_key for r in twice.collect()]
    flown = spark.createDataFrame([(k,) for k in keys], "plane_key long").selectExpr(
        "*", "0D as diverted", "0D as cancelled", "1D as total_delay"
    )
    assert [(r.planes, r.flights) for r in dashboards.plane_dashboard(flown, twice).collect()] == [(1, 2)]


def test_computed_flights_are_stored_once_where_keys_are_counted(flights, dims, rows):
    calls = []

    def store(df):
        calls.append(df)
        return stored(df)

    plain = rows(daily_fact(flights, dims))
    assert rows(daily_fact(flights, dims, store=store)) == plain and not calls
    assert rows(daily_fact(flights, dims, limit_bytes=0, store=store)) == plain and len(calls) == 1


def test_broadcast_tables_share_one_limit(flights, dims, rows):
    sizes = dims.measured().sizes
    assert within({"a": 10, "b": 20, "c": 30}, 35) == {"a", "b"}
    some = sizes["airline"] + sizes["airport"]
    assert rows(daily_fact(flights, dims, limit_bytes=some)) == rows(daily_fact(flights, dims))


def test_roles_of_one_large_dimension_share_one_shuffle(flights, dims):
    columns = ["plane_key", "div1_plane_key", "div2_plane_key", "origin_airport_key", "div1_airport_key", "air_time"]
    want = sorted(map(str, daily_fact(flights, dims, columns).collect()))
    apart = daily_fact(flights, dims, columns, limit_bytes=0)
    at_once = daily_fact(flights, dims, columns, limit_bytes=0, store=stored)
    assert sorted(map(str, apart.collect())) == want and sorted(map(str, at_once.collect())) == want
    planes = [c for c in columns if "plane" in c]
    only_planes = daily_fact(flights, dims, planes + ["air_time"], limit_bytes=0, store=stored)
    plan = only_planes._jdf.queryExecution().optimizedPlan().toString()
    # The flights meet the planes in one join, by their number; the keys alone meet the dimension.
    assert len([line for line in plan.splitlines() if "Join LeftOuter" in line]) == 1
    point = daily_fact(flights, dims, columns, limit_bytes=0, store=stored, point_in_time=True, reach_back=True)
    assert point.count() == len(want)


def test_versions_are_chosen_where_keys_meet_a_large_dimension(spark, tmp_path):
    """What goes on to the rows is one number per role, not the versions of a member."""
    from datetime import date

    from pyspark.sql import functions as F

    from starmill.plans.facts import Role, _roles_at_once

    days = [date(2020, 1, 1), date(2021, 1, 1), date(9999, 12, 31)]
    table = spark.createDataFrame(
        [("a", [(days[0], days[1], 1), (days[1], days[2], 2)]), ("b", [(days[1], days[2], 3)])],
        "code string, surrogate array<struct<start_date:date,end_date:date,surrogate:bigint>>",
    )
    flown = [(0, date(2020, 5, 1), "a", "b"), (1, date(2021, 1, 1), "a", "b"), (2, date(2019, 1, 1), "a", None), (3, None, "a", "x")]
    rows = spark.createDataFrame(flown, "_row_number long, day date, x string, y string")
    roles = {"x_key": Role("plane", {"x": "code"}), "y_key": Role("plane", {"y": "code"})}
    got = _roles_at_once(rows, table, roles, 0, F.col("day")).select("_row_number", "x_key", "y_key")
    assert sorted(tuple(r) for r in got.collect()) == [(0, 1, None), (1, 2, 3), (2, None, None), (3, None, None)]
    early = _roles_at_once(rows, table, roles, 0, F.col("day"), True).select("_row_number", "x_key", "y_key")
    assert sorted(tuple(r) for r in early.collect()) == [(0, 1, 3), (1, 2, 3), (2, 1, None), (3, None, None)]


def test_dimensions_are_staged_once(spark, tmp_path):
    from registered import analogues

    tables = {
        "region": ("r_regionkey int, r_name string", [(0, "R")]),
        "nation": ("n_nationkey int, n_name string, n_regionkey int", [(0, "N", 0)]),
        "customer": ("c_custkey long, c_nationkey int", [(1, 0)]),
        "supplier": ("s_suppkey long, s_name string, s_nationkey int", [(1, "S", 0)]),
        "part": ("p_partkey long, p_name string, p_brand string, p_type string, p_size int", [(1, "P", "Brand#11", "T", 2)]),
        "orders": ("o_orderkey long, o_custkey long", [(1, 1)]),
        "lineitem": ("l_orderkey long", [(1,)]),
    }
    for name, (schema, rows) in tables.items():
        spark.createDataFrame(rows, schema).write.parquet(f"{tmp_path}/{name}.parquet")
    staged = analogues.staged_dimensions(spark, str(tmp_path))
    assert analogues.staged_dimensions(spark, str(tmp_path)) is staged
    for frame in staged.values():
        assert frame.count() == 1 and not any(str(tmp_path) in file for file in frame.inputFiles())
