"""Two deliveries from delimited text to the presentation tables."""

from __future__ import annotations

from dataclasses import replace
from datetime import date

import pytest

from starmill.plans.warehouse import Extract, load_warehouse, raw_zone, read_fact
from starmill.sources import TooManyRejects, current_version, read_table, write_table

HEADER = (
    "Year,FlightDate,Carrier,TailNum,OriginAirportID,OriginState,OriginStateName,OriginWac,DestAirportID,CRSDepTime,"
    "DepTime,Cancelled,CancellationCode,Diverted,AirTime,WeatherDelay,NASDelay,SecurityDelay,LateAircraftDelay,"
    "CarrierDelay,TaxiIn,TaxiOut,Div1AirportID,Div1TailNum,Div2AirportID,Div2TailNum,Unnamed: 109"
)
FLIGHTS = [
    "2016,2016-01-01,AA,N1,10,NJ,New Jersey,21,11,845,0845,0.00,,0.00,60.0,1.0,2.0,3.0,4.0,9.0,5.0,6.0,,,,,",
    "2016,2016-01-02,AA,N2,10,NJ,New Jersey,21,11,2400,5.0,0.00,,1.00,,,,,,,,,11,N2,,,",
    "2016,2016-02-01,XX,N9,11,NY,New York,22,10,10,,1.00,B,0.00,,,,,,,,,,,,,",
]


def write(root, table, *lines):
    (root / table).mkdir(parents=True, exist_ok=True)
    (root / table / "part.csv").write_text("\n".join(lines) + "\n", encoding="utf-8")


def deliver(root, sep=",", plane_city="MEMPHIS", airline="American Airlines Inc.: AA"):
    write(root, "flights", *[line.replace(",", sep) for line in (HEADER, *FLIGHTS)])
    write(root, "airline", "Code,Description", f"AA,{airline}", "BB,Bee Air", "BB,Bee Air", "CC,")
    write(
        root,
        "airports",
        "Code,Description",
        '10,"Atlantic City, NJ: Atlantic City International"',
        '11,"New York, NY: La Guardia, North"',
        "12,Nowhere",
    )
    write(root, "wac", "world_area_code;country", "21;United States", "22;United States")
    write(
        root,
        "planes",
        "N-Number,Serial Number,Name,MFR MDL Code,Year MFR,City,State,Street 1,Eng MFR Code",
        f"N1,156H,JENKIS ARTHUR,720282,1973,{plane_city},TN,PO BOX 129,95",
        "N2,157,,720283,,,,,7",
    )
    write(root, "engines", "Eng MFR Code,eng mfr name,engine model name,horsepower", "95,ALLIANCE,HESS WARRIOR,750")
    write(
        root,
        "passengers",
        "carrier,origin_airport_id,dest_airport_id,year,month,freight,passengers,mail",
        "AA,10,11,2016,1,100,50,7",
        "AA,10,11,2016,1,100,50,7",
    )
    return raw_zone(str(root), sep)


@pytest.fixture(scope="module")
def lake(spark, tmp_path_factory):
    root = tmp_path_factory.mktemp("lake")
    first = deliver(root / "raw1")
    audits = [load_warehouse(spark, first, str(root / "lake"), date(2024, 1, 1)).collect()]
    second = deliver(root / "raw2", sep=";", plane_city="NASHVILLE", airline="American: AA")
    audits.append(load_warehouse(spark, second, str(root / "lake"), date(2024, 2, 1)).collect())
    return str(root / "lake"), [{r.table_name: tuple(r)[1:] for r in a} for a in audits]


def test_audits(lake):
    _, (first, second) = lake
    # rows, distinct keys, NULL keys; rows before, read, rejected and replaced
    assert first["airline_dimension"] == (3, 3, 0, 0, 4, 1, None)
    assert first["airport_dimension"] == (3, 3, 0, 0, 3, 0, None)
    assert first["plane_dimension"] == (2, 2, 0, 0, 2, 0, None)
    assert first["date_dimension"] == (32, 32, 0, 0, None, None, None)
    assert first["monthly_dimension"] == (2, 2, 0, 0, None, None, None)
    assert first["flight_fact"] == (3, 3, 0, 0, 3, 0, 0)
    assert first["monthly_flight_fact"] == (1, 1, 0, 0, 2, 0, 0)
    assert second["airline_dimension"] == (4, 4, 0, 3, 4, 1, None)
    assert second["airport_dimension"] == (3, 3, 0, 3, 3, 0, None)
    assert second["plane_dimension"] == (3, 3, 0, 2, 2, 0, None)
    assert second["flight_fact"] == (3, 3, 0, 3, 3, 0, 3)
    assert second["monthly_flight_fact"] == (1, 1, 0, 1, 2, 0, 1)


def test_airports(spark, lake):
    rows = {r.code: r for r in read_table(spark, f"{lake[0]}/presentation/airport_dimension").collect()}
    assert tuple(rows["10"])[1:8] == (
        "10",
        "atlantic city international",
        "atlantic city",
        "nj",
        "new jersey",
        21,
        "united states",
    )
    assert rows["11"].airport_name == "la guardia, north"
    assert tuple(rows["12"])[1:8] == ("12", "undefined", "nowhere", "undefined", "undefined", None, "undefined")


def test_planes_and_airlines_keep_history(spark, lake):
    planes = read_table(spark, f"{lake[0]}/presentation/plane_dimension").where("n_number = 'N1'")
    assert sorted((r.start_date, r.registrant_city, r.eng_mfr_name, r.current_flag) for r in planes.collect()) == [
        (date(2024, 1, 1), "memphis", "alliance", False),
        (date(2024, 2, 1), "nashville", "alliance", True),
    ]
    other = read_table(spark, f"{lake[0]}/presentation/plane_dimension").where("n_number = 'N2'").first()
    assert (other.aircraft_name, other.year_mfr, other.eng_mfr_name, other.eng_horse_power) == (
        "undefined",
        None,
        "undefined",
        None,
    )
    airlines = read_table(spark, f"{lake[0]}/presentation/airline_dimension")
    assert sorted(r.airline_name for r in airlines.where("carrier = 'AA'").collect()) == [
        "american airlines inc.: aa",
        "american: aa",
    ]
    assert airlines.where("carrier = 'CC'").first().airline_name == "undefined"
    assert current_version(spark, f"{lake[0]}/presentation/airline_dimension") == 2


def test_facts(spark, lake):
    fact = read_fact(spark, lake[0], "flight_fact")
    rows = {r.flight_date_key: r for r in fact.collect()}
    assert sorted(rows) == [1, 2, 32]
    assert (rows[1].actual_dep_time_key, rows[1].total_delay, rows[1].air_time) == (31500, 10.0, 60.0)
    assert (rows[2].actual_dep_time_key, rows[2].crs_dep_time_key, rows[2].total_delay) == (300, 0, None)
    assert rows[2].div1_airport_key == rows[2].dest_airport_key
    assert rows[2].div1_plane_key == rows[2].plane_key
    assert (rows[32].airline_key, rows[32].plane_key, rows[32].actual_dep_time_key) == (None, None, None)
    planes = read_table(spark, f"{lake[0]}/presentation/plane_dimension").where("n_number = 'N1' and current_flag")
    assert rows[1].plane_key == planes.first().plane_key
    monthly = read_fact(spark, lake[0], "monthly_flight_fact").first()
    assert (monthly.freight, monthly.passengers, monthly.mail, monthly.monthly_key) == (200.0, 100.0, 14.0, 1)


def test_delivered_calendars(spark, tmp_path):
    raw = deliver(tmp_path / "raw")
    write(
        tmp_path / "raw",
        "date",
        "date_key;full_date_description;date;day_of_week;calendar_month;calenda_quarter;calendar_year;"
        "holiday_indicator;weekday_indicator",
        "500;January 1, 2016;01/01/2016;5;1;1;2016;Holiday;1",
        "501;January 1, 2016;01/01/2016;5;1;1;2016;Holiday;1",
    )
    write(
        tmp_path / "raw",
        "time",
        "time_key;time_24h;hour;minute;second;hour_12;time_ampm;meridian_indicator;period",
        "77;08:45:00;8;45;0;8;08:45:00 am;AM;Morning",
    )
    raw = replace(
        raw,
        dates=Extract(f"{tmp_path}/raw/date", ";", "dd/MM/yyyy"),
        times=Extract(f"{tmp_path}/raw/time", ";"),
    )
    load_warehouse(spark, raw, str(tmp_path / "lake"), date(2024, 1, 1), plane_change="always")
    fact = spark.read.parquet(f"{tmp_path}/lake/presentation/flight_fact").collect()
    assert [(r.flight_date_key, r.actual_dep_time_key, r.crs_dep_time_key) for r in fact] == [(500, 77, 77)]


def flight(day, carrier="AA", tail="N1", origin="10"):
    return f"2016,{day},{carrier},{tail},{origin},NJ,New Jersey,21,11,845,0845,0,,0,60,1,2,3,4,9,5,6,,,,,"


def load(spark, tmp_path, number, as_of, flights, passengers=(), planes=None):
    root = tmp_path / f"raw{number}"
    raw = deliver(root)
    write(root, "flights", HEADER, *flights)
    write(root, "passengers", "carrier,origin_airport_id,dest_airport_id,year,month,freight,passengers,mail", *passengers)
    if planes:
        write(root, "planes", *planes)
    rows = load_warehouse(spark, raw, str(tmp_path / "lake"), as_of).collect()
    return {r.table_name: r.asDict() for r in rows}


def days_of(spark, lake):
    dates = read_table(spark, f"{lake}/presentation/date_dimension")
    joined = read_fact(spark, lake, "flight_fact").withColumnRenamed("flight_date_key", "date_key").join(dates, "date_key")
    return sorted((str(r.date), r.plane_key is not None) for r in joined.collect())


def months_of(spark, lake):
    months = read_table(spark, f"{lake}/presentation/monthly_dimension")
    joined = read_fact(spark, lake, "monthly_flight_fact").join(months, "monthly_key")
    return sorted((r.year, r.month, r.freight) for r in joined.collect())


def test_facts_of_earlier_deliveries_stay(spark, tmp_path):
    lake = str(tmp_path / "lake")
    load(spark, tmp_path, 1, date(2024, 1, 1), [flight("2016-03-05"), flight("2016-03-05"), flight("2016-03-07")], ["AA,10,11,2016,3,5,1,1"])
    keys = {r.date: r.date_key for r in read_table(spark, f"{lake}/presentation/date_dimension").collect()}
    # Days before and after the first delivery, one day again, and passengers of a month without flights.
    again = [flight("2016-03-07", tail="N2"), flight("2016-01-01"), flight("2016-05-01")]
    audit = load(spark, tmp_path, 2, date(2024, 2, 1), again, ["AA,10,11,2015,12,7,1,1", "AA,10,11,2016,3,6,1,1"])
    assert days_of(spark, lake) == [
        ("2016-01-01", True), ("2016-03-05", True), ("2016-03-05", True), ("2016-03-07", True), ("2016-05-01", True)
    ]
    assert months_of(spark, lake) == [(2015, 12, 7.0), (2016, 3, 6.0)]
    extended = {r.date: r.date_key for r in read_table(spark, f"{lake}/presentation/date_dimension").collect()}
    assert keys.items() <= extended.items() and extended[date(2016, 1, 1)] == keys[date(2016, 3, 5)] - 64
    assert len(set(extended.values())) == len(extended)
    assert (audit["flight_fact"]["rows_before"], audit["flight_fact"]["row_count"]) == (3, 5)
    assert audit["monthly_dimension"]["row_count"] == 6


def test_late_flights_leave_the_others_of_their_day(spark, tmp_path):
    lake = str(tmp_path / "lake")
    both = [flight("2016-03-05"), flight("2016-03-05", carrier="BB"), flight("2016-03-06")]
    load(spark, tmp_path, 1, date(2024, 1, 1), both, ["AA,10,11,2016,3,5,1,1"])
    late = [flight("2016-03-05", carrier="CC"), flight("2016-03-06").replace(",60,", ",75,")]
    audit = load(spark, tmp_path, 2, date(2024, 2, 1), late, ["BB,10,11,2016,3,8,1,1"])
    assert len(days_of(spark, lake)) == 4
    assert (audit["flight_fact"]["row_count"], audit["flight_fact"]["rows_replaced"]) == (4, 1)
    assert months_of(spark, lake) == [(2016, 3, 5.0), (2016, 3, 8.0)]
    assert sorted(r.air_time for r in read_fact(spark, lake, "flight_fact").collect()) == [60.0, 60.0, 60.0, 75.0]


def test_a_load_goes_on_below_a_share_of_bad_lines(spark, tmp_path):
    root = tmp_path / "raw1"
    raw = deliver(root)
    write(root, "flights", HEADER, *[flight("2016-03-05")] * 3, flight("05/03/2016"))
    with pytest.raises(TooManyRejects, match="1 of 4 lines are malformed: FlightDate: not date"):
        load_warehouse(spark, raw, str(tmp_path / "lake"), date(2024, 1, 1), max_rejected=0.2)
    rows = load_warehouse(spark, raw, str(tmp_path / "lake"), date(2024, 1, 1), max_rejected=0.25).collect()
    audit = {r.table_name: r for r in rows}["flight_fact"]
    assert (audit.row_count, audit.rows_read, audit.rows_rejected) == (3, 4, 1)
    kept = read_table(spark, f"{tmp_path}/lake/landing/flights_rejected").collect()
    assert [(r._reject_reason, r._file) for r in kept] == [("FlightDate: not date", "part.csv")]
    assert "05/03/2016" in kept[0]._line


def test_a_load_may_take_the_versions_of_the_day(spark, tmp_path):
    lake = str(tmp_path / "lake")
    header = "N-Number,Serial Number,Name,MFR MDL Code,Year MFR,City,State,Street 1,Eng MFR Code"
    for number, (day, city) in enumerate(((date(2016, 1, 1), "A"), (date(2016, 3, 6), "B")), 1):
        raw = deliver(tmp_path / f"raw{number}")
        write(tmp_path / f"raw{number}", "planes", header, f"N1,1,A,M,1973,{city},TN,S,95")
        write(tmp_path / f"raw{number}", "flights", HEADER, flight("2016-03-05"), flight("2016-03-06"), flight("2015-12-31"))
        load_warehouse(spark, raw, lake, day, point_in_time=True)
    planes = read_table(spark, f"{lake}/presentation/plane_dimension").select("plane_key", "registrant_city")
    dates = read_table(spark, f"{lake}/presentation/date_dimension").withColumnRenamed("date_key", "flight_date_key")
    fact = read_fact(spark, lake, "flight_fact").join(dates, "flight_date_key").join(planes, "plane_key", "left")
    assert sorted((str(r.date), r.registrant_city) for r in fact.collect()) == [
        ("2015-12-31", None), ("2016-03-05", "a"), ("2016-03-06", "b")
    ]


def test_no_two_days_months_or_times_share_a_key(spark, tmp_path):
    lake = str(tmp_path / "lake")
    load(spark, tmp_path, 1, date(2024, 1, 1), [flight("2016-01-01"), flight("2016-01-03")])
    raw = deliver(tmp_path / "raw2")
    write(tmp_path / "raw2", "flights", HEADER, flight("2016-02-01"), flight("2016-04-02"))
    header = (
        "date_key;full_date_description;date;day_of_week;calendar_month;calenda_quarter;calendar_year;"
        "holiday_indicator;weekday_indicator"
    )
    days = ("01/01/2016", "01/02/2016", "02/04/2016")
    months = (1, 2, 4)
    lines = [f"{n};d;{d};1;{m};1;2016;Holiday;1" for n, (d, m) in enumerate(zip(days, months, strict=True), 1)]
    write(tmp_path / "raw2", "date", header, *lines)
    raw = replace(raw, dates=Extract(f"{tmp_path}/raw2/date", ";", "dd/MM/yyyy"))
    load_warehouse(spark, raw, lake, date(2024, 2, 1))
    load(spark, tmp_path, 3, date(2024, 3, 1), [flight("2016-03-31")])
    assert [day for day, _ in days_of(spark, lake)] == ["2016-01-01", "2016-01-03", "2016-02-01", "2016-03-31", "2016-04-02"]
    for name, key in (("date", "date_key"), ("time", "time_key"), ("monthly", "monthly_key")):
        keys = [r[key] for r in read_table(spark, f"{lake}/presentation/{name}_dimension").collect()]
        assert len(set(keys)) == len(keys) and None not in keys
    first = read_table(spark, f"{lake}/presentation/date_dimension").where("date = '2016-01-01'").first()
    assert (first.date_key, first.holiday_indicator) == (1, "Holiday")


def test_only_two_versions_are_left(spark, tmp_path):
    for number in range(1, 4):
        load(spark, tmp_path, number, date(2024, number, 1), [flight("2016-03-05")])
    left = {p: sorted(x.name for x in p.iterdir() if not x.name.endswith("crc")) for p in (tmp_path / "lake").glob("*/*")}
    versioned = {p.name: names for p, names in left.items() if p.name not in ("flight_fact", "monthly_flight_fact")}
    assert versioned["plane_dimension"] == ["v0000000002", "v0000000003"]
    assert all(len(names) <= 2 for names in versioned.values())


def test_a_load_dated_before_open_versions_stops(spark, tmp_path):
    load(spark, tmp_path, 1, date(2024, 2, 1), [flight("2016-03-05")])
    planes = ["N-Number,Serial Number,Name,MFR MDL Code,Year MFR,City,State,Street 1,Eng MFR Code", "N1,156H,NEW OWNER,720282,1973,X,TN,Y,95"]
    for day in (date(2024, 1, 1), date(2024, 2, 1)):
        with pytest.raises(Exception, match="starts no earlier"):
            load(spark, tmp_path, 2, day, [flight("2016-03-05")], planes=planes)
    load(spark, tmp_path, 3, date(2024, 2, 1), [flight("2016-03-05")])
    assert load(spark, tmp_path, 4, date(2024, 2, 2), [flight("2016-03-05")], planes=planes)["plane_dimension"]["row_count"] == 3


def test_letter_codes_and_missing_keys(spark, tmp_path):
    root = tmp_path / "raw1"
    raw = deliver(root)
    write(root, "airports", "Code,Description", '10,"Atlantic City, NJ: Atlantic City"', 'ADK,"Adak, AK: Adak Airport"', ",Nowhere")
    write(root, "flights", HEADER, flight("2016-03-05", origin="ADK"))
    header = "N-Number,Serial Number,Name,MFR MDL Code,Year MFR,City,State,Street 1,Eng MFR Code"
    write(root, "planes", header, ",1,A,,,,,,", ",2,B,,,,,,", "N1,3,C,,,,,,", "N1,4,C,,,,,,")
    audit = {r.table_name: r for r in load_warehouse(spark, raw, str(tmp_path / "lake"), date(2024, 1, 1)).collect()}
    assert (audit["plane_dimension"].row_count, audit["plane_dimension"].rows_read, audit["plane_dimension"].rows_rejected) == (1, 4, 3)
    assert (audit["airport_dimension"].row_count, audit["airport_dimension"].rows_rejected) == (2, 1)
    fact = read_fact(spark, str(tmp_path / "lake"), "flight_fact").first()
    code = read_table(spark, f"{tmp_path}/lake/presentation/airport_dimension").where("code = 'adk'").first()
    assert fact.origin_airport_key == code.airport_key and code.state_code == "nj"


@pytest.mark.parametrize("line", [flight("01/01/2016"), flight("2016-01-01").replace(",845,", ",845.0,")])
def test_fields_of_another_type_stop_the_load(spark, tmp_path, line):
    with pytest.raises(Exception, match="(?i)malformed|FAILFAST|parse"):
        load(spark, tmp_path, 1, date(2024, 1, 1), [line])


def test_dates_may_have_another_form(spark, tmp_path):
    raw = deliver(tmp_path / "raw")
    write(tmp_path / "raw", "flights", HEADER, flight("31/12/2016"))
    raw = raw_zone(str(tmp_path / "raw"), date_format="dd/MM/yyyy")
    assert raw_zone("r", calendars=True).dates == Extract("r/date", ";", "dd/MM/yyyy")
    load_warehouse(spark, raw, str(tmp_path / "lake"), date(2024, 1, 1))
    assert days_of(spark, str(tmp_path / "lake")) == [("2016-12-31", True)]


def test_a_fact_load_that_dies_leaves_the_table(spark, tmp_path):
    path = str(tmp_path / "fact")
    write_table(spark.range(4).selectExpr("id", "id % 2 as day"), path, ["day"], keep_others=True)
    dying = spark.range(4).selectExpr("if(id = 3, cast(raise_error('dies') as bigint), id + 10) as id", "0L as day")
    with pytest.raises(Exception, match="dies"):
        write_table(dying, path, ["day"], keep_others=True)
    assert sorted(r.id for r in spark.read.parquet(path).collect()) == [0, 1, 2, 3]
    write_table(spark.range(1).selectExpr("id + 10 as id", "0L as day"), path, ["day"], keep_others=True)
    assert sorted(r.id for r in spark.read.parquet(path).collect()) == [1, 3, 10]
