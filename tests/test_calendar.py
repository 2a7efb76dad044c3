from __future__ import annotations

from datetime import date, timedelta

from starmill.operators.calendar import (
    date_dimension,
    date_span,
    extended_months,
    holiday_calendar,
    keep_keys,
    literal_span,
    monthly_dimension,
    parse_calendar,
    time_dimension,
)


def test_date_dimension(spark):
    dates = date_dimension(literal_span(spark, date(2016, 1, 1), date(2016, 12, 31)))
    days = {r.date: r for r in dates.collect()}
    assert len(days) == 366
    first = days[date(2016, 1, 1)]
    assert (first.date_key, first.full_date_description, first.day_of_week) == (1, "January 1, 2016", 5)
    assert (first.holiday_indicator, first.weekday_indicator) == ("Holiday", "1")
    leap = days[date(2016, 2, 29)]
    assert (leap.date_key, leap.calendar_month, leap.calenda_quarter, leap.calendar_year) == (60, 2, 1, 2016)
    assert (days[date(2016, 1, 2)].weekday_indicator, days[date(2016, 1, 2)].holiday_indicator) == ("0", "Non-Holiday")


def test_moving_holidays(spark):
    moving = spark.createDataFrame([("2016-11-24",), ("2016-11-24",)], "holiday_date string")
    dates = date_dimension(literal_span(spark, date(2016, 11, 20), date(2016, 11, 30)), (), moving)
    assert [r.date for r in dates.where("holiday_indicator = 'Holiday'").collect()] == [date(2016, 11, 24)]
    assert dates.count() == 11


def test_span_of_a_table(spark):
    df = spark.createDataFrame([("2016-03-05",), (None,), ("2016-01-02",)], "d string")
    assert tuple(date_span(df, "d").first()) == (date(2016, 1, 2), date(2016, 3, 5))


def test_delivered_calendar(spark):
    raw = spark.createDataFrame([(1, "01/02/2016")], "date_key int, date string")
    assert parse_calendar(raw).first()["date"] == date(2016, 2, 1)


def test_time_dimension(spark):
    times = {r.time_key: r for r in time_dimension(spark).collect()}
    assert sorted(times) == list(range(86400))
    assert tuple(times[1])[1:] == ("00:00:01", 0, 0, 1, 12, "12:00:01 am", "AM", "Midnight")
    assert tuple(times[12 * 3600])[1:] == ("12:00:00", 12, 0, 0, 12, "12:00:00 pm", "PM", "Afternoon")
    assert tuple(times[86399])[1:] == ("23:59:59", 23, 59, 59, 11, "11:59:59 pm", "PM", "Night")


def test_monthly_dimension(spark):
    months = monthly_dimension(date_dimension(literal_span(spark, date(2016, 11, 15), date(2017, 2, 3)), ()))
    assert sorted((r.monthly_key, r.year, r.quarter, r.month) for r in months.collect()) == [
        (1, 2016, 4, 11),
        (2, 2016, 4, 12),
        (3, 2017, 1, 1),
        (4, 2017, 1, 2),
    ]


def keyed(spark, *rows):
    return spark.createDataFrame([(k, date.fromisoformat(d) if d else None) for k, d in rows], "date_key int, date date")


def keys_of(calendar):
    return {str(r.date): r.date_key for r in calendar.collect()}


def test_stored_days_keep_their_keys_and_no_two_share_one(spark):
    stored = keyed(spark, (1, "2016-01-01"), (2, "2016-01-02"), (3, "2016-01-03"))
    delivered = keyed(spark, (1, "2016-02-01"), (2, "2016-01-01"), (7, "2016-02-02"), (7, "2016-02-03"), (None, "2016-02-04"), (9, None))
    merged = keep_keys(delivered, stored, "date_key", ["date"])
    keys = keys_of(merged)
    assert {d: keys[d] for d in ("2016-01-01", "2016-01-02", "2016-01-03")} == {"2016-01-01": 1, "2016-01-02": 2, "2016-01-03": 3}
    assert keys["2016-02-02"] == 7 and merged.count() == len(keys) == len(set(keys.values())) == 7
    assert min(keys["2016-02-01"], keys["2016-02-03"], keys["2016-02-04"]) == 8
    assert keys_of(keep_keys(merged, merged, "date_key", ["date"])) == keys
    assert keys_of(keep_keys(delivered, None, "date_key", ["date"]))["2016-02-01"] == 1


def test_months_in_a_gap_find_a_key_of_their_own(spark):
    days = keyed(spark, (1, "2016-01-05"), (2, "2016-03-05"))
    calendar = date_dimension(literal_span(spark, date(2016, 1, 1), date(2016, 4, 30)), ())
    first = monthly_dimension(calendar.join(days.select("date"), "date"))
    assert {r.month: r.monthly_key for r in first.collect()} == {1: 1, 3: 3}
    assert {r.month: r.monthly_key for r in extended_months(calendar, first).collect()} == {1: 1, 2: 2, 3: 3, 4: 4}
    dense = spark.createDataFrame([(1, 1, 2016, 1), (3, 1, 2016, 2)], "month int, quarter int, year int, monthly_key long")
    keys = {r.month: r.monthly_key for r in extended_months(calendar, dense).collect()}
    assert (keys[1], keys[3]) == (1, 2) and len(set(keys.values())) == 4


def easter(year):
    """The rule of Meeus, Jones and Butcher."""
    a, b, c = year % 19, year // 100, year % 100
    h = (19 * a + b - b // 4 - (b - (b + 8) // 25 + 1) // 3 + 15) % 30
    rest = (32 + 2 * (b % 4) + 2 * (c // 4) - h - c % 4) % 7
    m = (a + 11 * h + 22 * rest) // 451
    return date(year, (h + rest - 7 * m + 114) // 31, (h + rest - 7 * m + 114) % 31 + 1)


def test_easter_and_weekdays_of_four_centuries(spark):
    years = spark.range(1700, 2101).selectExpr("cast(id as int) as year")
    rules = [("last Friday", 2, 5, -1), ("fifth Monday", 2, 1, 5), ("last but one Sunday", 12, 7, -2)]
    rows = holiday_calendar(years, weekday_rules=rules, fixed=(), easter_days=[("Easter", 0)]).collect()
    named = {(r.holiday_name, r.holiday_date.year): r.holiday_date for r in rows}
    for year in range(1700, 2101):
        assert named["Easter", year] == easter(year)
        february = [date(year, 2, 1) + timedelta(n) for n in range(28 + calendar_leap(year))]
        assert named["last Friday", year] == max(d for d in february if d.isoweekday() == 5)
        mondays = [d for d in february if d.isoweekday() == 1]
        assert named.get(("fifth Monday", year)) == (mondays[4] if len(mondays) > 4 else None)
        sundays = [date(year, 12, n) for n in range(1, 32) if date(year, 12, n).isoweekday() == 7]
        assert named["last but one Sunday", year] == sundays[-2]


def calendar_leap(year):
    return year % 4 == 0 and (year % 100 > 0 or year % 400 == 0)


def test_holidays_of_2021(spark):
    rows = holiday_calendar(spark.createDataFrame([(2021,), (2021,), (None,), (2020,)], "year int")).collect()
    of = {(r.holiday_name, r.is_observed): str(r.holiday_date) for r in rows if r.holiday_date.year == 2021}
    assert of["Thanksgiving Day", False] == "2021-11-25" and of["Memorial Day", False] == "2021-05-31"
    assert of["Juneteenth", False] == "2021-06-19" and of["Juneteenth", True] == "2021-06-18"
    assert of["Independence Day", True] == "2021-07-05" and ("Veterans Day", True) not in of
    assert of["Good Friday", False] == "2021-04-02"
    assert sum(r.holiday_name == "Juneteenth" for r in rows) == 2
    moving = holiday_calendar(spark.createDataFrame([(2016,)], "year int"))
    dates = date_dimension(literal_span(spark, date(2016, 11, 20), date(2016, 11, 30)), (), moving)
    assert [r.date for r in dates.where("holiday_indicator = 'Holiday'").collect()] == [date(2016, 11, 24)]
