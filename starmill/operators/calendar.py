"""Date, time-of-day and month dimensions."""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from datetime import date
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.clock import seconds_of_day

# Fixed values: (month, day) of the United States holidays that never move.
FIXED_HOLIDAYS = ((1, 1), (7, 4), (11, 11), (12, 25))

# Fixed values: (name, month, weekday from Monday = 1, which one of the month; -1 the last) of the United States holidays
# that fall on a weekday.
WEEKDAY_HOLIDAYS = (
    ("Martin Luther King Jr. Day", 1, 1, 3),
    ("Washington's Birthday", 2, 1, 3),
    ("Memorial Day", 5, 1, -1),
    ("Labor Day", 9, 1, 1),
    ("Columbus Day", 10, 1, 2),
    ("Thanksgiving Day", 11, 4, 4),
)

# Names of the holidays that never move, and the first year of one that came later.
FIXED_NAMES = {(1, 1): "New Year's Day", (6, 19): "Juneteenth", (7, 4): "Independence Day", (11, 11): "Veterans Day"}
FIXED_NAMES[(12, 25)] = "Christmas Day"
FIRST_YEARS = {(6, 19): 2021}

#: Days before and after Easter Sunday that are looked for by default.
EASTER_DAYS = (("Good Friday", -2), ("Easter Sunday", 0))

SECONDS_PER_DAY = 86400

# First hour of each part of the day.
PERIODS = ((0, "Midnight"), (1, "Early morning"), (6, "Morning"), (12, "Afternoon"), (18, "Evening"), (21, "Night"))


def date_span(df: DataFrame, column: str) -> DataFrame:
    """One row with the first and last day that occur in ``column``."""
    return df.agg(
        F.min(F.to_date(column)).alias("first_day"),
        F.max(F.to_date(column)).alias("last_day"),
    )


def literal_span(spark: SparkSession, first_day: date, last_day: date) -> DataFrame:
    return spark.range(1).select(F.lit(first_day).alias("first_day"), F.lit(last_day).alias("last_day"))


def _on_fixed_holiday(day: Column, holidays: Iterable[tuple[int, int]]) -> Column:
    hits = [(F.month(day) == m) & (F.dayofmonth(day) == d) for m, d in holidays]
    return reduce(or_, hits, F.lit(False))


def nth_weekday(year: Column, month: int, weekday: int, nth: int) -> Column:
    """The ``nth`` ``weekday`` (Monday is 1) of a month, the last one for -1.  NULL where the month has no such day."""
    first = F.make_date(year, F.lit(month), F.lit(1))
    if nth < 0:
        last = F.last_day(first)
        return F.date_sub(last, F.pmod(F.weekday(last) + 1 - weekday, F.lit(7)) - 7 * (nth + 1))
    day = F.date_add(first, F.pmod(F.lit(weekday) - 1 - F.weekday(first), F.lit(7)) + 7 * (nth - 1))
    return F.when(F.month(day) == month, day)


def easter_sunday(year: Column) -> Column:
    """Easter Sunday of the Gregorian calendar, from the age of the moon (epact) and the day of the week."""
    whole = lambda value: F.floor(value).cast("int")
    century = whole(year / 100)
    golden = year % 19
    leap_days, moon = century - whole(century / 4), whole((8 * century + 13) / 25)
    epact = F.pmod(leap_days - moon + 19 * golden + 15, F.lit(30))
    # The full moon falls 21 March plus this many days; the longest two months are cut by a day.
    late = (epact == 29) | ((epact == 28) & (golden > 10))
    full_moon = epact - late.cast("int")
    weekday = F.pmod(year + whole(year / 4) + full_moon + 2 - leap_days, F.lit(7))
    return F.date_add(F.make_date(year, F.lit(3), F.lit(28)), full_moon - weekday)


def holiday_calendar(
    years: DataFrame,
    year: str = "year",
    weekday_rules: Iterable[tuple[str, int, int, int]] = WEEKDAY_HOLIDAYS,
    fixed: Iterable[tuple[int, int]] = (*FIXED_HOLIDAYS, (6, 19)),
    easter_days: Iterable[tuple[str, int]] = EASTER_DAYS,
    observed: bool = True,
) -> DataFrame:
    """The holidays of each year in ``years``: ``holiday_date``, ``holiday_name`` and ``is_observed``.

    With ``observed`` a fixed holiday on a Saturday has a second row for the Friday before, one on a Sunday for the Monday after.
    """
    y = F.col(year).cast("int")
    days = [(name, nth_weekday(y, month, weekday, nth), False) for name, month, weekday, nth in weekday_rules]
    sunday = easter_sunday(y)
    days += [(name, F.date_add(sunday, offset), False) for name, offset in easter_days]
    for month, day in fixed:
        date_ = F.when(y >= FIRST_YEARS.get((month, day), 0), F.make_date(y, F.lit(month), F.lit(day)))
        name = FIXED_NAMES.get((month, day), f"{month}/{day}")
        days.append((name, date_, False))
        if observed:
            weekday = F.weekday(date_)
            moved = F.when(weekday == 5, F.date_sub(date_, 1)).when(weekday == 6, F.date_add(date_, 1))
            days.append((name, moved, True))
    rows = [
        F.struct(d.alias("holiday_date"), F.lit(n).alias("holiday_name"), F.lit(o).alias("is_observed"))
        for n, d, o in days
    ]
    each = years.select(y.alias(year)).distinct().where(F.col(year).isNotNull())
    return each.select(F.inline(F.array(*rows))).where("holiday_date IS NOT NULL")


def date_dimension(
    span: DataFrame,
    holidays: Iterable[tuple[int, int]] = FIXED_HOLIDAYS,
    moving_holidays: DataFrame | None = None,
) -> DataFrame:
    """One row per day of ``span`` (a row of ``first_day``, ``last_day``), keyed 1 for the first day.

    If the span has a day ``key_one``, that day has key 1 instead, and earlier ones keys down from 0, so that a calendar
    which is extended at either end keeps its keys.
    ``moving_holidays`` is a table with a ``holiday_date`` column.  Weeks start on Monday (1);
    ``weekday_indicator`` is ``"1"`` from Monday to Friday.  The table has one row per calendar day, so its
    size is set by the years covered, not by the facts.
    """
    key_one = F.coalesce("key_one", "first_day") if "key_one" in span.columns else F.col("first_day")
    days = span.select(key_one.alias("key_one"), F.explode(F.sequence("first_day", "last_day")).alias("date"))
    day = F.col("date")
    is_holiday = _on_fixed_holiday(day, holidays)
    if moving_holidays is not None:
        listed = moving_holidays.select(F.to_date("holiday_date").alias("_listed")).distinct()
        days = days.join(listed, day == F.col("_listed"), "left")
        is_holiday = is_holiday | F.col("_listed").isNotNull()
    iso_day = F.weekday(day) + 1
    return days.select(
        (F.date_diff(day, F.col("key_one")) + 1).alias("date_key"),
        F.date_format(day, "MMMM d, yyyy").alias("full_date_description"),
        day,
        iso_day.alias("day_of_week"),
        F.month(day).alias("calendar_month"),
        F.quarter(day).alias("calenda_quarter"),
        F.year(day).alias("calendar_year"),
        F.when(is_holiday, F.lit("Holiday")).otherwise(F.lit("Non-Holiday")).alias("holiday_indicator"),
        F.when(iso_day <= 5, F.lit("1")).otherwise(F.lit("0")).alias("weekday_indicator"),
    )


def parse_calendar(dates: DataFrame, date_format: str = "dd/MM/yyyy") -> DataFrame:
    """A delivered date table with its text ``date`` turned into a real date."""
    return dates.withColumn("date", F.to_date("date", date_format))


def time_dimension(spark: SparkSession) -> DataFrame:
    """One row per second of the day; the key is the number of seconds since midnight."""
    second_of_day = F.col("id").cast("int")
    hour = F.floor(second_of_day / 3600).cast("int")
    minute = F.pmod(F.floor(second_of_day / 60).cast("int"), F.lit(60))
    second = F.pmod(second_of_day, F.lit(60))
    hour_12 = F.pmod(hour + 11, F.lit(12)) + 1
    meridian = F.when(hour < 12, F.lit("AM")).otherwise(F.lit("PM"))
    digits = [F.lpad(part.cast("string"), 2, "0") for part in (minute, second)]
    period = F.lit(PERIODS[0][1])
    for first_hour, name in PERIODS[1:]:
        period = F.when(hour >= first_hour, F.lit(name)).otherwise(period)
    return spark.range(SECONDS_PER_DAY).select(
        seconds_of_day(hour, minute, second).alias("time_key"),
        F.concat_ws(":", F.lpad(hour.cast("string"), 2, "0"), *digits).alias("time_24h"),
        hour.alias("hour"),
        minute.alias("minute"),
        second.alias("second"),
        hour_12.alias("hour_12"),
        F.concat(
            F.concat_ws(":", F.lpad(hour_12.cast("string"), 2, "0"), *digits), F.lit(" "), F.lower(meridian)
        ).alias("time_ampm"),
        meridian.alias("meridian_indicator"),
        period.alias("period"),
    )


def extended_span(spans: Sequence[DataFrame], stored: DataFrame | None = None) -> DataFrame:
    """The span from the first to the last day of all ``spans`` and of a ``stored`` calendar, which keeps its keys."""
    if stored is not None:
        known = date_span(stored, "date").withColumn(
            "key_one", stored.agg(F.min(F.date_add("date", 1 - F.col("date_key")))).scalar()
        )
        spans = [known, *spans]
    rows = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), spans)
    key_one = [F.min("key_one").alias("key_one")] if stored is not None else []
    return rows.agg(F.min("first_day").alias("first_day"), F.max("last_day").alias("last_day"), *key_one)


def month_span(df: DataFrame, year: str, month: str) -> DataFrame:
    """One row with the first and last day of the months that occur in two columns."""
    first = F.make_date(F.col(year), F.col(month), F.lit(1))
    return df.agg(F.min(first).alias("first_day"), F.max(F.last_day(first)).alias("last_day"))


def keep_keys(rows: DataFrame, stored: DataFrame | None, key: str, on: Sequence[str]) -> DataFrame:
    """A calendar of ``rows`` and of the ``stored`` rows that ``rows`` does not have; each day, month or time has one key.

    ``on`` says what a row is about; rows without it are dropped.  What is stored keeps its key, and new rows keep theirs
    unless another row has it, stored or earlier among the new ones; those are numbered on after the largest key.  Calendars
    have as many rows as there are days, months or seconds, so numbering them in one window is bounded.
    """
    rows = rows.dropna(subset=list(on))
    stored = rows.limit(0) if stored is None else stored
    known = stored.select(*on, F.col(key).alias("_known"))
    taken = stored.select(F.col(key).alias("_taken")).distinct()
    joined = rows.join(known, list(on), "left").join(taken, F.col(key) == F.col("_taken"), "left")
    new = F.col("_known").isNull()
    claim = new & F.col("_taken").isNull() & F.col(key).isNotNull()
    first = F.row_number().over(Window.partitionBy(key, claim).orderBy(*on)) == 1
    kept = joined.withColumn("_kept", F.when(new, F.when(claim & first, F.col(key))).otherwise(F.col("_known")))
    last = F.greatest(
        F.coalesce(stored.agg(F.max(key)).scalar(), F.lit(0)), F.coalesce(rows.agg(F.max(key)).scalar(), F.lit(0))
    )
    nth = F.row_number().over(Window.partitionBy(F.col("_kept").isNull()).orderBy(*on))
    numbered = F.coalesce("_kept", last + nth).cast(rows.schema[key].dataType)
    result = kept.withColumn(key, numbered).select(*rows.columns)
    others = stored.join(rows.select(*on), list(on), "left_anti").select(*rows.columns)
    return result.unionByName(others)


def monthly_dimension(dates: DataFrame) -> DataFrame:
    """Months of a date dimension, keyed by their distance from the first, which has key 1.

    Without gaps these are 1, 2, 3 ... in calendar order; a month that is added in a gap later finds its key free.
    """
    months = dates.select(
        F.col("calendar_month").alias("month"),
        F.col("calenda_quarter").alias("quarter"),
        F.col("calendar_year").alias("year"),
    ).distinct()
    index = F.col("year") * 12 + F.col("month")
    first = months.agg(F.min(index)).scalar()
    return months.withColumn("monthly_key", (index - first + 1).cast("long"))


def extended_months(dates: DataFrame, stored: DataFrame) -> DataFrame:
    """The months of ``dates`` and of the ``stored`` dimension, those stored with the key they have there.

    New months are keyed by their distance from the stored ones, as far as these keys are free.
    """
    index = (F.col("year") * 12 + F.col("month")).cast("long")
    key_one = stored.agg(F.min(index - F.col("monthly_key") + 1)).scalar()
    months = monthly_dimension(dates).withColumn("monthly_key", index - key_one + 1)
    return keep_keys(months, stored, "monthly_key", ["year", "month"])
