"""Clock values written as one number, hours times one hundred plus minutes (845 is 08:45)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _valid(hhmm: Column) -> Column:
    minute_ok = F.pmod(hhmm, F.lit(100)) < 60
    return hhmm.between(0, 2359) & minute_ok | (hhmm == 2400)


def hhmm_hour(hhmm: Column) -> Column:
    """Hour 0-23; 2400 is midnight; values that are no clock time give NULL."""
    hour = F.pmod(F.floor(hhmm / 100).cast("int"), F.lit(24))
    return F.when(_valid(hhmm), hour)


def hhmm_minute(hhmm: Column) -> Column:
    """Minute 0-59; values that are no clock time give NULL."""
    return F.when(_valid(hhmm), F.pmod(hhmm, F.lit(100)).cast("int"))


def hhmm_second(hhmm: Column) -> Column:
    """Always 0 for a clock time: the source has no finer grain."""
    return F.when(_valid(hhmm), F.lit(0))


def seconds_of_day(hour: Column, minute: Column, second: Column) -> Column:
    return (hour * 3600 + minute * 60 + second).cast("int")
