"""Derived measures of the daily fact."""

from __future__ import annotations

from functools import reduce
from operator import add

from pyspark.sql import Column
from pyspark.sql import functions as F

# The delay parts that make up the total, in order.  Carrier delay is not one of them.
DELAY_PARTS = ("WeatherDelay", "NASDelay", "SecurityDelay", "LateAircraftDelay")


def total_delay(*parts: Column | str) -> Column:
    """Sum of the parts; NULL as soon as one part is NULL."""
    columns = [F.col(p) if isinstance(p, str) else p for p in parts]
    return reduce(add, columns)
