"""Text clean-up shared by the staging loads."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

UNDEFINED = "undefined"


def fill_undefined(df: DataFrame, value: str = UNDEFINED) -> DataFrame:
    """Replace NULL by ``value`` in text columns; other types keep their NULLs."""
    return df.na.fill(value)


def lower_columns(df: DataFrame, names: Iterable[str]) -> DataFrame:
    return df.withColumns({name: F.lower(name) for name in names})


def place_city(description: Column) -> Column:
    """``City`` of ``"City, ST: Name"``: the text before the first comma, or all of it."""
    return F.get(F.split(description, ", ", 2), F.lit(0))


def place_name(description: Column) -> Column:
    """``Name`` of ``"City, ST: Name"``, whole even when it has commas or colons; NULL if there is none."""
    after_city = F.get(F.split(description, ", ", 2), F.lit(1))
    return F.get(F.split(after_city, ": ", 2), F.lit(1))


def parse_place(df: DataFrame, column: str) -> DataFrame:
    """Add ``city`` and ``place_name`` taken from the description in ``column``."""
    return df.withColumns({"city": place_city(F.col(column)), "place_name": place_name(F.col(column))})
