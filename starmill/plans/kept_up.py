"""Dashboards that follow the fact: sums kept per partition, replaced with it and added up when they are read.

A delivery changes the partitions it has rows for.  Only these are read again, and their sums take the place of the
old ones; a dashboard adds up one row per partition and key and reads no fact at all.  Partitions are replaced whole, so
running the same step again, after a driver was lost, gives the same sums.
"""

from __future__ import annotations

from collections.abc import Callable, Collection, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources import write_table
from . import dashboards


@dataclass(frozen=True)
class Kept:
    """Sums that are kept: the function that adds up a fact by ``keys``, and the fact columns it reads."""

    sums: Callable[..., DataFrame]
    keys: tuple[str, ...]
    columns: tuple[str, ...]


_DELAYS = ("cancelled", "diverted", "total_delay")
_AIRPORTS = ("origin_airport_key", "dest_airport_key", "div1_airport_key", "div2_airport_key")

KEPT = {
    "airlines": Kept(
        dashboards.airline_sums, ("airline_key",), ("airline_key", "total_delay", "diverted", "taxi_in", "taxi_out")
    ),
    "airports": Kept(dashboards.airport_sums, ("airport_key",), (*_AIRPORTS, "cancelled", "diverted")),
    "planes": Kept(dashboards.plane_sums, ("plane_key",), ("plane_key", *_DELAYS)),
    "days": Kept(dashboards.day_sums, ("flight_date_key",), ("flight_date_key", *_DELAYS)),
    "routes": Kept(dashboards.route_sums, _AIRPORTS[:2], (*_AIRPORTS[:2], *_DELAYS)),
}

#: Dashboard -> the sums it is answered from, and the question to them and a dimension.
ANSWERS = {
    "airline_dashboard": ("airlines", dashboards.airlines_of),
    "airport_dashboard": ("airports", dashboards.airports_of),
    "city_diversions": ("airports", dashboards.cities_of),
    "plane_dashboard": ("planes", dashboards.planes_of),
    "holiday_trend": ("days", dashboards.holidays_of),
    "least_delayed_month": ("days", dashboards.least_delayed_of),
    "route_dashboard": ("routes", dashboards.routes_of),
    "busiest_destinations": ("routes", lambda sums, airports: dashboards.busiest_of(_arrivals(sums), airports)),
}


def _arrivals(routes: DataFrame) -> DataFrame:
    return routes.groupBy("dest_airport_key").agg(F.sum("flights").alias("flights"))


def keep_up(
    fact: DataFrame, root: str, partition: str, touched: Collection | None = None, names: Sequence[str] = tuple(KEPT)
) -> None:
    """Bring the sums below ``root`` up to the ``touched`` values of ``partition`` of the stored ``fact``, or to all of it."""
    if touched is not None:
        inside = F.col(partition).isin([v for v in touched if v is not None])
        fact = fact.where(inside | F.col(partition).isNull() if None in touched else inside)
    for name in names:
        kept = KEPT[name]
        # The partition may be a key of the sums itself; it is stored under a name of its own.
        rows = fact.select(F.col(partition).alias("kept_part"), *kept.columns)
        write_table(kept.sums(rows, "kept_part"), f"{root}/{name}", ["kept_part"], keep_others=True)


def kept_sums(spark: SparkSession, root: str, name: str) -> DataFrame:
    """The sums of the whole fact out of those of its partitions."""
    parts = spark.read.parquet(f"{root}/{name}").drop("kept_part")
    keys = KEPT[name].keys
    return parts.groupBy(*keys).agg(*[F.sum(c).alias(c) for c in parts.columns if c not in keys])


def kept_dashboard(spark: SparkSession, root: str, name: str, dimension: DataFrame) -> DataFrame:
    """A dashboard of :data:`ANSWERS` from the kept sums, equal to the one recomputed from the fact."""
    sums, answer = ANSWERS[name]
    return answer(kept_sums(spark, root, sums), dimension)
