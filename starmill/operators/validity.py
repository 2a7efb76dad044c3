"""The version of a member that was valid on a day.

All versions of a member are packed into one row, an array sorted by start date, so that finding them is a lookup by equal
keys like any other: broadcast where small, salted where a key is frequent.  The version is then found in the array
by bisection.  No range is ever joined, and a row meets one row of the dimension, so none is repeated.

A member has one version per load at most, so its array is bounded by the number of loads.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

VERSIONS = "array<struct<start_date:date,end_date:date,surrogate:bigint>>"


def packed_versions(dim: DataFrame, natural_key: Sequence[str], key: str) -> DataFrame:
    """One row per member: its natural key and ``versions``, all versions in the order of their starts."""
    version = F.struct("start_date", "end_date", F.col(key).cast("long").alias("surrogate"))
    return dim.groupBy(*natural_key).agg(F.sort_array(F.collect_list(version)).cast(VERSIONS).alias("versions"))


def _started(versions: Column, day: Column) -> Column:
    """How many of the sorted ``versions`` start on ``day`` or before, by bisection."""
    whole = F.struct(F.lit(0).alias("low"), F.size(versions).alias("high"))

    def halved(span: Column, _: Column) -> Column:
        # The count is in low..high; the middle is above low as long as they differ.
        middle = F.floor((span["low"] + span["high"] + 1) / 2).cast("int")
        begun = F.coalesce(F.get(versions, middle - 1)["start_date"] <= day, F.lit(False))
        return F.when(span["low"] >= span["high"], span).otherwise(
            F.struct(
                F.when(begun, middle).otherwise(span["low"]).alias("low"),
                F.when(begun, span["high"]).otherwise(middle - 1).alias("high"),
            )
        )

    steps = F.sequence(F.lit(1), F.ceil(F.log2(F.size(versions) + 1)).cast("int"))
    # Most members have one version, which needs no search.
    first = F.coalesce((F.get(versions, F.lit(0))["start_date"] <= day).cast("int"), F.lit(0))
    return F.when(F.size(versions) < 2, first).otherwise(F.aggregate(steps, whole, halved)["low"])


def version_on(versions: Column, day: Column, reach_back: bool = False) -> Column:
    """The key of the version that is valid on ``day``, out of an array of :func:`packed_versions`.

    Intervals are half-open.  NULL without a member, without a day, in a gap between versions and after the last one.
    Before the first version NULL as well, or with ``reach_back`` the key of the first version.
    """

    def key(started: Column) -> Column:
        last = F.get(versions, started - 1)
        found = F.when((started > 0) & (day < last["end_date"]), last["surrogate"])
        if not reach_back:
            return found
        return F.when((started == 0) & day.isNotNull(), F.get(versions, F.lit(0))["surrogate"]).otherwise(found)

    # The count is used several times; as the element of an array it is found by one bisection.
    return F.get(F.transform(F.array(_started(versions, day)), key), F.lit(0))
