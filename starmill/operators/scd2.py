"""Dimensions that keep every version of a member (slowly changing dimension, type 2).

Versions are half-open intervals: the end of a closed version is the start of its successor, and an open
version ends on 9999-12-31.  The load date is a parameter; nothing reads the clock.

A merge works on open versions only.  Closed versions are passed through without a shuffle, however many a
member has, and both sides of every join hold at most one row per member.
"""

from __future__ import annotations

from collections.abc import Callable
from datetime import date
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..schemas import DimSpec
from .keys import dense_key
from .lookups import current, keep_listed, lookup, one_per_key

OPEN_END = date(9999, 12, 31)
CHANGE_MODES = ("attributes", "always")


def open_version(df: DataFrame, as_of: date) -> DataFrame:
    """Add the columns of a version that starts on ``as_of`` and is still open."""
    return df.withColumns(
        {"start_date": F.lit(as_of), "end_date": F.lit(OPEN_END), "current_flag": F.lit(True)}
    )


def delivered_members(staging: DataFrame, spec: DimSpec) -> DataFrame:
    """One row per member.  A NULL natural key names no member and stops the load."""
    missing = F.raise_error(F.lit(f"{spec.name}: NULL in the natural key of the staged rows"))
    keys = [F.coalesce(F.col(n), missing).alias(n) for n in spec.natural_key]
    rows = staging.select(*keys, *spec.attributes)
    if not spec.attributes:
        return one_per_key(rows, spec.natural_key)
    # Copies go by hashing before the smallest row of a member is sought, which sorts.  They are counted and the count is
    # looked at, as the optimizer takes a plain distinct away below a minimum.
    counted = rows.groupBy(*rows.columns).agg(F.count("*").alias("_copies"))
    smallest = counted.groupBy(*spec.natural_key).agg(
        F.min(F.struct(*spec.attributes)).alias("_row"), F.sum("_copies").alias("_copies")
    )
    return smallest.where("_copies > 0").select(*spec.natural_key, "_row.*")


def _closed(dim: DataFrame) -> DataFrame:
    return dim.where(~F.col("current_flag"))


def _staged(name: str) -> str:
    return f"_staged_{name}"


def _differs(spec: DimSpec, change: str) -> Column:
    if change not in CHANGE_MODES:
        raise ValueError(f"change must be one of {CHANGE_MODES}, not {change!r}")
    if change == "always" or not spec.attributes:
        return F.lit(change == "always")
    return reduce(or_, [~F.col(a).eqNullSafe(F.col(_staged(a))) for a in spec.attributes])


def _matched(dim: DataFrame, staging: DataFrame, spec: DimSpec, how: str) -> DataFrame:
    """Open versions next to the staged row of the same member; staged columns carry a prefix.

    Unless all versions are wanted, a small delivery shuffles only those of its own members.
    """
    staged = delivered_members(staging, spec)
    staged = staged.select(*[F.col(c).alias(_staged(c)) for c in staged.columns])
    versions = current(dim).select(*spec.columns)
    if how != "left":
        versions = keep_listed(versions, staging, spec.natural_key)
    same_member = reduce(
        lambda a, b: a & b, [F.col(n) == F.col(_staged(n)) for n in spec.natural_key]
    )
    return versions.join(staged, same_member, how)


def _staged_columns(spec: DimSpec) -> list[Column]:
    return [F.col(_staged(c)).alias(c) for c in (*spec.natural_key, *spec.attributes)]


def new_members(dim: DataFrame, staging: DataFrame, spec: DimSpec) -> DataFrame:
    """Staged rows of members the dimension has never seen."""
    return delivered_members(staging, spec).join(current(dim).select(*spec.natural_key), list(spec.natural_key), "left_anti")


def existing_members(dim: DataFrame, staging: DataFrame, spec: DimSpec) -> DataFrame:
    """Staged rows of members the dimension already holds."""
    return delivered_members(staging, spec).join(current(dim).select(*spec.natural_key), list(spec.natural_key), "left_semi")


def changed_members(dim: DataFrame, staging: DataFrame, spec: DimSpec, change: str = "attributes") -> DataFrame:
    """Staged rows that differ from the open version of their member; NULL equals NULL."""
    return _matched(dim, staging, spec, "inner").where(_differs(spec, change)).select(*_staged_columns(spec))


def closed_rows(
    dim: DataFrame, staging: DataFrame, spec: DimSpec, as_of: date, change: str = "attributes"
) -> DataFrame:
    """Open versions that this load ends, with their new end date."""
    return (
        _matched(dim, staging, spec, "inner")
        .where(_differs(spec, change))
        .withColumns({"end_date": F.lit(as_of), "current_flag": F.lit(False)})
        .select(*spec.columns)
    )


def untouched_rows(dim: DataFrame, staging: DataFrame, spec: DimSpec, change: str = "attributes") -> DataFrame:
    """Versions this load leaves as they are: closed ones, unchanged ones and those of absent members."""
    absent = F.col(_staged(spec.natural_key[0])).isNull()
    stays = absent | ~_differs(spec, change)
    kept = _matched(dim, staging, spec, "left").where(stays).select(*spec.columns)
    return _closed(dim).select(*spec.columns).unionByName(kept)


def scd2_initial(
    staging: DataFrame, spec: DimSpec, as_of: date, store: Callable[[DataFrame], DataFrame] | None = None
) -> DataFrame:
    """First load: one open version per staged member, keys 1, 2, 3 ...

    Numbering reads the members twice.  ``store`` writes them somewhere and returns them read back, so that the delivery
    is read once.
    """
    members = delivered_members(staging, spec)
    members = dense_key(store(members) if store else members, spec.natural_key, spec.key)
    return open_version(members, as_of).select(*spec.columns)


def scd2_delta(dim: DataFrame, staging: DataFrame, spec: DimSpec, change: str = "attributes") -> DataFrame:
    """Staged rows that need a new version; ``_held`` tells changed members from new ones."""
    matched = _matched(dim, staging, spec, "right")
    held = F.col(spec.natural_key[0]).isNotNull()
    needed = matched.where(~held | _differs(spec, change))
    return needed.select(*_staged_columns(spec), held.alias("_held"))


def scd2_apply(dim: DataFrame, delta: DataFrame, spec: DimSpec, as_of: date) -> DataFrame:
    """End the versions ``delta`` replaces and append its rows, numbered on from the largest key.

    A delta that was measured to be small is broadcast, so that the dimension is not shuffled.  A load that would end a
    version on or before its first day fails.
    """
    ended = delta.where("_held").select(*spec.natural_key, F.lit(True).alias("flag"))
    # Members are unique on both sides, so no key is frequent.
    versions = lookup(current(dim), ended, {n: n for n in spec.natural_key}, {"_ended": "flag"}, hot=())
    is_ended = F.coalesce("_ended", F.lit(False))
    too_early = F.raise_error(F.lit(f"{spec.name}: a version to be closed on {as_of} starts no earlier"))
    end = F.when(F.col("start_date") < F.lit(as_of), F.lit(as_of)).otherwise(too_early.cast("date"))
    versions = versions.withColumns(
        {
            "end_date": F.when(is_ended, end).otherwise(F.col("end_date")),
            "current_flag": ~is_ended,
        }
    )
    last_key = F.coalesce(dim.agg(F.max(spec.key)).scalar(), F.lit(0))
    opened = open_version(dense_key(delta.drop("_held"), spec.natural_key, spec.key, last_key), as_of)
    return (
        _closed(dim)
        .select(*spec.columns)
        .unionByName(versions.select(*spec.columns))
        .unionByName(opened.select(*spec.columns))
    )


def scd2_merge(
    dim: DataFrame,
    staging: DataFrame,
    spec: DimSpec,
    as_of: date,
    change: str = "attributes",
    store: Callable[[DataFrame], DataFrame] | None = None,
) -> DataFrame:
    """Bring ``staging`` into ``dim``: append new members and version changed ones.

    ``change="attributes"`` opens a version only where an attribute differs, so repeating a load changes
    nothing; ``change="always"`` opens one for every delivered member.  Members absent from ``staging`` stay
    open.

    The delta is read three times.  ``store`` writes it somewhere and returns it read back, so that the join
    that finds it runs once.
    """
    delta = scd2_delta(dim, staging, spec, change)
    return scd2_apply(dim, store(delta) if store else delta, spec, as_of)
