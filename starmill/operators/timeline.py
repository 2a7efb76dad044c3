"""Dimensions with history whose deliveries may arrive in any order.

A versioned dimension forgets deliveries that change nothing: when one of a day in between arrives late, it cannot
tell how long the late state lasted.  Here every version also keeps ``seen_dates``, the days on which a delivery showed
its member so.  A delivery then touches two versions of a member at most, the one that covers its day and the next one:

* the covering version says the same: its day is noted;
* it says something else: it ends on the day.  If it was seen again later, what follows the day is cut off as a version of
  its own from then on, and the delivered state holds in between.  If not, the delivered state holds up to the next version,
  which starts earlier instead where it says the same;
* nothing covers the day: the member starts with the delivered state, or its first version starts earlier.

So the versions are those that the same deliveries give in the order of their days, in whatever order they are loaded.
A version that is cut keeps its key for the earlier part; keys are never used for another state, so older facts stay right.

The days of a version that never changes grow with the deliveries.  With a ``horizon`` those before it are forgotten, but for
the first of each version, and deliveries of earlier days are refused from then on.
"""

from __future__ import annotations

from collections.abc import Callable
from datetime import date
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..schemas import DimSpec
from .keys import dense_key
from .lookups import keep_listed, lookup
from .scd2 import OPEN_END, delivered_members, scd2_initial

SEEN = "seen_dates"


def timeline_initial(
    staging: DataFrame, spec: DimSpec, as_of: date, store: Callable[[DataFrame], DataFrame] | None = None
) -> DataFrame:
    """First load: one open version per staged member, seen on ``as_of``."""
    return scd2_initial(staging, spec, as_of, store).withColumn(SEEN, F.array(F.lit(as_of)))


def _version(spec: DimSpec, of: Column, **changed: Column) -> Column:
    """A version like ``of`` but for the fields in ``changed``."""
    names = [spec.key, *spec.attributes, "start_date", "end_date", SEEN]
    kinds = {spec.key: "bigint", "start_date": "date", "end_date": "date", SEEN: "array<date>"}
    values = {n: changed[n] if n in changed else of[n] for n in names}
    return F.struct(*[(v.cast(kinds[n]) if n in kinds else v).alias(n) for n, v in values.items()])


def timeline_delta(dim: DataFrame, staging: DataFrame, spec: DimSpec, as_of: date) -> DataFrame:
    """What a delivery of the day ``as_of`` changes: versions with their key as they are now, new ones without a key.

    A second delivery for a day that says something else about a member fails; one that says the same changes nothing.
    """
    keys = list(spec.natural_key)
    day = F.lit(as_of)
    staged = delivered_members(staging, spec)
    staged = staged.select(*keys, F.struct(*[F.col(a) for a in spec.attributes]).alias("_new"))
    versions = keep_listed(dim, staging, keys)
    whole = F.struct("start_date", "end_date", SEEN, spec.key, *spec.attributes)
    covering = versions.where((F.col("start_date") <= day) & (day < F.col("end_date"))).select(*keys, whole.alias("_at"))
    later = versions.where(F.col("start_date") > day).groupBy(*keys).agg(F.min(whole).alias("_next"))
    rows = staged.join(covering, keys, "left").join(later, keys, "left")

    at, following, new = F.col("_at"), F.col("_next"), F.col("_new")

    def same(version: Column) -> Column:
        return reduce(and_, [version[a].eqNullSafe(new[a]) for a in spec.attributes], F.lit(True))

    before = F.filter(at[SEEN], lambda d: d < day)
    after = F.filter(at[SEEN], lambda d: d > day)
    twice = F.raise_error(F.lit(f"{spec.name}: two deliveries of {as_of} disagree about a member"))
    no_key = F.lit(None).cast("bigint")

    def delivered(until: Column) -> Column:
        attributes = {a: new[a] for a in spec.attributes}
        fixed = {"start_date": day, "end_date": until, SEEN: F.array(day)}
        return _version(spec, at, **{spec.key: no_key}, **attributes, **fixed)

    ended = _version(spec, at, end_date=day, **{SEEN: before})
    noted = _version(spec, at, **{SEEN: F.array_sort(F.array_union(at[SEEN], F.array(day)))})
    again = _version(spec, at, start_date=F.get(after, F.lit(0)), **{spec.key: no_key, SEEN: after})
    earlier = _version(spec, following, start_date=day, **{SEEN: F.concat(F.array(day), following[SEEN])})
    joins = following.isNotNull() & same(following) & (at.isNull() | (at["end_date"] == following["start_date"]))
    first_end = F.coalesce(following["start_date"], F.lit(OPEN_END))
    changes = (
        F.when(at.isNull(), F.array(F.when(joins, earlier).otherwise(delivered(first_end))))
        .when(same(at), F.array(noted))
        .when(F.array_contains(at[SEEN], day), twice)
        .when(F.size(after) > 0, F.array(ended, delivered(F.get(after, F.lit(0))), again))
        .when(joins, F.array(ended, earlier))
        .otherwise(F.array(ended, delivered(at["end_date"])))
    )
    return rows.select(*keys, F.inline(changes))


def timeline_merge(
    dim: DataFrame,
    staging: DataFrame,
    spec: DimSpec,
    as_of: date,
    store: Callable[[DataFrame], DataFrame] | None = None,
    horizon: date | None = None,
) -> DataFrame:
    """Bring the delivery of the day ``as_of`` into ``dim``, whatever days were delivered before.

    The changes are read several times; ``store`` writes them somewhere and returns them read back.  A delivery before the
    ``horizon`` fails, so give one that never moves back.
    """
    if horizon is not None and as_of < horizon:
        raise ValueError(f"{spec.name}: a delivery of {as_of} is older than {horizon}, from when on days are known")
    delta = timeline_delta(dim, staging, spec, as_of)
    delta = store(delta) if store else delta
    touched = delta.where(F.col(spec.key).isNotNull()).select(F.col(spec.key).alias("_key"), F.lit(True).alias("flag"))
    # Keys are unique on both sides, so none is frequent.
    left = lookup(dim, touched, {spec.key: "_key"}, {"_touched": "flag"}, hot=()).where(F.col("_touched").isNull())
    last_key = F.coalesce(dim.agg(F.max(spec.key)).scalar(), F.lit(0))
    opened = delta.where(F.col(spec.key).isNull()).drop(spec.key)
    numbered = dense_key(opened, [*spec.natural_key, "start_date"], spec.key, last_key)
    changed = delta.where(F.col(spec.key).isNotNull()).unionByName(numbered)
    columns = [*spec.columns, SEEN]
    current = F.col("end_date") == F.lit(OPEN_END)
    merged = left.select(*columns).unionByName(changed.withColumn("current_flag", current).select(*columns))
    if horizon is None:
        return merged
    known = F.filter(SEEN, lambda d: (d >= F.lit(horizon)) | (d == F.col("start_date")))
    return merged.withColumn(SEEN, known)
