"""Change detection by bucket digests: only the buckets of members that differ are joined.

Members are dealt into buckets by a hash of their key.  The digest of a bucket does not depend on the order of its rows:
their number and sums of two independent hashes of each row.  Where a delivery and the open versions have equal digests,
nothing has changed; a bucket with a changed, new or absent member, or with a repeated row, differs and is compared
member by member.  What is shuffled of the other buckets is one small row for each task that has some of them.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from datetime import date
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..schemas import DimSpec
from .lookups import BROADCAST_BYTES, current, measured_bytes
from .scd2 import scd2_apply, scd2_delta

#: Members in a bucket: few, so that a small share of changed members leaves most buckets alone.
PER_BUCKET = 16


def _bucket(names: Sequence[str], buckets: int) -> Column:
    return F.pmod(F.xxhash64(*[F.col(n).cast("string") for n in names]), F.lit(buckets)).alias("bucket")


def bucket_digests(
    rows: DataFrame, key: Sequence[str], columns: Sequence[str], buckets: int, types: T.StructType
) -> DataFrame:
    """(bucket, n, first, second) of ``rows``; columns are compared as the ``types`` of the same name, NULL equals NULL."""
    values = [F.col(c).cast(types[c].dataType) for c in (*key, *columns)]
    missing = F.concat(*[F.when(v.isNull(), "1").otherwise("0") for v in values])  # a hash passes over NULL
    hashes = {name: F.xxhash64(F.lit(seed), missing, *values) for name, seed in (("first", 1), ("second", 2))}
    sums = [F.sum(F.col(name).cast("decimal(20,0)")).alias(name) for name in hashes]
    hashed = rows.select(_bucket(key, buckets), *[h.alias(name) for name, h in hashes.items()])
    return hashed.groupBy("bucket").agg(F.count("*").alias("n"), *sums)


def changed_buckets(dim: DataFrame, staging: DataFrame, spec: DimSpec, buckets: int) -> DataFrame:
    """(bucket) of the buckets in which the delivery is not what the open versions say."""
    open_versions = current(dim).select(*spec.natural_key, *spec.attributes)
    sides = [
        bucket_digests(side, spec.natural_key, spec.attributes, buckets, open_versions.schema).select(
            "bucket", *[F.col(c).alias(f"{name}_{c}") for c in ("n", "first", "second")]
        )
        for name, side in (("old", open_versions), ("new", staging))
    ]
    differs = reduce(or_, [~F.col(f"old_{c}").eqNullSafe(F.col(f"new_{c}")) for c in ("n", "first", "second")])
    return sides[0].join(sides[1], "bucket", "full").where(differs).select("bucket")


def in_buckets(
    rows: DataFrame, key: Sequence[str], chosen: DataFrame, buckets: int, limit_bytes: int = BROADCAST_BYTES
) -> DataFrame:
    """The rows whose key is in one of the ``chosen`` buckets; a short list is broadcast, so that no row is shuffled."""
    chosen = F.broadcast(chosen) if measured_bytes(chosen)[0] <= limit_bytes else chosen
    return rows.withColumn("bucket", _bucket(key, buckets)).join(chosen, "bucket", "left_semi").drop("bucket")


def bucket_count(members: int, per_bucket: int = PER_BUCKET) -> int:
    return 1 << max(0, (members // per_bucket).bit_length())


def scd2_merge_changed(
    dim: DataFrame,
    staging: DataFrame,
    spec: DimSpec,
    as_of: date,
    store: Callable[[DataFrame], DataFrame],
    per_bucket: int = PER_BUCKET,
) -> DataFrame:
    """The result of :func:`scd2_merge` by attributes, for a delivery most of which the dimension knows already.

    ``store`` writes the list of changed buckets, and then the delta, somewhere and returns them read back.
    """
    buckets = bucket_count(current(dim).count(), per_bucket)
    chosen = store(changed_buckets(dim, staging, spec, buckets))
    key = spec.natural_key
    inside = [in_buckets(side, key, chosen, buckets) for side in (current(dim), staging)]
    return scd2_apply(dim, store(scd2_delta(*inside, spec)), spec, as_of)
