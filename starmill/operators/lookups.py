"""Dimension lookups: turn natural keys of a large frame into columns of a dimension.

A lookup table is broadcast only after its bytes were summed and found below a limit.  Beyond the limit the
large side is shuffled.  Keys that hold a large share of its rows, the missing key included, are found and counted
first; where there are any, their rows are spread over all partitions by a hash of the row and only their few
table rows are repeated, while all other rows stay unsalted.  Identical copies of one row share a hash; adaptive
execution splits the partition they fall into.

The salt hashes all columns of the large side, so select the ones needed before looking anything up.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

BROADCAST_BYTES = 64 * 1024 * 1024
#: A key is frequent if it holds more than this share of a shuffle partition's even part of the rows.
HOT_PART = 0.5
#: The largest and the smallest share of all rows that counts as frequent; the latter bounds the hashes collected.
HOT_SHARES = (0.005, 0.0001)
MIN_SALTS = 256
_ROW_OVERHEAD = 32


def current(dim: DataFrame) -> DataFrame:
    """Open versions only.  The filter comes first so that it reaches the scan."""
    return dim.where(F.col("current_flag"))


def one_per_key(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One row per key: the smallest by the remaining columns in their order, NULLs first.

    Copies are collapsed before the shuffle, so a key with very many copies stays cheap.
    """
    rest = [c for c in df.columns if c not in keys]
    if not rest:
        return df.distinct()
    return df.groupBy(*keys).agg(F.min(F.struct(*rest)).alias("_row")).select(*keys, "_row.*")


def _row_bytes(df: DataFrame) -> Column:
    sizes = [_value_bytes(f) for f in df.schema.fields]
    return F.sum(reduce(lambda a, b: a + b, sizes, F.lit(_ROW_OVERHEAD)).cast("long"))


def _value_bytes(field: T.StructField) -> Column:
    if isinstance(field.dataType, (T.StringType, T.BinaryType)):
        return F.coalesce(F.octet_length(field.name), F.lit(0))
    if isinstance(field.dataType, (T.ArrayType, T.MapType, T.StructType)):
        return F.octet_length(F.to_json(F.struct(field.name)))
    return F.lit(8)


def measured_bytes(*tables: DataFrame) -> list[int]:
    """Bytes of each table, summed over all its rows; one job for all tables."""
    if not tables:
        return []
    sums = [
        t.agg(F.coalesce(_row_bytes(t), F.lit(0)).alias("bytes")).select(F.lit(i).alias("i"), "bytes")
        for i, t in enumerate(tables)
    ]
    measured = dict(tuple(r) for r in reduce(DataFrame.unionByName, sums).collect())
    return [measured[i] for i in range(len(tables))]


def hot_share(spark: SparkSession) -> float:
    """The share of the rows from which a key is frequent: the more partitions, the smaller."""
    partitions = int(spark.conf.get("spark.sql.shuffle.partitions"))
    return min(HOT_SHARES[0], max(HOT_SHARES[1], HOT_PART / partitions))


def hot_keys(
    rows: DataFrame, keys: Mapping[str, Sequence[str]], share: float | None = None
) -> dict[str, list[int]]:
    """For each named key, the hashes of the values that hold more than ``share`` of the rows.

    Give stored rows, or rows that are cheap to compute: they are read twice.
    At most ``1 / share`` hashes per key.  Spark's frequent-item count names the candidates, false ones among
    them; a second pass over the key columns counts just these.  Two jobs for all keys together.
    """
    if not keys:
        return {}
    share = share or hot_share(rows.sparkSession)
    hashed = rows.select(*[F.xxhash64(*names).alias(key) for key, names in keys.items()])
    candidates = hashed.stat.freqItems(list(keys), share).first()
    listed = [
        F.struct(F.lit(key).alias("key"), F.when(F.col(key).isin(found), F.col(key)).alias("hash"))
        for key, found in zip(keys, candidates, strict=True)
    ]
    counts = hashed.select(F.inline(F.array(*listed))).groupBy("key", "hash").count().collect()
    total = sum(r["count"] for r in counts) / len(keys)
    hot: dict[str, list[int]] = {key: [] for key in keys}
    for r in counts:
        if r.hash is not None and r["count"] > share * total:
            hot[r.key].append(r.hash)
    return hot


def keep_listed(
    rows: DataFrame, listed: DataFrame, names: Sequence[str], limit_bytes: int = BROADCAST_BYTES
) -> DataFrame:
    """Drop rows whose key is not in ``listed`` before they are shuffled, where the list is small enough.

    A saving for a join that follows, not a filter to rely on: with a longer list all rows come back.
    """
    keys = listed.select(*names)
    if measured_bytes(keys)[0] > limit_bytes:
        return rows
    return rows.join(F.broadcast(keys.distinct()), list(names), "left_semi")


def _all_set(names: Sequence[str]) -> Column:
    return reduce(and_, [F.col(n).isNotNull() for n in names])


def within(sizes: Mapping[str, int], limit_bytes: int = BROADCAST_BYTES) -> set[str]:
    """The tables, smallest first, that may be broadcast together: their bytes add up to ``limit_bytes`` at most."""
    chosen, total = set(), 0
    for name in sorted(sizes, key=sizes.get):
        total += sizes[name]
        if total <= limit_bytes:
            chosen.add(name)
    return chosen


def lookup(
    rows: DataFrame,
    table: DataFrame,
    on: Mapping[str, str],
    take: Mapping[str, str],
    how: str = "left",
    table_bytes: int | None = None,
    hot: Sequence[int] | None = None,
    limit_bytes: int = BROADCAST_BYTES,
) -> DataFrame:
    """Join ``table`` (unique on its key) to ``rows``.

    ``on`` maps columns of ``rows`` to key columns of ``table``, and the result starts with them; ``take``
    maps new columns to columns of ``table``.  ``table_bytes`` and ``hot`` are the measured size of the table
    and the frequent keys of the rows where the caller has them already; a caller that looks up several keys
    finds the frequent ones of all in one go, before the first join.
    """
    types = {f.name: f.dataType for f in rows.schema.fields}
    right = table.select(
        *[F.col(column).cast(types[left]).alias(left) for left, column in on.items()],
        *[F.col(source).alias(target) for target, source in take.items()],
    )
    if table_bytes is None:
        table_bytes = measured_bytes(right)[0]
    if table_bytes <= limit_bytes:
        return rows.join(F.broadcast(right), list(on), how)
    if hot is None:
        hot = hot_keys(rows, {"key": list(on)})["key"]
    return _shuffled(rows, right, list(on), how, hot)


def _salts(rows: DataFrame) -> int:
    """As many as there are shuffle partitions, rounded up so that a salt is the low bits of a hash."""
    partitions = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return 1 << (max(partitions, MIN_SALTS) - 1).bit_length()


def _shuffled(
    rows: DataFrame, right: DataFrame, names: Sequence[str], how: str, hot: Sequence[int]
) -> DataFrame:
    if not hot:
        return rows.join(right, list(names), how)
    row_hash, is_hot = F.xxhash64(*rows.columns), F.xxhash64(*names).isin(list(hot))
    zero, last = F.lit(0).cast("long"), F.lit(_salts(rows) - 1).cast("long")
    # A row without a key meets no table row, so any salt will do for it.
    row_salt = F.when(~is_hot, zero).when(_all_set(names), row_hash.bitwiseAND(last)).otherwise(row_hash)
    table_salts = F.when(is_hot, F.sequence(zero, last)).otherwise(F.array(zero))
    left = rows.withColumn("_salt", row_salt)
    salted = right.where(_all_set(names)).withColumn("_salt", F.explode(table_salts))
    return left.join(salted, [*names, "_salt"], how).drop("_salt")
