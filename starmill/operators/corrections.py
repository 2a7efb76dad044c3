"""Late and corrected rows of a partitioned fact: a keyed merge inside the partitions a delivery touches.

Every stored row carries the identity of what it records and the day it was delivered.  A delivery is merged only with the
stored rows of its own partitions; of each identity the rows of the latest delivery stay, so a late row joins the others of
its day, a corrected one replaces its former self, and an older delivery that arrives late changes nothing it should not.
A delivery of the same day takes the place of the one before, so a load that died half-way may be run again.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from datetime import date

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ..sources import exists, replace_table, write_table
from .lookups import BROADCAST_BYTES, lookup

#: Columns of a merged fact besides its own.
IDENTITY, DELIVERED = "row_identity", "delivered_on"
#: The intermediate tables of a merge, in their order.
MERGE_STEPS = ("delivered", "last", "kept")


def identity(*columns: str) -> Column:
    """A digest of 128 bits of some columns; NULL is a value of its own, and values cannot run into each other."""
    texts = [F.col(c).cast("string") for c in columns]
    parts = [F.coalesce(F.concat(F.octet_length(t).cast("string"), F.lit(":"), t), F.lit("-")) for t in texts]
    return F.md5(F.concat(*parts))


@dataclass(frozen=True)
class Merge:
    """What a merge did: rows of the touched partitions before, rows delivered, replaced, ignored as older, and after.

    ``touched`` are the values of the partition column it wrote.
    """

    rows_before: int
    rows_delivered: int
    rows_replaced: int
    rows_ignored: int
    touched: tuple = ()

    @property
    def rows_after(self) -> int:
        return self.rows_before + self.rows_delivered - self.rows_replaced - self.rows_ignored


def latest(
    old: DataFrame, new: DataFrame, store: Callable[[DataFrame], DataFrame], limit_bytes: int = BROADCAST_BYTES
) -> DataFrame:
    """Rows of both, ``_new`` telling them apart, with ``_stays``: whether no later delivery has their identity.

    All rows that a delivery has of one identity stay or go together; rows without an identity always stay.  Only
    identities that came with more than one delivery are looked up, and these are read from ``store``.  ``old`` and ``new``
    are read several times, so give stored rows.
    """
    both = old.withColumn("_new", F.lit(False)).unionByName(new.withColumn("_new", F.lit(True)))
    # The order of (day, new) as one number, which is compared by hashing; a row without a day is older than all others.
    when = F.coalesce(F.unix_date(DELIVERED).cast("long"), F.lit(-(2**40))) * 2 + F.col("_new").cast("int")
    told = both.where(F.col(IDENTITY).isNotNull()).groupBy(IDENTITY)
    told = told.agg(F.min(when).alias("first"), F.max(when).alias("last"))
    last = store(told.where("first < last").select(IDENTITY, "last"))
    joined = lookup(both, last, {IDENTITY: IDENTITY}, {"_last": "last"}, limit_bytes=limit_bytes)
    stays = F.col("_last").isNull() | (when == F.col("_last"))
    return joined.withColumn("_stays", stays).drop("_last")


def merge_fact(
    spark: SparkSession,
    path: str,
    rows: DataFrame,
    partition: str,
    delivered_on: date,
    schema: str,
    work: str,
    limit_bytes: int = BROADCAST_BYTES,
) -> Merge:
    """Merge ``rows``, which have a ``row_identity``, into the fact at ``path``, partitioned by ``partition``.

    ``schema`` declares the columns of the fact without those of the merge.  Intermediate tables are written as versions below
    ``work``.  The values of ``partition`` in ``rows`` come to the driver, as they name the folders to be replaced.  Spark moves
    complete partitions into place one after another; after a driver is lost in the middle, the same merge run again
    gives the whole result.
    """

    def store(name: str) -> Callable[[DataFrame], DataFrame]:
        return lambda df: replace_table(df, f"{work}/{name}")

    new = store("delivered")(rows.withColumn(DELIVERED, F.lit(delivered_on)))
    touched = [r[0] for r in new.select(partition).distinct().collect()]
    if not exists(spark, path):
        # Nothing can be replaced: the delivery is the fact.
        write_table(new, path, partition_by=[partition], keep_others=True)
        return Merge(0, new.count(), 0, 0, tuple(touched))
    full = f"{schema}, {IDENTITY} string, {DELIVERED} date"
    stored = spark.read.schema(full).parquet(path)
    inside = F.col(partition).isin([v for v in touched if v is not None])
    old = stored.where(inside | F.col(partition).isNull() if None in touched else inside).select(*new.columns)
    marked = latest(old, new, store("last"), limit_bytes)
    # The rows are counted by the job that writes them.
    counts, is_new, stays = Observation(), F.col("_new"), F.col("_stays")
    kinds = {"kept": ~is_new & stays, "replaced": ~is_new & ~stays, "added": is_new & stays, "ignored": is_new & ~stays}
    observed = marked.observe(counts, *[F.count_if(kind).alias(name) for name, kind in kinds.items()])
    kept = store("kept")(observed.where("_stays").drop("_new", "_stays"))
    write_table(kept, path, partition_by=[partition], keep_others=True)
    n = counts.get
    before, delivered = n["kept"] + n["replaced"], n["added"] + n["ignored"]
    return Merge(before, delivered, n["replaced"], n["ignored"], tuple(touched))
