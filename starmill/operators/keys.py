"""Dense surrogate keys numbered without a single-task window.

Members are ordered by the MD5 of their natural key.  Its first hex digits, three or as many as the shuffle partitions
ask for, cut that order into 4096 or more intervals that fill evenly whatever the natural keys look like, so no
bounds have to be sampled and no interval runs hot.  A row's number is its rank inside the interval plus the number of members in all earlier
intervals, which is exactly ``row_number() over (order by md5(natural key), natural key)``: gap-free, and the
same on every run, for any number of partitions.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

_LEAST_DIGITS, _MOST_DIGITS = 3, 5
#: Intervals for each shuffle partition, so that the partitions are filled evenly.
_PER_PARTITION = 4


def _digits(partitions: int) -> int:
    """Hex digits that cut enough intervals for so many partitions."""
    digits = _LEAST_DIGITS
    while digits < _MOST_DIGITS and 16**digits < _PER_PARTITION * partitions:
        digits += 1
    return digits


def key_digest(names: Sequence[str]) -> Column:
    return F.md5(F.concat_ws("|", *[F.col(n).cast("string") for n in names]))


def next_key(dim: DataFrame, key: str) -> DataFrame:
    """One row: the first free value of ``key`` (1 for an empty table)."""
    return dim.agg((F.coalesce(F.max(key), F.lit(0)) + 1).cast("long").alias("next_key"))


def dense_key(
    df: DataFrame,
    natural_key: Sequence[str],
    key: str,
    base: Column | int = 0,
) -> DataFrame:
    """Add ``key`` = ``base`` + 1, 2, 3 ... in digest order.

    ``natural_key`` must be unique and not NULL in ``df``.  The frame is read twice, the first time for the
    natural key alone, so it must give the same rows both times: a stored table, or computed from stored ones
    without chance.
    """
    digest = key_digest(natural_key)
    digits = _digits(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    bucket = F.conv(F.substring(digest, 1, digits), 16, 10).cast("int")
    base_column = F.lit(base) if isinstance(base, int) else base

    # At most a row per interval, so the window without partitions and the broadcast are both bounded.
    counts = df.select(bucket.alias("_bucket")).groupBy("_bucket").agg(F.count("*").alias("_n"))
    earlier = Window.orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("_bucket", F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_offset"))

    in_bucket = Window.partitionBy("_bucket").orderBy("_digest", *natural_key)
    ranked = df.withColumns({"_bucket": bucket, "_digest": digest}).withColumn(
        "_rank", F.row_number().over(in_bucket)
    )
    return (
        ranked.join(F.broadcast(offsets), "_bucket")
        .withColumn(key, (base_column + F.col("_offset") + F.col("_rank")).cast("long"))
        .drop("_bucket", "_digest", "_rank", "_offset")
    )
