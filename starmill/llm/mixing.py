"""Mix sources to target weights with thresholds on a hash, found by nested histograms.

Every document has a point, 60 bits of a digest of its id.  A source that must give a share of its words gives the
documents whose points are at most a threshold.  A histogram of words over the top bits of the points shows in which
bucket the budget ends; only the documents of that bucket are counted again, over the next bits, and so on until the
bucket is a single point.  Nothing is sorted but the histogram, and no document is moved: the thresholds are a small
table joined by source.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import stored, word_count

BITS, LEVELS = 12, 5
POINT_BITS = BITS * LEVELS


def point(doc_id: Column) -> Column:
    """60 bits of the MD5 of the id; a null id counts as an empty text."""
    digest = F.md5(F.coalesce(doc_id.cast("string"), F.lit("")))
    return F.conv(F.substring(digest, 1, POINT_BITS // 4), 16, 10).cast("long")


def sized(docs: DataFrame) -> DataFrame:
    """(doc_id, source, size, point) of each document, once written and then read by each pass."""
    text = word_count(F.col("text"))
    return stored(docs.select("doc_id", "source", text.alias("size"), point(F.col("doc_id")).alias("point")))


def targets(sizes: DataFrame, weights: Sequence[int], share: float, most: float) -> DataFrame:
    """(source, source_size, target) for the sources in code-point order, null last, weighing ``weights`` in turn.

    A source gets ``level * weight``, at most ``most`` times its size; ``level`` is such that all add up to ``share``
    of all words.  With the sources sorted by the level at which they are full, it is found at the first that is not.
    The windows run over one row per source.
    """
    per = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    everything = Window.partitionBy()
    turn = (F.row_number().over(by_name) - 1) % len(weights) + 1
    per = per.select(
        "source",
        "source_size",
        F.element_at(F.array(*[F.lit(float(w)) for w in weights]), turn).alias("weight"),
        (F.col("source_size") * F.lit(float(most))).alias("cap"),
    ).withColumn("full_at", F.col("cap") / F.col("weight"))
    by_level = Window.orderBy("full_at", F.col("source").asc_nulls_last())
    before = by_level.rowsBetween(Window.unboundedPreceding, -1)
    total = F.sum("source_size").over(everything) * F.lit(float(share))
    per = per.withColumn(
        "level",
        (total - F.coalesce(F.sum("cap").over(before), F.lit(0.0)))
        / (F.sum("weight").over(everything) - F.coalesce(F.sum("weight").over(before), F.lit(0.0))),
    ).withColumn("place", F.row_number().over(by_level))
    found = F.min(F.when(F.col("level") <= F.col("full_at"), F.struct("place", "level"))).over(everything)
    level = F.coalesce(found["level"], F.max("full_at").over(everything))
    return per.select("source", "source_size", F.least("cap", level * F.col("weight")).alias("target"))


def thresholds(
    sizes: DataFrame, weights: Sequence[int] = (3, 1, 2), share: float = 1.5, most: float = 2.0
) -> DataFrame:
    """(source, source_size, target, whole, threshold): ``whole`` copies of all documents, one more up to the threshold.

    Budgets of further copies are nested: the documents repeated once more are those of the smallest points.  The
    boundary point itself is taken if that brings the source nearer to its target.
    """
    goals = targets(sizes, weights, share, most)
    whole = F.greatest(F.ceil(F.col("target") / F.greatest("source_size", F.lit(1))) - 1, F.lit(0)).cast("long")
    bounds = stored(
        goals.withColumn("whole", whole)
        .withColumn("budget", F.col("target") - F.col("whole") * F.col("source_size"))
        .select("*", F.lit(0).cast("long").alias("prefix"), F.lit(0).cast("long").alias("below"))
    )
    for level in range(LEVELS):
        bounds = stored(_refined(sizes, bounds, level))
    nearer = 2 * F.col("budget") > 2 * F.col("below") + F.col("here")
    last = F.when(F.col("prefix").isNull(), F.lit(1 << POINT_BITS)).otherwise(
        F.col("prefix") - F.when(nearer, 0).otherwise(1)
    )
    return bounds.select("source", "source_size", "target", "whole", last.cast("long").alias("threshold"))


def _refined(sizes: DataFrame, bounds: DataFrame, level: int) -> DataFrame:
    """One level deeper: the bucket of each source in which the budget ends, null once all its documents fit."""
    rest = POINT_BITS - BITS * (level + 1)
    known = bounds.select("source", "prefix")
    inside = sizes.alias("s").join(
        known.alias("k"),
        F.col("s.source").eqNullSafe(F.col("k.source"))
        & (F.shiftrightunsigned("s.point", rest + BITS) == F.col("k.prefix")),
    )
    histogram = inside.groupBy("s.source", F.shiftrightunsigned("s.point", rest).alias("bucket")).agg(
        F.sum("s.size").alias("here")
    )
    up_to = F.sum("here").over(Window.partitionBy("source").orderBy("bucket"))
    summed = histogram.withColumn("upto", up_to)
    over = (
        summed.alias("h")
        .join(bounds.alias("b"), F.col("h.source").eqNullSafe(F.col("b.source")))
        .where(F.col("b.below") + F.col("h.upto") > F.col("b.budget"))
        .groupBy("h.source")
        .agg(F.min(F.struct("h.bucket", "h.upto", "h.here")).alias("edge"))
    )
    joined = bounds.alias("b").join(over.alias("o"), F.col("b.source").eqNullSafe(F.col("o.source")), "left")
    return joined.select(
        *[F.col(f"b.{c}") for c in ("source", "source_size", "target", "whole", "budget")],
        F.col("o.edge.bucket").alias("prefix"),
        (F.col("b.below") + F.col("o.edge.upto") - F.col("o.edge.here")).alias("below"),
        F.col("o.edge.here").alias("here"),
    )


def mixed(docs: DataFrame, bounds: DataFrame) -> DataFrame:
    """``docs`` (with source and point) and how often the mix takes each: ``source_size``, ``target``, ``copies``."""
    joined = docs.alias("d").join(bounds.alias("m"), F.col("d.source").eqNullSafe(F.col("m.source")), "left")
    extra = F.when(F.col("d.point") <= F.col("m.threshold"), 1).otherwise(0)
    return joined.select("d.*", "m.source_size", "m.target", (F.col("m.whole") + extra).alias("copies"))


def mix_sources(
    docs: DataFrame, weights: Sequence[int] = (3, 1, 2), share: float = 1.5, most: float = 2.0
) -> DataFrame:
    """``docs`` with ``mix_copies``, how often the mix takes each document: 0, or up to ``most`` times.

    Null and empty texts have size 0; they are taken or left by their point like the rest of their source.  A null
    source is a source of its own, the last.  Rows with the same doc_id have the same point and share one decision.  Of
    an empty table nothing is taken.  Other columns pass through; one that is named ``mix_copies`` is replaced.
    """
    bounds = thresholds(sized(docs), weights, share, most).select("source", "whole", "threshold")
    docs = docs.drop("mix_copies")
    extra = F.when(point(F.col("d.doc_id")) <= F.col("m.threshold"), 1).otherwise(0)
    joined = docs.alias("d").join(bounds.alias("m"), F.col("d.source").eqNullSafe(F.col("m.source")), "left")
    return joined.select("d.*", (F.col("m.whole") + extra).alias("mix_copies"))
