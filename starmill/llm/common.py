"""What several operators share: words, tables written to cut lineage, bounded samples, connected components."""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from starmill.sources import scratch_root

#: A word is a run of anything but these six ASCII white-space characters.  ``bytes.split()`` cuts at the same ones.
WORD = r"[^\x20\x09-\x0D]+"
_SPACES = "\t\n\x0b\x0c\r"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def word_count(text: Column) -> Column:
    """Words of a text, 0 for null."""
    plain = F.translate(text, _SPACES, " " * len(_SPACES))
    return F.coalesce(F.size(F.array_remove(F.split(plain, " "), "")), F.lit(0)).cast("long")


def stored(df: DataFrame) -> DataFrame:
    """Write ``df`` below the shared folder and read it back: lineage ends here, and the size is known to the planner."""
    path = scratch_root(df.sparkSession)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def text_slices(batches: Iterator, text: str = "text", most: int = 4 << 20) -> Iterator:
    """Cut Arrow batches into runs of rows with about ``most`` bytes of text, so that what Python makes of them is small."""
    import numpy as np

    for batch in batches:
        column = batch.column(text)
        width = np.cumsum(np.fromiter((len(v.as_buffer()) if v.is_valid else 0 for v in column), np.int64, len(column)))
        start = 0
        while start < batch.num_rows:
            end = max(start + 1, int(np.searchsorted(width, (width[start - 1] if start else 0) + most, "right")))
            yield batch.slice(start, end - start)
            start = end


def merged(root, i, j):
    """``root`` names a smaller or equal row for each row; the same after rows i and j (arrays) are linked."""
    import numpy as np

    while True:
        low = np.minimum(root[i], root[j])
        new = root.copy()
        np.minimum.at(new, root[i], low)
        np.minimum.at(new, root[j], low)
        while (new[new] != new).any():
            new = new[new]
        if (new == root).all():
            return root
        root = new


def components(edges: DataFrame) -> DataFrame:
    """Connected components of ``edges`` (a, b): one row (node, component) for each node, component its smallest node.

    Large-star and small-star steps alternate until nothing changes, each round written to the shared folder.
    Rounds grow with the logarithm of the longest chain.  Nodes without an edge are not in the result; loops and
    repeated edges are allowed.  A node with very many neighbours is met by map-side minima and by joins that
    adaptive execution may split; its neighbours are never collected.
    """
    edges = stored(
        edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a <> b").distinct()
    )
    before = None
    while True:
        edges = stored(_small_star(_large_star(edges)))
        state = edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b") % (1 << 40))).first()
        if tuple(state) == before:
            break
        before = tuple(state)
    roots = edges.select(F.col("b").alias("node")).distinct()
    return edges.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(
        roots.select("node", F.col("node").alias("component"))
    )


def _large_star(edges: DataFrame) -> DataFrame:
    """Join every larger neighbour of a node to the smallest of its neighbours and itself."""
    both = edges.select(F.col("a").alias("u"), F.col("b").alias("v")).unionByName(
        edges.select(F.col("b").alias("u"), F.col("a").alias("v"))
    )
    least = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
    moved = both.where("v > u").join(least, "u").select(F.col("v").alias("a"), F.col("m").alias("b"))
    return moved.distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """Join a node and its smaller neighbours to the smallest of them.  Here a > b throughout."""
    least = edges.groupBy("a").agg(F.min("b").alias("m"))
    moved = edges.join(least, "a").where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return moved.unionByName(least.select("a", F.col("m").alias("b"))).distinct()
