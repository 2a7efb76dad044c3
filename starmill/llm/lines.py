"""Line deduplication by how common a line is on its own site."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import stored


def _lines(text: str = "text") -> Column:
    return F.split(F.col(text), "\n")


def _key(line: Column) -> Column:
    """Lines are equal if they are after spaces at both ends are cut; a 64-bit hash stands for them."""
    return F.xxhash64(F.trim(line))


def floor(pages: Column, min_pages: int) -> Column:
    """The fewest pages of boilerplate on a site of ``pages``: ``min_pages``, on a small site half of them, two at least."""
    return F.least(F.lit(min_pages), F.greatest(F.lit(2), F.ceil(pages / 2)))


def boilerplate(
    docs: DataFrame, host: str = "source", ratio: float = 0.02, min_pages: int = 5, copies: bool = False
) -> DataFrame:
    """(host, keys): for each host the hashes of the lines that more than ``ratio`` of its pages contain.

    A page counts a line once.  Blank lines are never boilerplate, nor are lines on fewer pages than :func:`floor` says.
    Only hashes are shuffled, summed up before; a host has at most lines per page / ``ratio`` such lines, so
    the array of one host stays small however many pages it has.  Without ``copies`` pages of equal text on one host are
    one page, so that a text is not taken for boilerplate because it was copied; texts are compared by 128 bits.
    """
    spoken = F.filter(_lines(), lambda line: F.trim(line) != "")
    per_page = F.array_distinct(F.transform(spoken, _key))
    pages = docs.select(F.col(host).alias("host"), F.col("text"), per_page.alias("lines"))
    if not copies:
        digest = [F.xxhash64("text").alias("high"), F.xxhash64(F.lit(1), "text").alias("low")]
        pages = pages.select("host", "lines", *digest).groupBy("host", "high", "low").agg(F.first("lines").alias("lines"))
        pages = stored(pages.select("host", "lines"))
    seen = pages.select("host", F.explode("lines").alias("key"))
    counts = seen.groupBy("host", "key").agg(F.count("*").alias("pages")).where(F.col("pages") > 1)
    totals = pages.groupBy("host").agg(F.count("*").alias("total"))
    common = counts.alias("c").join(totals.alias("t"), F.col("c.host").eqNullSafe(F.col("t.host")))
    enough = F.col("c.pages") >= floor(F.col("t.total"), min_pages)
    common = common.where(enough & (F.col("c.pages") > F.col("t.total") * F.lit(ratio)))
    return common.groupBy("c.host").agg(F.collect_list("c.key").alias("keys"))


def drop_boilerplate(
    docs: DataFrame, host: str = "source", ratio: float = 0.02, min_pages: int = 5, copies: bool = False
) -> DataFrame:
    """``docs`` without boilerplate lines in ``text``; ``n_lines`` and ``n_dropped`` are added or replaced.

    A null text stays null with 0 lines; an empty one has one blank line, which stays.  A page left without any line has
    an empty text; the page itself is kept.  Pages of a null host are one site.  Pages of equal text on a host count once,
    repeated rows too, and all of them lose what is boilerplate; with ``copies`` each is a page of its own.  A very long
    text is one row and its lines one array.  Columns of any other name pass through.
    """
    common = stored(boilerplate(docs, host, ratio, min_pages, copies))
    docs = docs.drop("n_lines", "n_dropped")
    joined = docs.alias("d").join(common.alias("b"), F.col(f"d.{host}").eqNullSafe(F.col("b.host")), "left")
    lines = F.split(F.col("d.text"), "\n")
    kept = F.filter(lines, lambda line: (F.trim(line) == "") | ~F.array_contains(F.col("b.keys"), _key(line)))
    kept = F.when(F.col("b.keys").isNull(), lines).otherwise(kept)
    others = [F.col(f"d.`{c}`") for c in docs.columns if c != "text"]
    beside = "".join(docs.columns) + "_"  # a name that no column has
    cut = joined.select(*others, F.struct(lines.alias("all"), kept.alias("kept")).alias(beside))
    size = lambda name: F.coalesce(F.size(F.col(f"`{beside}`")[name]), F.lit(0)).cast("long")
    text = F.array_join(F.col(f"`{beside}`")["kept"], "\n").alias("text")
    return cut.select(
        *[F.col(f"`{c}`") if c != "text" else text for c in docs.columns],
        size("all").alias("n_lines"),
        (size("all") - size("kept")).alias("n_dropped"),
    )
