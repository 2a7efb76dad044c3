"""Benchmark decontamination by spaced seeds.

A seed is the hash of the tokens that a fixed mask selects; tokens it skips may have been replaced.  Seeds of the
benchmark, a bounded table, meet those of every position of the documents.  Where they meet, the item is laid along the
document at that offset and equal tokens are counted, so that passages with substitutions are found and chance hits are
not.  Of a run of hits along one offset only the first is verified.

Some mask fits every passage that the rule of ``contaminated`` allows: one of 13 tokens or more has a window of 13 with
two replaced at most, and lighter masks serve shorter items.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import stored

#: (mask, fewest, most tokens of an item it is used for); 1 for tokens that count.  Each length has masks that fit all
#: places of the replaced tokens: one of 8 or 9, two of 10 to 13.
COMPLETE = (
    ("11101111", 13, None), ("1111010011", 13, None), ("100100110111", 13, None),
    ("111011", 10, 12), ("11010011", 10, 12), ("1100001011", 10, 12),
    ("111111", 8, 9), ("11110011", 8, 9), ("11001111", 8, 9),
    ("11111", 5, 7),
)
#: Items with fewer tokens say too little to be matched.
FEWEST = 5
#: Tokens in which ``SHARE`` must agree; all of them in items of fewer than ``EXACT`` tokens.
WINDOW, SHARE, EXACT = 13, 0.8, 8
#: Seeds of the benchmark that are broadcast at a time, about 50 MB; a larger benchmark is taken in blocks.
SEEDS = 1_000_000
Seeding = tuple[str, int, int | None]
_SPACES, _DELETED = "\t\n\x0b\x0c\r", "!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~"


def tokens(text: Column) -> Column:
    """Lower-cased words without ASCII punctuation, as 64-bit hashes; none for null."""
    plain = F.translate(F.lower(text), _SPACES + _DELETED, " " * len(_SPACES))
    words = F.array_remove(F.split(F.coalesce(plain, F.lit("")), " "), "")
    return F.transform(words, lambda word: F.xxhash64(word))


def _seed(number: int, mask: str, at: Column) -> Column:
    """The hash of a mask's number and the tokens it selects from position ``at`` on; null beyond the ends."""
    chosen = [F.get("tokens", at + k) for k, use in enumerate(mask) if use == "1"]
    inside = (at >= 0) & (at + len(mask) <= F.size("tokens"))
    return F.when(inside, F.xxhash64(F.lit(number), *chosen))


def _seeds(rows: DataFrame, masks: tuple[str, ...], *columns: str) -> DataFrame:
    """A row per position and mask: ``columns``, ``at``, ``mask`` (its number) and ``seed``."""
    last = F.size("tokens") - FEWEST
    at = rows.withColumn("at", F.explode(F.when(last >= 0, F.sequence(F.lit(0), last))))
    found = [F.struct(F.lit(k).alias("mask"), _seed(k, m, F.col("at")).alias("seed")) for k, m in enumerate(masks)]
    return at.select(*columns, "at", F.inline(F.array(*found))).where("seed is not null")


def _before(mask: Column, masks: tuple[str, ...], at: Column) -> Column:
    """The seed one position earlier, only worked out for rows that ask for it."""
    return F.coalesce(*[F.when(mask == k, _seed(k, m, at - 1)) for k, m in enumerate(masks)])


def _used(mask: Column, seeding: tuple[Seeding, ...], length: Column) -> Column:
    """Whether items of ``length`` tokens have seeds of a mask."""
    fits = [(mask == k) & length.between(low, high or 1 << 30) for k, (_, low, high) in enumerate(seeding)]
    return reduce(Column.__or__, fits)


def benchmark_items(benchmark: DataFrame) -> DataFrame:
    """(item, item_id, tokens) of distinct items with enough tokens; ``item`` identifies one."""
    rows = benchmark.select("item_id", tokens(F.col("text")).alias("tokens")).where(F.size("tokens") >= FEWEST)
    return stored(rows.distinct().withColumn("item", F.xxhash64("item_id", "tokens")))


def contaminated(docs: DataFrame, benchmark: DataFrame, seeding: tuple[Seeding, ...] = COMPLETE) -> DataFrame:
    """Pairs (doc_id, item_id, matched, window, overlap) of documents that hold a passage of a benchmark item.

    Along one offset of item and document, ``matched`` of ``window`` consecutive tokens agree, at least four fifths of 13
    tokens, or of the whole item if that is shorter, or all of an item of fewer than 8; ``overlap`` tokens agree along
    the whole offset.  The best offset of each pair is returned, one row per pair.  Offsets without a seed of ``seeding``
are not looked at; with ``COMPLETE`` none that meets the rule is without.

    Null and empty texts match nothing, nor do items of fewer than 5 tokens.  Repeated documents give one pair, repeated
    items of one id too; a null id is a value like others.  A very long text is one row and its tokens one array.
    Other columns are ignored.  With an empty table on either side there are no pairs.
    """
    items = benchmark_items(benchmark)
    lengths = {r[0] for r in items.select(F.least(F.size("tokens"), F.lit(WINDOW))).distinct().collect()}
    seeding = tuple(x for x in seeding if any(x[1] <= n <= (x[2] or n) for n in lengths)) or seeding
    masks = tuple(mask for mask, _, _ in seeding)
    seeds = _seeds(items, masks, "item", "tokens").where(_used(F.col("mask"), seeding, F.size("tokens")))
    seeds = stored(
        seeds.select(
            "item", "seed", F.col("at").alias("item_at"), _before(F.col("mask"), masks, F.col("at")).alias("item_before")
        )
    )
    blocks = 1 + seeds.count() // SEEDS
    rows = docs.select("doc_id", tokens(F.col("text")).alias("tokens"))
    found = [_hits(rows, seeds, items, masks, block, blocks) for block in range(blocks)]
    best = reduce(DataFrame.unionByName, found).groupBy("doc_id", "item_id")
    return best.agg(F.max("best").alias("best")).select("doc_id", "item_id", "best.*")


def _hits(
    rows: DataFrame, seeds: DataFrame, items: DataFrame, masks: tuple[str, ...], block: int, blocks: int
) -> DataFrame:
    """Verified hits with the items of one block, whose number of seeds is bounded."""
    mine = lambda df: F.broadcast(df.where(F.pmod("item", F.lit(blocks)) == block))
    before = _before(F.col("mask"), masks, F.col("at"))
    first = F.col("item_before").isNull() | ~before.eqNullSafe(F.col("item_before"))
    hits = _seeds(rows, masks, "doc_id", "tokens").join(mine(seeds), "seed").where(first)
    item = items.select("item", "item_id", F.col("tokens").alias("item_tokens"))
    start = F.greatest(F.lit(0), F.col("item_at") - F.col("at"))
    length = F.least(
        F.size("item_tokens") - start, F.size("tokens") - (F.col("at") - F.col("item_at") + start)
    )
    laid = hits.join(mine(item), "item").select(
        "doc_id",
        "item_id",
        F.zip_with(
            F.slice("item_tokens", start + 1, length),
            F.slice("tokens", F.col("at") - F.col("item_at") + start + 1, length),
            lambda x, y: F.when(x == y, 1).otherwise(0),
        ).alias("same"),
        F.least(F.lit(WINDOW), F.size("item_tokens")).alias("window"),
    )
    total = lambda numbers: F.aggregate(numbers, F.lit(0), lambda a, x: a + x)
    windows = F.transform(
        F.sequence(F.lit(1), F.size("same") - F.col("window") + 1), lambda k: total(F.slice("same", k, F.col("window")))
    )
    counted = laid.where(F.size("same") >= F.col("window")).select(
        "doc_id", "item_id", "window", F.array_max(windows).alias("matched"), total(F.col("same")).alias("overlap")
    )
    needed = F.when(F.col("window") < EXACT, F.col("window")).otherwise(F.ceil(F.col("window") * SHARE))
    return counted.where(F.col("matched") >= needed).select(
        "doc_id", "item_id", F.struct("matched", "window", "overlap").alias("best")
    )


def clean(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The documents without a passage of the benchmark.  Rows that repeat a doc_id go together."""
    found = stored(contaminated(docs, benchmark).select("doc_id").distinct())
    return docs.alias("d").join(found.alias("f"), F.col("d.doc_id").eqNullSafe(F.col("f.doc_id")), "left_anti")
