"""Collocations by relational mining of word occurrences (SETM).

Relation k holds the occurrences of frequent k-word phrases: (block, place, id), the place right behind the phrase in its
document.  A place between two pieces of a text is left empty, so words on either side of a mark are never neighbours.  Ids
stand for phrases one to one: those of words come from the table of frequent words, those of longer phrases from the pairs
(id of the phrase without its last word, id of that word) that were counted.  The relation of single words is written once,
bucketed by block and sorted by place.  Each step merge-joins relation k with it at that place, counts the groups, keeps
the frequent ones by a semi-join, which gives them their id, and writes relation k + 1 in the same buckets, so that no
occurrence is shuffled again.
"""

from __future__ import annotations

import string
import uuid
from collections.abc import Iterator, Sequence
from contextlib import contextmanager
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..operators.lookups import BROADCAST_BYTES, hot_keys, lookup, measured_bytes
from ..sources import scratch_root
from .common import stored

#: Buckets of the relations for each shuffle partition.
BUCKETS_PER_PARTITION = 4

# Marks end a piece and stand as a word of their own, a line feed, until words have their places.
_MARK = r"[.,;:!?\x0A-\x0D]"


def _lowered(word: Column) -> Column:
    """A-Z lower-cased and nothing else; ``lower`` would change other letters too but is much cheaper where there are none."""
    other = F.translate(word, string.ascii_uppercase, string.ascii_lowercase)
    return F.when(F.length(word) == F.octet_length(word), F.lower(word)).otherwise(other)


def _occurrences(blocks: DataFrame) -> DataFrame:
    """(block, lang, place, word) of each word of ``blocks`` (block, lang, text); the place counts from 1."""
    apart = F.replace(F.regexp_replace("text", _MARK, " \n "), F.lit("\t"), F.lit(" "))
    words = F.array_remove(F.split(apart, " "), "")
    placed = blocks.select("block", "lang", F.posexplode(words).alias("at", "word")).where("word <> '\n'")
    return placed.select("block", "lang", (F.col("at") + 1).alias("place"), _lowered(F.col("word")).alias("word"))


def _buckets(spark: SparkSession) -> int:
    """A few for each shuffle partition, so that a bucket is sorted in memory."""
    return BUCKETS_PER_PARTITION * int(spark.conf.get("spark.sql.shuffle.partitions"))


def _with_ids(occurrences: DataFrame, frequent: DataFrame, key: Sequence[str], limit_bytes: int) -> DataFrame:
    """(block, place, id) of the occurrences whose ``key`` is in ``frequent`` (key, id).

    Beyond the broadcast limit hot keys are salted and the rows dealt to their buckets anew.
    """
    frequent = frequent.select(*key, "id")
    size = measured_bytes(frequent)[0]
    if size <= limit_bytes:
        return occurrences.join(F.broadcast(frequent), list(key)).select("block", "place", "id")
    rows = stored(occurrences)
    hot = hot_keys(rows, {"key": list(key)})["key"]
    kept = lookup(rows, frequent, {c: c for c in key}, {"id": "id"}, "inner", size, hot, limit_bytes)
    return kept.select("block", "place", "id").repartition(_buckets(occurrences.sparkSession), "block")


class _Relations:
    """Relations that are written in buckets of whole blocks, sorted by place, until they are dropped."""

    def __init__(self, spark: SparkSession) -> None:
        self.spark, self.tables = spark, {}

    def write(self, occurrences: DataFrame) -> DataFrame:
        name, path = f"starmill_{uuid.uuid4().hex}", scratch_root(self.spark)
        self.tables[name] = path
        writer = occurrences.select("block", "place", "id").write.format("parquet").option("path", path)
        writer.bucketBy(_buckets(self.spark), "block").sortBy("block", "place").saveAsTable(name)
        return self.spark.table(name)

    def drop(self) -> None:
        for name, path in self.tables.items():
            self.spark.sql(f"DROP TABLE IF EXISTS {name}")
            folder = self.spark._jvm.org.apache.hadoop.fs.Path(path)
            folder.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(folder, True)


#: Within the mining, joins by block and place may use buckets that were dealt by block alone, and the order of a bucket.
SETTINGS = {
    "spark.sql.requireAllClusterKeysForCoPartition": "false",
    "spark.sql.legacy.bucketedTableScan.outputOrdering": "true",
}


@contextmanager
def _relations(spark: SparkSession) -> Iterator[_Relations]:
    before, relations = {name: spark.conf.get(name, None) for name in SETTINGS}, _Relations(spark)
    for name, value in SETTINGS.items():
        spark.conf.set(name, value)
    try:
        yield relations
    finally:
        for name, value in before.items():
            spark.conf.unset(name) if value is None else spark.conf.set(name, value)
        relations.drop()


def _extended(relation: DataFrame, words: DataFrame) -> DataFrame:
    """Occurrences of one word more: each merge-joined with the word at its place; (block, place, head, tail).

    The place behind a single word is one on from its own, which the relation of words is sorted by.
    """
    heads = relation.select("block", "place", F.col("id").alias("head"))
    tails = words.select("block", "place", F.col("id").alias("tail"))
    both = heads.hint("merge").join(tails, ["block", "place"])
    return both.select("block", (F.col("place") + 1).alias("place"), "head", "tail")


def _numbered(counts: DataFrame, least: int) -> DataFrame:
    """Groups with ``least`` occurrences or more, written with an id.

    Ids count from 0 without gaps and are ints unless there are too many: Spark joins a pair of ints as one long.
    """
    rows = stored(counts.where(F.col("a") >= least).withColumn("at", F.monotonically_increasing_id()))
    part, row = F.shiftright("at", 33), F.col("at").bitwiseAND((1 << 33) - 1)
    sizes = rows.groupBy(part.alias("part")).agg(F.count("*").alias("size"))
    # One row for each part that was written.
    before = F.sum("size").over(Window.orderBy("part")) - F.col("size")
    starts = stored(sizes.withColumn("start", before))
    kind = "int" if (starts.agg(F.sum("size")).first()[0] or 0) < 1 << 31 else "long"
    numbered = rows.withColumn("part", part).join(F.broadcast(starts.drop("size")), "part")
    return stored(numbered.withColumn("id", (F.col("start") + row).cast(kind)).drop("at", "part", "start"))


def phrase_counts(
    docs: DataFrame, longest: int = 3, least: int = 10, limit_bytes: int = BROADCAST_BYTES
) -> tuple[DataFrame, DataFrame]:
    """(lang, n), all words of each language, and (lang, phrase, words, a) for phrases with ``least`` occurrences or more.

    ``longest`` limits the words of a phrase.  Both tables are written to the shared folder.
    """
    spark = docs.sparkSession
    lang, text = F.coalesce("lang", F.lit("und")).alias("lang"), F.coalesce("text", F.lit("")).alias("text")
    blocks = docs.select(F.monotonically_increasing_id().alias("block"), lang, text)
    with _relations(spark) as relations:
        all_words = stored(_occurrences(blocks).groupBy("lang", "word").agg(F.count("*").alias("a")))
        totals = stored(all_words.groupBy("lang").agg(F.sum("a").alias("n")))
        frequent = _numbered(all_words, least)
        # Whole texts are dealt to the buckets, not their words, which take more room.
        dealt = _occurrences(blocks.repartition(_buckets(spark), "block"))
        words = relations.write(_with_ids(dealt, frequent, ["lang", "word"], limit_bytes))
        relation = words.select("block", (F.col("place") + 1).alias("place"), "id")
        named = frequent.select("id", "lang", F.col("word").alias("phrase"), "a")
        word_names = named.select(F.col("id").alias("tail"), F.col("phrase").alias("word"))
        found = [named.drop("id").withColumn("words", F.lit(1))]
        for k in range(1, longest):
            longer = _extended(relation, words)
            frequent = _numbered(longer.groupBy("head", "tail").agg(F.count("*").alias("a")), least)
            spelt = lookup(frequent, word_names, {"tail": "tail"}, {"word": "word"}, "inner", limit_bytes=limit_bytes)
            heads = {"lang": "lang", "phrase": "phrase"}
            spelt = lookup(stored(spelt), named, {"head": "id"}, heads, "inner", limit_bytes=limit_bytes)
            named = stored(spelt.select("id", "lang", F.concat_ws(" ", "phrase", "word").alias("phrase"), "a"))
            found.append(named.drop("id").withColumn("words", F.lit(k + 1)))
            if k + 1 < longest:
                relation = relations.write(_with_ids(longer, frequent, ["head", "tail"], limit_bytes))
        return totals, stored(reduce(DataFrame.unionByName, found))


def _scored(candidates: DataFrame, counts: DataFrame, limit_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """Add ``l``, ``r`` and ``score`` of the cut with the lowest score, of equal ones that with the shortest first part."""
    part = F.split("phrase", " ")
    cuts = candidates.withColumn("k", F.explode(F.sequence(F.lit(1), F.col("words") - 1)))
    cuts = cuts.withColumns(
        {
            "first": F.array_join(F.slice(part, 1, F.col("k")), " "),
            "rest": F.array_join(F.slice(part, F.col("k") + 1, F.col("words") - F.col("k")), " "),
        }
    )
    cuts = lookup(stored(cuts), counts, {"lang": "lang", "first": "phrase"}, {"l": "a"}, "inner", limit_bytes=limit_bytes)
    cuts = lookup(stored(cuts), counts, {"lang": "lang", "rest": "phrase"}, {"r": "a"}, "inner", limit_bytes=limit_bytes)
    exact = {c: F.col(c).cast("decimal(18,0)").alias(f"_{c}") for c in "alr"}
    cuts = cuts.select("*", *exact.values()).withColumn("score", F.expr("(_a * _a * 1000000) div (_l * _r)"))
    best = F.min(F.struct("score", "k", "l", "r")).alias("best")
    scored = cuts.groupBy("lang", "phrase", "words", "a").agg(best)
    return scored.select("lang", "phrase", "a", "best.l", "best.r", "best.score")


def _contained(candidates: DataFrame, percent: int) -> DataFrame:
    """Candidates that no longer candidate contains in ``percent`` of their occurrences or more."""
    part = F.split("phrase", " ")
    inner = candidates.where("words > 2").select("lang", "words", "a", part.alias("w"))
    inner = inner.withColumn("size", F.explode(F.sequence(F.lit(2), F.col("words") - 1)))
    inner = inner.withColumn("at", F.explode(F.sequence(F.lit(1), F.col("words") - F.col("size") + 1)))
    within = inner.groupBy("lang", F.array_join(F.slice("w", F.col("at"), F.col("size")), " ").alias("phrase"))
    longest = within.agg(F.max("a").alias("longer"))
    joined = candidates.join(longest, ["lang", "phrase"], "left")
    return joined.where(f"longer IS NULL OR 100 * longer < {percent} * a").drop("longer")


def _first(rows: DataFrame, top: int) -> DataFrame:
    """The first ``top`` rows of each language with their ``rank``.

    Steps of scores are counted first.  Only rows from the step down to which ``top`` rows of a language reach are sorted,
    first within parts of a language, then the first of these.
    """
    rows = stored(rows.withColumn("step", F.floor(16 * F.log2(F.col("score") + 1))))
    steps = rows.groupBy("lang", "step").agg(F.count("*").alias("n"))
    above = F.sum("n").over(Window.partitionBy("lang").orderBy(F.desc("step"))) - F.col("n")
    edges = steps.withColumn("above", above).where(F.col("above") < top).groupBy("lang").agg(F.min("step").alias("edge"))
    few = rows.join(edges, "lang").where("step >= edge").drop("step", "edge")
    order = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    part = F.pmod(F.xxhash64("phrase"), F.lit(_buckets(rows.sparkSession)))
    inside = F.row_number().over(Window.partitionBy("lang", "part").orderBy(*order))
    few = few.withColumn("part", part).withColumn("rank", inside).where(F.col("rank") <= top)
    rank = F.row_number().over(Window.partitionBy("lang").orderBy(*order)).cast("long")
    return few.withColumn("rank", rank).where(F.col("rank") <= top)


def collocations(
    docs: DataFrame,
    longest: int = 3,
    least: int = 10,
    percent: int = 50,
    top: int = 2000,
    limit_bytes: int = BROADCAST_BYTES,
) -> DataFrame:
    """The ``top`` phrases of each language of ``docs`` (lang, text) whose words stand together more than chance has it.

    A-Z are lower-cased; marks and line ends cut a text into pieces, spaces and tabs these into words.  Phrases of two to
    ``longest`` words count with ``a``, their occurrences within pieces, if there are ``least`` or more.  A cut leaves
    parts with l and r occurrences; the lowest ``score``, a million times a * a over l * r without the fraction, counts.
    A phrase goes if a longer one holds it in ``percent`` of its occurrences.  Result: lang, rank, phrase, a, l, r, n
    (words of the language), score.

    A null lang is ``und`` and a null or empty text has no words.  Very long texts are one block each.  Repeated rows
    count each time; ties go by the bytes of the phrase.  Other columns are ignored; an empty table gives an empty result.
    """
    totals, counts = phrase_counts(docs, longest, least, limit_bytes)
    kept = _contained(counts.where("words > 1"), percent)
    chosen = stored(_first(_scored(kept, counts, limit_bytes), top))
    return chosen.join(totals, "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
