"""A cleaned and mixed corpus: each stage gets what the one before kept, written and read again.

Rows need the columns of ``documents``; other columns pass through, whatever their names.  An empty table passes through
all stages.  Very long texts are one row in every stage.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starmill.llm import decontaminate, language_id, lines, mixing, simhash
from starmill.llm.common import stored, table

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language can be told, with that language as ``lang``.

    Those without a letter, empty and null texts go, and those of which the network gives no language 0.3.  If no document has a
    ``lang`` to learn from, those with a letter stay as they are.
    """
    return language_id.with_language(docs, language_id.fit(docs))


def _beside(docs: DataFrame, names: tuple[str, ...], step: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """``step(docs)`` without the columns ``names`` that it adds; columns of the documents so named come back."""
    own = {c: f"{c} of the document" for c in docs.columns if c.lower() in names}
    done = step(docs.withColumnsRenamed(own)).drop(*names)
    return done.withColumnsRenamed({kept: c for c, kept in own.items()}).select(*[f"`{c}`" for c in docs.columns])


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the lines that are boilerplate on their site, where copies of a page count as one page.

    ``n_chars`` follows.
    """
    cut = _beside(docs, ("n_lines", "n_dropped"), lines.drop_boilerplate)
    return cut.withColumn("n_chars", F.length("text").cast("long"))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near duplicates, three bits of SimHash over three-word shingles apart, the smallest doc_id.

    Rows that repeat an id stay together if one of them stays.
    """
    found = simhash.near_duplicates(docs, width=3, radius=3).groupBy("doc_id").agg(F.bool_or("kept").alias("kept"))
    gone = stored(found.where("NOT kept").select("doc_id"))
    return docs.join(gone, "doc_id", "left_anti").select(*[f"`{c}`" for c in docs.columns])


def remove_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a passage of a benchmark item."""
    return decontaminate.clean(docs, table(spark, sf_dir, "benchmark"))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents in the mix, with ``copies``: how often it takes each.

    A column of the documents that is named so is ``given_copies``.
    """
    given = {c: f"given_{c}" for c in docs.columns if c.lower() in ("copies", "mix_copies")}
    mixed = mixing.mix_sources(docs.withColumnsRenamed(given)).where("mix_copies > 0")
    return mixed.withColumnRenamed("mix_copies", "copies")


STAGES: list[tuple[str, Stage]] = [
    ("language_id", identify_language),
    ("line_dedup", line_dedup),
    ("near_dedup", near_dedup),
    ("decontaminate", remove_benchmark),
    ("mix", mix),
]

#: The first stage is a trained model, so SQL cannot express the rows of ``run``; tests compare it with plain Python.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for position, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if position < len(STAGES) - 1:
            docs = stored(docs)
    return docs
