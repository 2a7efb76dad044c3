"""Delimited extracts landed as Parquet: parsed once, counted by the write, bad lines kept with the reason.

An extract is read as text, and every field is cast in the same pass.  A line with too few or too many fields, with a field
that is not of its declared type or without a required one is rejected: it stays in the landed table with a reason and
its text, and is copied beside it as ``<root>_rejected``.  The good rows are the others.  Both counts are observed on the plan
that writes them, so nothing is scanned or parsed a second time, and good and rejected rows add up to the lines read.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .tables import prune_versions, replace_table

#: Columns of a landed table besides those declared.
REASON, LINE, FILE = "_reject_reason", "_line", "_file"
BROKEN = "_broken_line"


class TooManyRejects(ValueError):
    """A delivery has a larger share of rejected lines than the load accepts."""


@dataclass(frozen=True)
class Landed:
    """A landed extract: its good rows, its rejected lines, and how many lines, good and rejected, there were."""

    rows: DataFrame
    rejects: DataFrame
    rows_read: int
    rows_rejected: int

    @property
    def rows_good(self) -> int:
        return self.rows_read - self.rows_rejected


def read_text_fields(spark: SparkSession, path: str, sep: str = ",") -> DataFrame:
    """All columns as text, empty fields NULL, and the text of lines whose number of fields is not the header's."""
    reader = spark.read.options(sep=sep, header=True, enforceSchema=False, mode="PERMISSIVE", columnPruning=False)
    names = reader.csv(path).columns
    fields = [T.StructField(n, T.StringType()) for n in [*names, BROKEN]]
    return reader.option("columnNameOfCorruptRecord", BROKEN).schema(T.StructType(fields)).csv(path)


def _typed(text: Column, kind: T.DataType, date_format: str) -> Column:
    if isinstance(kind, T.StringType):
        return text
    return F.try_to_date(text, date_format) if isinstance(kind, T.DateType) else text.try_cast(kind)


def parsed(
    spark: SparkSession,
    path: str,
    schema: str,
    sep: str = ",",
    date_format: str = "yyyy-MM-dd",
    required: Sequence[str] = (),
) -> DataFrame:
    """The columns of ``schema`` with their types, and for rejected lines the reason, the text and the file.

    The first reason counts: the number of fields, then the declared columns in their order, then ``required`` ones.
    Names are matched without regard to case; further columns are left out.
    """
    text = read_text_fields(spark, path, sep)
    wanted = T.StructType.fromDDL(schema).fields
    in_file = {name.lower(): name for name in text.columns}
    missing = [f.name for f in wanted if f.name.lower() not in in_file]
    if missing:
        raise ValueError(f"{path}: the header has no column {', '.join(missing)}")
    raw = {f.name: F.col(f"`{in_file[f.name.lower()]}`") for f in wanted}
    values = {f.name: _typed(raw[f.name], f.dataType, date_format) for f in wanted}
    reasons = [F.when(F.col(BROKEN).isNotNull(), F.lit("number of fields"))]
    for field in wanted:
        bad = raw[field.name].isNotNull() & values[field.name].isNull()
        reasons.append(F.when(bad, F.lit(f"{field.name}: not {field.dataType.simpleString()}")))
    reasons += [F.when(raw[name].isNull(), F.lit(f"{name}: missing")) for name in required]
    reason = F.coalesce(*reasons)
    line = F.coalesce(F.col(BROKEN), F.to_json(F.struct(*[F.col(f"`{c}`") for c in text.columns if c != BROKEN])))
    return text.select(
        *[value.alias(name) for name, value in values.items()],
        reason.alias(REASON),
        F.when(reason.isNotNull(), line).alias(LINE),
        F.when(reason.isNotNull(), F.col("_metadata.file_name")).alias(FILE),
    )


def land(
    spark: SparkSession,
    path: str,
    root: str,
    schema: str,
    sep: str = ",",
    date_format: str = "yyyy-MM-dd",
    required: Sequence[str] = (),
    max_rejected: float = 0.0,
) -> Landed:
    """Write the extract at ``path`` as the next version of ``root``; with rejects also ``<root>_rejected``.

    A delivery of which more than the share ``max_rejected`` is rejected fails after its rejects are stored.
    """
    counts = Observation()
    rows = parsed(spark, path, schema, sep, date_format, required)
    observed = rows.observe(counts, F.count(F.lit(1)).alias("read"), F.count(REASON).alias("rejected"))
    landed = replace_table(observed, root)
    read, rejected = counts.get["read"], counts.get["rejected"]
    names = [f"`{f.name}`" for f in T.StructType.fromDDL(schema).fields]
    rejects = landed.where(F.col(REASON).isNotNull()).select(REASON, LINE, FILE)
    if rejected:
        rejects = replace_table(rejects, f"{root}_rejected")
        prune_versions(spark, f"{root}_rejected")
    if rejected > max_rejected * read:
        reasons = rejects.groupBy(REASON).count().orderBy(F.desc("count"), REASON).limit(3).collect()
        worst = "; ".join(f"{r[REASON]} ({r['count']})" for r in reasons)
        raise TooManyRejects(f"{path}: {rejected} of {read} lines are malformed: {worst}. They are in {root}_rejected")
    return Landed(landed.where(F.col(REASON).isNull()).select(*names), rejects, read, rejected)
