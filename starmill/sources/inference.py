"""Types of delimited text, inferred in one aggregate and comparable between deliveries.

Each value has a least type: empty < int < long < double, empty < date, and text above both.  A column's state is the
number of its values of each least type.  States of files, or of deliveries, add up, so the type of a column over all
of them needs none of the files again, and a delivery is compared with the last by its state alone.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .landing import BROKEN, read_text_fields

KINDS = ("empty", "int", "long", "double", "date", "text")
_WHOLE, _NUMBER = r"^[+-]?\d+$", r"^[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?$"
#: Types as Spark names them.
DDL = {"empty": "string", "int": "int", "long": "bigint", "double": "double", "date": "date", "text": "string"}


def least_kind(value: Column, date_format: str = "yyyy-MM-dd") -> Column:
    """The least type that holds one text value."""
    # A cast that fails costs a hundred times as much as one that does not, so whole numbers are told by their size.
    size = F.length(F.regexp_extract(value, r"^[+-]?0*(\d*)", 1))
    exact = value.try_cast("decimal(38,0)")
    number = (
        F.when(size < 10, F.lit("int"))
        .when(size > 19, F.lit("double"))
        .when(exact.between(-(2**31), 2**31 - 1), F.lit("int"))
        .when(exact.between(-(2**63), 2**63 - 1), F.lit("long"))
        .otherwise(F.lit("double"))
    )
    day = F.try_to_date(value, date_format).isNotNull()
    return (
        F.when(value.isNull() | (value == ""), F.lit("empty"))
        .when(value.rlike(_WHOLE), number)
        .when(value.rlike(_NUMBER), F.lit("double"))
        .when(_may_be_day(value, date_format) & day, F.lit("date"))
        .otherwise(F.lit("text"))
    )


def _may_be_day(value: Column, date_format: str) -> Column:
    """Whether ``value`` looks like a day at all: parsing one that is none costs a hundred times as much as a look.

    A date in ISO order has two hyphens and a digit, one of another form with a day or year in numbers has a digit.
    """
    if date_format == "yyyy-MM-dd":
        return value.rlike(r"\d.*-.*-.*\d")
    unquoted = "".join(date_format.split("'")[::2])
    return value.rlike(r"\d") if set(unquoted) & set("yud") else F.lit(True)


def type_states(text: DataFrame, date_format: str = "yyyy-MM-dd") -> DataFrame:
    """One row per column of ``text``, all of whose columns are text: ``position``, ``column_name`` and a count per type."""
    # Types are found in a step of their own: the counts, one per type, would each find them again.
    kinds = text.select(*[least_kind(F.col(f"`{c}`"), date_format).alias(f"kind_{n}") for n, c in enumerate(text.columns)])

    def state(position: int, name: str) -> Column:
        counts = [F.count(F.when(F.col(f"kind_{position}") == k, 1)).alias(f"n_{k}") for k in KINDS]
        return F.struct(F.lit(position).alias("position"), F.lit(name).alias("column_name"), *counts)

    states = kinds.agg(F.array(*[state(n, c) for n, c in enumerate(text.columns)]).alias("states"))
    return states.select(F.inline("states"))


def file_states(spark: SparkSession, path: str, sep: str = ",", date_format: str = "yyyy-MM-dd") -> DataFrame:
    """The states of a delimited extract with a header line; lines with another number of fields are left out."""
    text = read_text_fields(spark, path, sep)
    return type_states(text.where(F.col(BROKEN).isNull()).drop(BROKEN), date_format)


def merged_states(*states: DataFrame) -> DataFrame:
    """The states of several files or deliveries together; a column that one of them lacks has the counts of the others."""
    rows = states[0]
    for more in states[1:]:
        rows = rows.unionByName(more)
    sums = [F.sum(f"n_{k}").alias(f"n_{k}") for k in KINDS]
    return rows.groupBy("column_name").agg(F.min("position").alias("position"), *sums)


def resolved(states: DataFrame) -> DataFrame:
    """``states`` with ``kind``, the least type that holds all values of a column, and ``data_type`` as Spark names it."""
    numbers = F.col("n_int") + F.col("n_long") + F.col("n_double")
    kind = (
        F.when((F.col("n_text") > 0) | ((F.col("n_date") > 0) & (numbers > 0)), F.lit("text"))
        .when(F.col("n_date") > 0, F.lit("date"))
        .when(F.col("n_double") > 0, F.lit("double"))
        .when(F.col("n_long") > 0, F.lit("long"))
        .when(F.col("n_int") > 0, F.lit("int"))
        .otherwise(F.lit("empty"))
    )
    names = F.create_map(*[F.lit(v) for pair in DDL.items() for v in pair])
    return states.withColumn("kind", kind).withColumn("data_type", F.element_at(names, F.col("kind")))


def inferred_schema(states: DataFrame) -> str:
    """The declared schema that fits all values, for :func:`read_delimited` and :func:`land`; a row per column is collected."""
    columns = resolved(states).orderBy("position", "column_name").collect()
    return ", ".join(f"`{r['column_name']}` {r['data_type']}" for r in columns)


def drift(before: DataFrame, after: DataFrame) -> DataFrame:
    """Columns of two deliveries side by side: ``kind_before``, ``kind_after`` and ``change``.

    The change is new, missing, same, filled (all values were empty), emptied, wider (all old values fit the new
    type), narrower or other.
    """
    old, new = (resolved(s).select("column_name", F.col("kind").alias(k)) for s, k in ((before, "old"), (after, "new")))
    rank = F.create_map(*[F.lit(v) for pair in (("int", 1), ("long", 2), ("double", 3)) for v in pair])
    ranks = F.try_element_at(rank, F.col("old")), F.try_element_at(rank, F.col("new"))
    change = (
        F.when(F.col("old").isNull(), F.lit("new"))
        .when(F.col("new").isNull(), F.lit("missing"))
        .when(F.col("old") == F.col("new"), F.lit("same"))
        .when(F.col("old") == "empty", F.lit("filled"))
        .when(F.col("new") == "empty", F.lit("emptied"))
        .when((F.col("new") == "text") | (ranks[0] < ranks[1]), F.lit("wider"))
        .when((F.col("old") == "text") | (ranks[0] > ranks[1]), F.lit("narrower"))
        .otherwise(F.lit("other"))
    )
    joined = old.join(new, "column_name", "full")
    return joined.select("column_name", F.col("old").alias("kind_before"), F.col("new").alias("kind_after"), change.alias("change"))
