"""Checks of a loaded table: row and key counts, and a profile of every column."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def load_audit(df: DataFrame, key: str, source: DataFrame | None = None, natural_key: str | None = None) -> DataFrame:
    """One row: ``row_count``, ``distinct_keys`` and ``null_keys``.

    With the ``source`` the table was loaded from and its ``natural_key`` also ``rows_read``, ``rows_without_key`` and
    ``rows_repeated``, further rows of a key, which a load keeps one of.  Rows are counted per key first, before any
    shuffle, so a key with very many rows costs one row.
    """
    sides = [df.select(F.col(key).alias("k"), F.lit("row").alias("side"))]
    if source is not None:
        sides.append(source.select(F.col(natural_key or key).alias("k"), F.lit("read").alias("side")))
    # A key of one type on each side; all of them are only counted.
    keys = reduce(DataFrame.unionByName, [s.withColumn("k", F.col("k").cast("string")) for s in sides])
    counts = keys.groupBy("side", "k").agg(F.count("*").alias("n")).select("*", F.col("k").isNull().alias("missing"))

    def total(side: str, condition: Column = F.lit(True), value: str = "n") -> Column:
        chosen = (F.col("side") == side) & condition
        return F.coalesce(F.sum(F.when(chosen, F.col("n") if value == "n" else F.lit(1))), F.lit(0)).cast("long")

    missing = F.col("missing")
    measures = [
        total("row").alias("row_count"),
        total("row", ~missing, "keys").alias("distinct_keys"),
        total("row", missing).alias("null_keys"),
    ]
    if source is not None:
        measures += [
            total("read").alias("rows_read"),
            total("read", missing).alias("rows_without_key"),
            (total("read", ~missing) - total("read", ~missing, "keys")).alias("rows_repeated"),
        ]
    return counts.agg(*measures)


def _cell(index: int, field: T.StructField) -> Column:
    """One value with its column number; whole numbers, fractions and all else in fields of their own.

    A number is never turned into text, and a whole number keeps all its digits.
    """
    value, kind = F.col(field.name), field.dataType
    whole = value if isinstance(kind, T.IntegralType) else F.lit(None)
    fraction = value if isinstance(kind, T.NumericType) and not isinstance(kind, T.IntegralType) else F.lit(None)
    is_exact_text = isinstance(kind, T.DecimalType) or not isinstance(kind, T.NumericType)
    text = value if is_exact_text else F.lit(None)
    return F.struct(
        F.lit(index).alias("column_index"),
        text.cast("string").alias("text"),
        whole.cast("long").alias("whole"),
        fraction.cast("double").alias("fraction"),
    )


def _flat(field: T.StructField) -> list[Column]:
    """Row count, NULLs, range and mean of one column, each an aggregate over the whole table."""
    value = F.col(field.name)
    number = value.cast("double") if isinstance(field.dataType, T.NumericType) else F.lit(None).cast("double")
    ranged = isinstance(field.dataType, (T.StringType, T.DateType, T.TimestampType, T.TimestampNTZType, T.BooleanType))
    text = value if ranged else F.lit(None)
    return [
        F.lit(field.name).alias("column_name"),
        F.count("*").alias("row_count"),
        (F.count("*") - F.count(value)).alias("null_count"),
        F.min(number).alias("min_value"),
        F.max(number).alias("max_value"),
        F.avg(number).alias("mean_value"),
        F.min(text).cast("string").alias("min_text"),
        F.max(text).cast("string").alias("max_text"),
    ]


def profile_table(df: DataFrame) -> DataFrame:
    """One row per column: rows, NULLs, distinct values, range and mean of numbers, range of text, dates and times.

    All but the distinct values is one aggregate without a row per value.  For the exact distinct count each value is
    sent once, without anything else.  An empty table has its rows too, with counts of 0.
    """
    fields = df.schema.fields
    flat = df.agg(F.array(*[F.struct(*_flat(f)) for f in fields]).alias("columns"))
    flat = flat.select(F.posexplode("columns").alias("column_index", "column")).select("column_index", "column.*")
    cells = df.select(F.inline(F.array(*[_cell(i, f) for i, f in enumerate(fields)]))).distinct()
    present = F.col("text").isNotNull() | F.col("whole").isNotNull() | F.col("fraction").isNotNull()
    distinct = cells.groupBy("column_index").agg(F.count(F.when(present, 1)).alias("distinct_count"))
    joined = flat.join(F.broadcast(distinct), "column_index", "left")  # one row per column
    return joined.select(
        "column_name",
        "row_count",
        "null_count",
        F.coalesce("distinct_count", F.lit(0)).alias("distinct_count"),
        *["min_value", "max_value", "mean_value", "min_text", "max_text"],
    )
