"""Delimited text with a header line and a declared schema."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T


def read_delimited(
    spark: SparkSession,
    path: str,
    schema: str,
    sep: str = ",",
    date_format: str = "yyyy-MM-dd",
    mode: str = "FAILFAST",
) -> DataFrame:
    """Read the columns of ``schema`` with their declared types; the header says where they are.

    A field that is not of its type stops the read; with ``mode="PERMISSIVE"`` it becomes NULL.  Empty fields are NULL.
    Names are matched without regard to case, so an extract may carry more columns and in any order.  Files
    of one directory whose headers disagree are refused rather than read by position.
    """
    wanted = T.StructType.fromDDL(schema)
    types = {f.name.lower(): f.dataType for f in wanted.fields}
    reader = spark.read.options(sep=sep, header=True, dateFormat=date_format, enforceSchema=False, mode=mode)
    in_file_order = T.StructType(
        [T.StructField(name, types.get(name.lower(), T.StringType())) for name in reader.csv(path).columns]
    )
    return reader.schema(in_file_order).csv(path).select(*[f"`{f.name}`" for f in wanted.fields])


def write_delimited(df: DataFrame, path: str, sep: str = ",") -> None:
    df.write.mode("overwrite").options(sep=sep, header=True).csv(path)
